"""Row numbers and rank cuts without a global sort.

A plain window over a huge group sorts it in one task. The helpers here first count rows per
fine bucket (map-side combined), find the few buckets that matter from the cumulated counts, and
look at single values only inside those.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import small_table

MAX_STRATA = 1000
MAX_BROADCAST_ROWS = 100_000


def numbered_rows(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    name: str,
    lot: Column | None = None,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """``row_number() - 1`` per group in the order of a unique column.

    Groups beyond ``hot_rows`` rows are looked for first. Without any, this is the plain window.
    Hot groups are cut into lots, a lot being a range of the order column (``lot``: any column
    that never decreases with it), so that no task sorts a whole hot group; lot offsets come from
    counts.
    """
    keys = list(group)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    hot = sizes.where(F.col("__n") > hot_rows).select(*keys, F.lit(True).alias("__hot"))
    found = hot.count()
    if not found:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
        return df.withColumn(name, place.cast("long"))
    if found <= MAX_BROADCAST_ROWS:
        hot = F.broadcast(hot)
    lot = F.shiftright(F.col(order).cast("long"), 20) if lot is None else lot
    cut = df.join(hot, keys, "left").withColumn("__lot", F.when(F.col("__hot"), lot))
    counts = cut.where("__hot").groupBy(*keys, "__lot").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__lot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(*keys, "__lot", F.sum("__n").over(before).alias("__before"))
    within = F.row_number().over(Window.partitionBy(*keys, "__lot").orderBy(order)) - 1
    return (
        cut.withColumn("__pos", within)
        .join(offsets, [*keys, "__lot"], "left")
        .withColumn(name, F.col("__pos") + F.coalesce(F.col("__before"), F.lit(0)))
        .drop("__lot", "__hot", "__pos", "__before")
    )


def rank_cuts(
    df: DataFrame,
    key: str,
    shares: Sequence[float],
    strata: str | None = None,
    rounding: float = 0.5,
    digits: int = 4,
) -> dict:
    """Key values that cut each stratum after ``floor(share * n + rounding)`` rows in key order.

    ``key`` is a hex digest. Returns {stratum: [cut key or None, ...]}; rows with ``key <= cut``
    lie before the cut. Copies of a key always fall on the same side. Only the cut keys (strata x
    shares) reach the driver.
    """
    stratum = F.col(strata) if strata else F.lit(0)
    base = df.select(stratum.alias("s"), F.col(key).alias("k"))
    prefix = F.substring("k", 1, digits).alias("prefix")
    hist = base.groupBy("s", prefix).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("s")
    running = whole.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    targets = F.array(*[
        F.floor(F.lit(float(f)) * F.col("total") + F.lit(float(rounding))) for f in shares
    ])
    found = (
        hist.withColumns({"total": F.sum("n").over(whole), "upto": F.sum("n").over(running)})
        .select("s", "prefix", "n", "upto", F.posexplode(targets).alias("cut", "target"))
        .where((F.col("target") > F.col("upto") - F.col("n")) & (F.col("target") <= F.col("upto")))
        .select("s", "prefix", "cut", (F.col("target") - F.col("upto") + F.col("n")).alias("rank"))
        .limit(MAX_STRATA * len(shares) + 1)
        .collect()
    )
    if len(found) > MAX_STRATA * len(shares):
        raise ValueError(f"{strata} has more than {MAX_STRATA} values; not a stratum column")
    cuts: dict = {r["s"]: [None] * len(shares) for r in found}
    if not found:
        return cuts
    wanted = small_table(
        df.sparkSession,
        [(r["s"], r["prefix"], r["cut"], r["rank"]) for r in found],
        hist.select("s", "prefix").schema.add("cut", "integer").add("rank", "long"),
    )
    inside = (
        base.withColumn("prefix", F.substring("k", 1, digits))
        .join(F.broadcast(wanted), ["s", "prefix"])  # at most strata x shares rows
        .groupBy("s", "cut", "rank", "k")
        .agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(
        Window.partitionBy("s", "cut").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    )
    for r in (
        inside.withColumn("upto", upto)
        .where((F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")))
        .select("s", "cut", "k")
        .collect()
    ):
        cuts[r["s"]][r["cut"]] = r["k"]
    return cuts


def position(key: str, cuts: Mapping, strata: str | None = None) -> Column:
    """Number of cuts lying before the key (0 = before or at the first cut)."""

    def one(keys: Sequence[str | None]) -> Column:
        hits = [F.when(F.col(key) > F.lit(k), 1).otherwise(0) if k is not None else F.lit(1) for k in keys]
        total = hits[0]
        for h in hits[1:]:
            total = total + h
        return total

    if strata is None:
        return one(cuts[0])
    expr = None
    for s, keys in cuts.items():
        cond = F.col(strata).eqNullSafe(F.lit(s))
        expr = F.when(cond, one(keys)) if expr is None else expr.when(cond, one(keys))
    return expr
