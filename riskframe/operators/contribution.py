"""Which features a scorer relies on, and drift that concerns them.

Permutation importance of a feature is the loss of average precision when its values are dealt out
anew. All features are permuted in one scan: rows are put into lots by a hash of their key, ordered inside
a lot by the rest of the hash, and each row borrows the values of the row before it (the first one those of the
last), a permutation of the lot. A lot of more rows than ``LOT`` is ordered in ranges of the hash, whose first
rows borrow from the range before. One variant of the row per feature, with that feature borrowed,
is scored beside the row itself, and the variants' score counts are ranked together. Ranges hold about
``LOT`` rows, so no task sorts more, and every draw is a hash: a rerun repeats it.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.stats import verdict
from riskframe.operators.metrics import average_precision

LOT = 10_000
ALL = "none permuted"


def permuted(df: DataFrame, features: Sequence[str], key: str = C.KEY, lots: int | None = None) -> DataFrame:
    """The rows, and per feature a variant of each row with that feature borrowed (column ``permuted``)."""
    rows = df.count()
    lots = lots or -(-rows // LOT) or 1
    parts = min(-(-rows // (lots * LOT)) or 1, 65_536)
    digest = F.md5(F.concat(F.lit("permutation|"), F.col(key)))
    values = F.struct(*features)
    # a large lot is cut into ranges of the hash, which the order inside the lot follows
    start = F.conv(F.substring("__h", 1, 8), 16, 10).cast("long")
    lot, place = start % lots, F.shiftright(start * parts, 32)
    hashed = df.withColumn("__h", digest).withColumns({
        "__values": values, "__lot": F.coalesce(lot, F.lit(-1)), "__part": F.coalesce(place, F.lit(0)),
    })
    # values last: rows with the same key are in one order in both places
    order = ["__h", key, "__values"]
    ends = hashed.groupBy("__lot", "__part").agg(F.max(F.struct(*order)).alias("end"))
    around = Window.partitionBy("__lot").orderBy("__part")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ends.select(
        "__lot", "__part", F.coalesce(F.lag("end").over(around), F.last("end").over(whole))["__values"].alias("__before")
    )
    inside = Window.partitionBy("__lot", "__part").orderBy(*order)
    borrowed = (
        hashed.withColumn("__other", F.lag("__values").over(inside))
        .join(F.broadcast(before), ["__lot", "__part"])  # a row per range of LOT rows
        .withColumn("__other", F.coalesce("__other", "__before"))
        .drop("__h", "__lot", "__part", "__values", "__before")
    )
    variants = [F.struct(F.lit(ALL).alias("permuted"), *features)] + [
        F.struct(F.lit(f).alias("permuted"), *[F.col(f"__other.{c}").alias(c) if c == f else F.col(c) for c in features])
        for f in features
    ]
    rest = [c for c in df.columns if c not in features]
    return borrowed.select(*rest, F.explode(F.array(*variants)).alias("__v")).select(*rest, "__v.*")


def permutation_importance(
    df: DataFrame,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    key: str = C.KEY,
    digits: int = 6,
    lots: int | None = None,
) -> DataFrame:
    """``feature``, ``pr_auc`` with it permuted, and its ``importance``: the average precision that is lost."""
    scored = score(permuted(df, features, key, lots)).select("permuted", C.TARGET, C.PROBABILITY)
    each = average_precision(scored, by=["permuted"], digits=15)
    whole = F.max(F.when(F.col("permuted") == ALL, F.col("pr_auc"))).over(Window.partitionBy())  # a row per feature
    return each.select(
        F.col("permuted").alias("feature"), F.round("pr_auc", digits).alias("pr_auc"),
        F.round(whole - F.col("pr_auc"), digits).alias("importance"),
    ).where(F.col("feature") != ALL)


def contributing_drift(runs: DataFrame, importance: DataFrame, least: float = C.LEAST_IMPORTANCE) -> DataFrame:
    """Per run: the lasting findings that concern a feature the scorer relies on, and whether to retrain.

    ``runs`` as from ``persistent_drift``, ``importance`` as from ``permutation_importance``. A lasting
    finding on a feature that loses less than ``least`` when permuted is listed, but triggers nothing.
    """
    known = runs.join(F.broadcast(importance), "feature", "left")  # one row per feature
    acting = F.col("persistent_verdict") == verdict(F.lit(C.PSI_ALARM))
    relied = F.coalesce(F.col("importance") >= least, F.lit(False))

    def names(cond: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.collect_list(F.when(cond, F.col("feature")))))

    return known.groupBy("run").agg(
        names(acting & relied).alias("contributing"), names(acting & ~relied).alias("other"),
        F.bool_or(acting & relied).alias("retrain"),
    )
