"""Exact ranks of values in one stored structure, whatever the number of distinct values.

Values are counted per column and distinct value (map-side combined, so a hot value is one row), the
counts dealt out by ranges of (column, value) and written once. A prefix table has one row per column and
range: its rows and the rows before it. A wanted rank is joined to the range that holds it, and running
counts within that range find the value; running counts of all ranges give distances between two
distribution functions. No task sees more than a range of a column, and nothing but the prefix
table is ordered in one place.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import stage


def long_values(
    df: DataFrame, values: Mapping[str, Column], keep: Sequence[str] = ()
) -> DataFrame:
    """(spec, value, ...) rows, one per non-null value; ``spec`` is the expression's number.

    Numbers instead of names keep the grouping keys of the following aggregate narrow.
    """
    cells = [x for i, v in enumerate(values.values()) for x in (F.lit(i), v.cast("double"))]
    return df.select(*keep, F.stack(F.lit(len(values)), *cells).alias("spec", "value")).where(
        "value is not null"
    )


class ValueRanks:
    """Ranks over (spec, value) rows with one or more count columns."""

    def __init__(self, rows: DataFrame, counts: Mapping[str, Column]):
        self.weights = list(counts)
        per_value = rows.groupBy("spec", "value").agg(*[c.alias(n) for n, c in counts.items()])
        placed = per_value.repartitionByRange("spec", "value").withColumn("block", F.spark_partition_id())
        #: spec, value, block and the counts.
        self.values = stage(placed, "value-counts")
        per_spec = Window.partitionBy("spec")
        earlier = per_spec.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sums = self.values.groupBy("spec", "block").agg(*[F.sum(w).alias(w) for w in self.weights])
        #: One row per column and range: rows in it, before it and in all.
        self.blocks = stage(
            sums.withColumns({
                **{f"{w}_before": F.coalesce(F.sum(w).over(earlier), F.lit(0)) for w in self.weights},
                **{f"{w}_all": F.sum(w).over(per_spec) for w in self.weights},
            }),
            "value-ranges",
        )

    def _running(self, values: DataFrame) -> DataFrame:
        upto = Window.partitionBy("spec", "block").orderBy("value").rowsBetween(
            Window.unboundedPreceding, 0
        )
        return values.withColumns({f"{w}_upto": F.sum(w).over(upto) for w in self.weights})

    def percentiles(self, probs: Sequence[float], weight: str) -> DataFrame:
        """Exact percentiles (linear interpolation): one row per ``spec`` with an array ``q`` and its totals."""
        total, before = F.col(f"{weight}_all"), F.col(f"{weight}_before")
        spots = F.array(*[
            F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (total - 1)).alias("at")) for i, p in enumerate(probs)
        ])
        ranks = F.flatten(F.transform(spots, lambda s: F.transform(
            F.array_distinct(F.array(F.floor(s["at"]), F.ceil(s["at"]))),
            lambda r: F.struct(s["i"].alias("i"), s["at"].alias("at"), r.alias("rank"), (r - before).alias("inside")),
        )))
        here = F.filter(ranks, lambda x: (x["inside"] >= 0) & (x["inside"] < F.col(weight)))
        # the few ranges that hold a wanted rank: at most two per column and probability
        wanted = self.blocks.where(f"{weight} > 0").select(
            "spec", "block", here.alias("wanted"), *[f"{w}_all" for w in self.weights]
        ).where(F.size("wanted") > 0)
        some = self.values.join(F.broadcast(wanted), ["spec", "block"])
        upto = F.col(f"{weight}_upto")
        x = F.col("x")
        hits = self._running(some).select("*", F.explode("wanted").alias("x")).where(
            (x["inside"] < upto) & (x["inside"] >= upto - F.col(weight))
        )
        part = x["at"] - F.floor(x["at"])
        low = F.max(F.when(x["rank"] == F.floor(x["at"]), F.col("value")))
        high = F.max(F.when(x["rank"] == F.ceil(x["at"]), F.col("value")))
        each = hits.groupBy("spec", x["i"].alias("i"), part.alias("part")).agg(
            low.alias("low"), high.alias("high"), *[F.max(f"{w}_all").alias(f"{w}_all") for w in self.weights]
        )
        value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
        return each.groupBy("spec").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("i", value.alias("v")))), lambda y: y["v"]).alias("q"),
            *[F.max(f"{w}_all").alias(f"{w}_all") for w in self.weights],
        )

    def quantiles(self, parts: int, weight: str) -> DataFrame:
        """The values at ranks ceil(rows * i / parts), i from 0: ``spec``, ``value`` and the first and last i it is for."""
        starts = self.blocks.select("spec", "block", f"{weight}_before", f"{weight}_all")
        placed = self._running(self.values).join(F.broadcast(starts), ["spec", "block"])
        upto = placed.withColumn("upto", F.col(f"{weight}_before") + F.col(f"{weight}_upto"))
        below = f"(upto - {weight})"
        return upto.select(
            "spec", "value",
            F.expr(f"if({below} = 0, 0, {below} * {parts} div {weight}_all + 1)").alias("first"),
            F.expr(f"upto * {parts} div {weight}_all").alias("last"),
        ).where("first <= last")

    def distances(self, a: str, b: str) -> DataFrame:
        """Largest distance between the distribution functions of two counts, per ``spec``."""

        def share(w: str) -> Column:
            return F.try_divide(F.col(f"{w}_before") + F.col(f"{w}_upto"), F.col(f"{w}_all"))

        starts = self.blocks.select("spec", "block", *[f"{w}_{x}" for w in (a, b) for x in ("before", "all")])
        return self._running(self.values).join(F.broadcast(starts), ["spec", "block"]).groupBy("spec").agg(
            F.max(F.abs(share(a) - share(b))).alias("distance")
        )


def exact_percentiles(
    df: DataFrame, values: Mapping[str, Column], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Exact percentiles of several expressions as plain numbers; None for expressions without values."""
    out: dict[str, list] = {name: [None] * len(probs) for name in values}
    if values:
        names = list(values)
        ranks = ValueRanks(long_values(df, values), {"n": F.count("*")})
        for r in ranks.percentiles(probs, "n").collect():
            out[names[r["spec"]]] = list(r["q"])
    return out
