"""Drift between a reference and a current table: PSI, KS, chi-square, verdicts, policies."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C
from riskframe.functions.features import common_columns, numeric_columns
from riskframe.functions.ranks import ValueRanks, exact_percentiles, long_values
from riskframe.functions.stats import chi2_p, exact_kolmogorov_p, kolmogorov_p, psi_term, verdict
from riskframe.session import small_table, stage


def _side_counts() -> list[Column]:
    return [F.sum("is_ref").alias("n_ref"), F.sum(1 - F.col("is_ref")).alias("n_cur")]


def _both(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ref.select(*cols, F.lit(1).alias("is_ref")).unionByName(
        cur.select(*cols, F.lit(0).alias("is_ref"))
    )


def bin_sql(value: str, edges: Sequence[float]) -> str:
    """SQL for the left-closed bin between reference quantiles; outer bins are open, null is in none.

    One parsed expression: hundreds of column objects take longer to build than to run.
    """
    steps = " + ".join(f"int({value} >= {e!r}D)" for e in list(edges)[1:-1])
    return f"case when {value} is not null then {steps or 0} end"


def distinct_edges(quantiles: Sequence[float | None]) -> list[float]:
    return sorted({round(q, 9) for q in quantiles if q is not None})


def reference_edges(
    ref: DataFrame, cols: Sequence[str], bins: int = C.PSI_BINS
) -> dict[str, list[float]]:
    """Distinct bin edges per column from the reference's quantiles."""
    probs = [i / bins for i in range(bins + 1)]
    found = exact_percentiles(ref, {c: F.col(c) for c in cols}, probs)
    return {c: distinct_edges(q) for c, q in found.items()}


class DriftCheck:
    """One drift check of a table pair; table, operating metrics and verdict share its counts.

    Numeric columns are counted per value into stored ranges (``ValueRanks``), from which edges, bins,
    means and KS distances are derived; a column of constants counts the rows of both sides in
    the same pass. Categorical columns are counted per value beside it.
    """

    def __init__(
        self,
        ref: DataFrame,
        cur: DataFrame,
        without: Sequence[str] = (C.TARGET, C.KEY),
        threshold: float = C.THRESHOLD,
        bins: int = C.PSI_BINS,
        exact_p: bool = False,
    ):
        """``exact_p``: p-values of the distance from the exact distribution, for samples of bounded size."""
        self.exact_p = exact_p
        self.spark = ref.sparkSession
        self.threshold = threshold
        self.numeric, self.categorical = feature_kinds(ref, cur, without)
        both = _both(ref, cur, [*self.numeric, *self.categorical])
        rows = long_values(both, {**{c: F.col(c) for c in self.numeric}, "": F.lit(0.0)}, ["is_ref"])
        sides = dict(zip(("n_ref", "n_cur"), _side_counts(), strict=True))
        ranks = ValueRanks(rows, sides)
        every = len(self.numeric)
        quantiles = {r["spec"]: r for r in ranks.percentiles([i / bins for i in range(bins + 1)], "n_ref").collect()}
        if every in quantiles:
            sizes = (quantiles[every]["n_ref_all"], quantiles[every]["n_cur_all"])
        else:  # no reference rows; one row, none for empty tables
            sizes = ranks.values.where(F.col("spec") == every).select("n_ref", "n_cur").first() or (0, 0)
        self.reference_rows, self.current_rows = sizes
        self.edges: dict[str, list[float]] = {c: [] for c in self.numeric}
        self._binned_rows = self._distances = self.categories = None
        if self.categorical:
            self.categories = stage(_per_category(both, self.categorical), "category-counts")
        if not self.numeric:
            return
        for i, c in enumerate(self.numeric):
            if i in quantiles:
                self.edges[c] = distinct_edges(quantiles[i]["q"])
        number = F.expr(
            "case spec " + " ".join(f"when {i} then {bin_sql('value', self.edges[c])}" for i, c in enumerate(self.numeric)) + " end"
        )
        hit = F.col("value") >= threshold
        feature = _name([*self.numeric, ""]).alias("feature")
        values = ranks.values.where(F.col("spec") < every)
        self._binned_rows = values.groupBy(feature, number.alias("bin")).agg(
            F.sum("n_ref").alias("n_ref"),
            F.sum("n_cur").alias("n_cur"),
            F.sum(F.col("value") * F.col("n_ref")).alias("s_ref"),
            F.sum(F.col("value") * F.col("n_cur")).alias("s_cur"),
            F.sum(F.when(hit, F.col("n_ref")).otherwise(0)).alias("a_ref"),
            F.sum(F.when(hit, F.col("n_cur")).otherwise(0)).alias("a_cur"),
        )
        self._distances = ranks.distances("n_ref", "n_cur").where(F.col("spec") < every).select(feature, "distance")

    def numeric_summary(self) -> DataFrame:
        """One row per numeric column: sizes, PSI, KS distance and p-value, means, alarm shares."""
        flags = F.create_map(*[
            x for c, e in self.edges.items() for x in (F.lit(c), F.lit(len(e) < 3))
        ])
        rows = psi_from_counts(
            self._binned_rows, extra=("s_ref", "s_cur", "a_ref", "a_cur")
        ).join(F.broadcast(self._distances), "feature", "left")  # one row per column
        usable = (F.col("ref_rows") > 0) & (F.col("cur_rows") > 0)
        p_value = exact_kolmogorov_p if self.exact_p else kolmogorov_p
        p = p_value(F.col("distance"), F.col("ref_rows"), F.col("cur_rows"))
        return rows.select(
            "feature", "psi",
            F.when(usable, F.col("distance")).alias("statistic"),
            F.when(usable, p).alias("p"),
            F.try_divide("s_ref", "ref_rows").alias("ref_mean"),
            F.try_divide("s_cur", "cur_rows").alias("cur_mean"),
            F.try_divide("a_ref", "ref_rows").alias("ref_alarms"),
            F.try_divide("a_cur", "cur_rows").alias("cur_alarms"),
            flags[F.col("feature")].alias("degenerate_reference"),
        )

    def table(self) -> DataFrame:
        """Per common feature: PSI, verdict (on the unrounded PSI), test, p-value and means."""
        columns = [
            "feature", "psi", "statistic", "p", "ref_mean", "cur_mean", "degenerate_reference",
        ]
        parts = []
        if self.numeric:
            numeric = self.numeric_summary().where(F.col("feature") != C.PROBABILITY)
            parts.append(numeric.select(*columns))
        if self.categorical:
            rows = psi_from_counts(self.categories).join(
                F.broadcast(chi2_from_counts(self.categories)), "feature"  # one row per column
            )
            none = F.lit(None).cast("double")
            parts.append(rows.withColumns({
                "ref_mean": none, "cur_mean": none,
                "degenerate_reference": F.lit(False),
            }).select(*columns))
        if not parts:
            return self.spark.createDataFrame([], DRIFT_SCHEMA)
        tests = [(c, "KS") for c in self.numeric if c != C.PROBABILITY]
        tests += [(c, "chi2") for c in self.categorical]
        # a column that is null throughout has no counts, but its row belongs in the table
        names = T.StructType().add("feature", "string").add("test", "string")
        listed = small_table(self.spark, tests, names)
        rows = listed.join(F.broadcast(_union(parts)), "feature", "left")
        return rows.select(
            "feature",
            F.round("psi", 4).alias("psi"),
            verdict(F.col("psi")).alias("verdict"),
            "test",
            F.round("statistic", 4).alias("statistic"),
            F.round("p", 6).alias("p_value"),
            F.coalesce(F.col("p") < C.ALPHA, F.lit(False)).alias("significant"),
            F.round("ref_mean", 3).alias("ref_mean"),
            F.round("cur_mean", 3).alias("cur_mean"),
            F.coalesce("degenerate_reference", F.lit(False)).alias("degenerate_reference"),
        ).orderBy(F.desc("psi"), "feature")

    def operations(self) -> DataFrame:
        """Prediction drift, alarm rates and mean scores; empty unless both sides are scored."""
        if C.PROBABILITY not in self.numeric:
            return self.spark.createDataFrame([], OPERATIONS_SCHEMA)
        row = self.numeric_summary().where(F.col("feature") == C.PROBABILITY)
        return row.select(
            F.lit(self.threshold).alias("threshold"),
            F.round("psi", 4).alias("prediction_psi"),
            verdict(F.col("psi")).alias("prediction_verdict"),
            F.round("ref_alarms", 4).alias("alarm_rate_reference"),
            F.round("cur_alarms", 4).alias("alarm_rate_current"),
            F.round("ref_mean", 4).alias("mean_probability_reference"),
            F.round("cur_mean", 4).alias("mean_probability_current"),
        )

    def verdict(self, min_rows: int = C.MIN_ROWS) -> DataFrame:
        """The overall verdict with its inputs; p-values do not enter."""
        findings = self.table().select(F.lit("feature").alias("of"), "verdict").unionByName(
            self.operations().select(
                F.lit("prediction").alias("of"), F.col("prediction_verdict").alias("verdict")
            )
        )

        def features(value: str) -> Column:
            hit = (F.col("of") == "feature") & (F.col("verdict") == value)
            return F.coalesce(F.sum(hit.cast("long")), F.lit(0)).alias(value)

        found = findings.agg(
            F.collect_set("verdict").alias("verdicts"),  # four possible values
            F.coalesce(
                F.max(F.when(F.col("of") == "prediction", F.col("verdict"))), F.lit("stable")
            ).alias("prediction_verdict"),
            features("act"), features("watch"), features("unknown"),
        )
        rows = F.lit(self.current_rows)
        return found.select(
            F.lit(self.reference_rows).cast("long").alias("reference_rows"),
            rows.cast("long").alias("current_rows"),
            (rows >= min_rows).alias("enough_data"),
            worst_verdict(F.col("verdicts"), rows, min_rows).alias("verdict"),
            "prediction_verdict", "act", "watch", "unknown",
        )


DRIFT_SCHEMA = (
    "feature string, psi double, verdict string, test string, statistic double, p_value double,"
    " significant boolean, ref_mean double, cur_mean double, degenerate_reference boolean"
)
OPERATIONS_SCHEMA = (
    "threshold double, prediction_psi double, prediction_verdict string,"
    " alarm_rate_reference double, alarm_rate_current double,"
    " mean_probability_reference double, mean_probability_current double"
)


def _union(parts: Sequence[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def _per_category(both: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of both sides per category of each column; nulls are dropped."""
    cells = [x for i, c in enumerate(cols) for x in (F.lit(i), F.col(c).cast("string"))]
    rows = both.select("is_ref", F.stack(F.lit(len(cols)), *cells).alias("spec", "bin")).where("bin is not null")
    return rows.groupBy("spec", "bin").agg(*_side_counts()).select(
        _name(cols).alias("feature"), "bin", "n_ref", "n_cur"
    )


def _name(names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col("spec") + 1)


def category_counts(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of both sides per category over the union of categories; nulls are dropped."""
    return _per_category(_both(ref, cur, cols), cols)


def drift_table(ref: DataFrame, cur: DataFrame) -> DataFrame:
    return DriftCheck(ref, cur).table()


def operating_metrics(ref: DataFrame, cur: DataFrame) -> DataFrame:
    scored = [C.PROBABILITY]
    if not all(C.PROBABILITY in d.columns for d in (ref, cur)):
        scored = []
    return DriftCheck(ref.select(*scored), cur.select(*scored)).operations()


def drift_verdict(ref: DataFrame, cur: DataFrame, min_rows: int = C.MIN_ROWS) -> DataFrame:
    return DriftCheck(ref, cur).verdict(min_rows)


def psi_from_counts(
    binned: DataFrame, by: Sequence[str] = (), extra: Sequence[str] = ()
) -> DataFrame:
    """PSI per feature from (feature, bin, n_ref, n_cur) rows; null when a side is empty.

    ``extra`` columns are summed per feature.
    """
    keys = [*by, "feature"]
    totals = binned.groupBy(*keys).agg(
        F.sum("n_ref").alias("ref_rows"),
        F.sum("n_cur").alias("cur_rows"),
        *[F.sum(c).alias(c) for c in extra],
    )
    joined = binned.select(*keys, "n_ref", "n_cur").join(
        F.broadcast(totals), keys  # one row per feature
    )
    term = psi_term(F.try_divide("n_ref", "ref_rows"), F.try_divide("n_cur", "cur_rows"))
    usable = (F.col("ref_rows") > 0) & (F.col("cur_rows") > 0)
    return joined.groupBy(*keys, "ref_rows", "cur_rows", *extra).agg(
        F.sum(F.when(usable, term)).alias("psi")
    )


def chi2_from_counts(counts: DataFrame) -> DataFrame:
    """Chi-square homogeneity per feature, with continuity correction for two categories.

    Fewer than two categories give statistic 0 and p-value 1.
    """
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("r"), F.sum("n_cur").alias("c"), F.count("*").alias("k")
    )
    joined = counts.join(F.broadcast(totals), "feature")  # one row per feature
    row = F.col("n_ref") + F.col("n_cur")
    exp_ref = row * F.try_divide(F.col("r"), F.col("r") + F.col("c"))
    exp_cur = row * F.try_divide(F.col("c"), F.col("r") + F.col("c"))
    off = F.abs(F.col("n_ref") - exp_ref)
    off = F.when(F.col("k") == 2, off - F.least(F.lit(0.5), off)).otherwise(off)
    term = F.when(
        F.col("k") >= 2, F.try_divide(off * off, exp_ref) + F.try_divide(off * off, exp_cur)
    ).otherwise(0.0)
    out = joined.groupBy("feature").agg(
        F.sum(F.when((F.col("r") > 0) & (F.col("c") > 0), term)).alias("statistic"),
        (F.max("k") - 1).cast("int").alias("dof"),
    )
    return out.withColumn(
        "p", F.when(F.col("statistic").isNotNull(), chi2_p(F.col("statistic"), F.col("dof")))
    )


def feature_kinds(ref: DataFrame, cur: DataFrame, without: Sequence[str]) -> tuple[list, list]:
    """Common columns, numeric on both sides first, then the categorical rest."""
    common = common_columns(ref, cur, without)
    both = set(numeric_columns(ref)) & set(numeric_columns(cur))
    return [c for c in common if c in both], [c for c in common if c not in both]


def worst_verdict(verdicts: Column, rows: Column | None = None, min_rows: int = C.MIN_ROWS) -> Column:
    """The overall verdict from an array of verdicts; too few current rows suspend judgement."""
    worst = (
        F.when(F.array_contains(verdicts, "act"), "act")
        .when(F.array_contains(verdicts, "watch"), "watch").otherwise("stable")
    )
    return worst if rows is None else F.when(rows < min_rows, "too little data").otherwise(worst)


def confirmed(table: DataFrame) -> DataFrame:
    """Features whose test is significant and whose PSI is at least at the watch limit."""
    return table.where(F.col("significant") & (F.col("psi") >= C.PSI_WARN)).select(
        "feature", "psi", "verdict", "p_value"
    )


def operating_bands(log: DataFrame) -> DataFrame:
    """Service bands of a prediction log: alarm rate, median latency, error rate."""
    median = exact_percentiles(log, {"latency": F.col("latency_ms")}, [0.5])["latency"][0]
    totals = log.agg(
        F.round(F.avg(F.col("alarm").cast("int")), 6).alias("alarm_rate"),
        F.round(F.lit(median).cast("double"), 3).alias("median_latency_ms"),
        F.round(F.avg(F.col("failed").cast("int")), 6).alias("error_rate"),
    )
    a, m, e = F.col("alarm_rate"), F.col("median_latency_ms"), F.col("error_rate")
    return totals.withColumns({
        "alarm_band": F.when((a > 0.25) | (a < 0.01), "act")
        .when((a < 0.03) | (a > 0.10), "watch").otherwise("stable"),
        "latency_band": F.when(m > 200, "act").when(m >= 50, "watch").otherwise("stable"),
        "error_band": F.when(e > 0.05, "act").when(e >= 0.01, "watch").otherwise("stable"),
    })


class Bins(NamedTuple):
    """A column's bins against a reference: the bin of a value (null for null), the reference's counts."""

    number: Column
    reference: list[int]


def reference_bins(ref: DataFrame, cols: Sequence[str], bins: int = C.PSI_BINS) -> dict[str, Bins]:
    """Bins per column from the reference's quantiles: a few numbers per column."""
    edges = reference_edges(ref, cols, bins)
    number = {c: bin_sql(f"`{c}`", edges[c]) for c in cols}
    size = {c: max(1, len(edges[c]) - 1) for c in cols}
    cells = [(c, i) for c in cols for i in range(size[c])]
    numbered = ref.selectExpr(*[f"{number[c]} as `{c}`" for c in cols])
    row = numbered.selectExpr(*[f"count_if(`{c}` = {i}) as n{k}" for k, (c, i) in enumerate(cells)]).first()
    counts: dict[str, list[int]] = {c: [] for c in cols}
    for k, (c, _) in enumerate(cells):
        counts[c].append(row[f"n{k}"])
    return {c: Bins(F.expr(number[c]), counts[c]) for c in cols}


def psi_by_run(
    ref: DataFrame, cur: DataFrame, run: str, cols: Sequence[str], bins: int = C.PSI_BINS
) -> DataFrame:
    """PSI of every run (e.g. day) of a table against one reference, per column.

    The runs are counted in a single aggregate with one sum per column and bin, so no row is multiplied.
    """
    found = reference_bins(ref, cols, bins)
    numbered = cur.select(run, *[b.number.alias(c) for c, b in found.items()])  # once for all its sums
    wide = numbered.groupBy(run).agg(*[
        F.expr(f"sum(if(`{c}` = {i}, 1L, 0L)) as `{c}|{i}`") for c, b in found.items() for i in range(len(b.reference))
    ])
    cells = [
        f"'{c}', {r / sum(b.reference) if sum(b.reference) else 0.0!r}D, `{c}|{i}`"
        for c, b in found.items() for i, r in enumerate(b.reference)
    ]
    long = wide.select(F.col(run).alias("run"), F.expr(f"stack({len(cells)}, {', '.join(cells)}) as (feature, share, n)"))
    # a few rows per run and feature
    whole = Window.partitionBy("run", "feature")
    long = long.select("*", F.sum("n").over(whole).alias("total"), F.sum("share").over(whole).alias("reference"))
    term = psi_term(F.col("share"), F.try_divide("n", "total"))
    return long.groupBy("run", "feature").agg(
        F.sum(F.when((F.col("total") > 0) & (F.col("reference") > 0), term)).alias("psi")
    )


def persistent_drift(runs: DataFrame, length: int = C.PERSISTENCE_RUNS) -> DataFrame:
    """Per feature and run: a finding counts only if it held for ``length`` runs in a row.

    ``runs`` has columns run, feature, psi; one window per feature over its runs.
    """
    last = Window.partitionBy("feature").orderBy("run").rowsBetween(-(length - 1), 0)
    least = F.when(F.count("psi").over(last) == length, F.min("psi").over(last))
    lasting = F.when(least.isNull(), "stable").otherwise(verdict(least))
    return runs.select(
        "run", "feature", F.round("psi", 4).alias("psi"),
        verdict(F.col("psi")).alias("verdict"), lasting.alias("persistent_verdict"),
    )


def since_training(rows: DataFrame, day: Column, label: Column, trained_on: str) -> DataFrame:
    """Per day after the last training: rows labelled since then (``new_rows``) and ``days_since``.

    Rows without label do not count; a new training starts the count anew by its date.
    """
    daily = rows.where(day > F.lit(trained_on).cast("date")).groupBy(day.alias("run")).agg(
        F.count(label).alias("labelled")
    )
    upto = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, 0)  # one row per day
    return daily.select(
        "run",
        F.sum("labelled").over(upto).alias("new_rows"),
        F.datediff("run", F.lit(trained_on).cast("date")).alias("days_since"),
    )


def retrain_trigger(
    new_rows: Column, persistent_act: Column, days_since: Column
) -> list[Column]:
    """Retraining triggers in their order of precedence and whether any fired."""
    by_drift = persistent_act
    by_volume = new_rows >= C.RETRAIN_ROWS
    by_time = days_since >= C.RETRAIN_DAYS
    return [
        F.when(by_drift, "drift").when(by_volume, "volume").when(by_time, "schedule")
        .otherwise("none").alias("trigger"),
        (by_drift | by_volume | by_time).alias("retrain"),
    ]
