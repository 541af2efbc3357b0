"""Error slicing: where a scored table's misses, false alarms and costs lie."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.decision import alarm, error_kind, expected_cost, ratio_or_null
from riskframe.operators.profiling import band_labels, band_number, quantile_edges

BANDS = C.SLICE_BANDS
SLICES = ["type", *BANDS]
CROSSES = C.SLICE_CROSSES
PARTS = 4
OTHER, MISSING = "other", "missing"


def attach_causes(scored: DataFrame, states: DataFrame, key: str = C.KEY) -> DataFrame:
    """Bring the cause flags to scored rows by key; one flag row per key.

    A plain equi-join: the planner broadcasts a small side by its measured size, and splits a
    skewed key's partition otherwise.
    """
    causes = states.groupBy(key).agg(*[F.max(c).alias(c) for c in C.CAUSES])
    return scored.join(causes, key)


def slice_cells(df: DataFrame, threshold: float = C.THRESHOLD) -> tuple[DataFrame, dict]:
    """Counts per combination of all slice values, and the label of each slice value.

    At most (types + 1) x 5^5 rows, from one pass with map-side combining; every slice, cross and
    overall metric is a sum over these cells. No row is left out: types that are not listed (or null) share the
    value "other", rows without a measure the last band, "missing".
    """
    edges = quantile_edges(df, list(BANDS.values()))
    last = len(C.TYPES) + 1
    labels = {"type": {**dict(enumerate(C.TYPES, 1)), last: OTHER}}
    order = F.array_position(F.array(*[F.lit(t) for t in C.TYPES]), F.col("type")).cast("int")
    numbers = [F.when(order > 0, order).otherwise(last).alias("type")]
    for name, col in BANDS.items():
        numbers.append(F.coalesce(band_number(col, edges[col]), F.lit(PARTS + 1)).alias(name))
        labels[name] = {**dict(enumerate(band_labels(edges[col]), 1)), PARTS + 1: MISSING}
    kind = error_kind(C.TARGET, alarm(threshold=threshold)).alias("kind")

    def n(value: str, alias: str) -> Column:
        return F.sum((F.col("kind") == value).cast("long")).alias(alias)

    cells = df.select(*numbers, kind).groupBy(*SLICES).agg(
        F.count("*").alias("rows"), n("TP", "tp"), n("FP", "fp"), n("FN", "fn")
    )
    return cells, labels


def _sums(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    return cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("rows", "tp", "fp", "fn")])


def _metrics(sums: DataFrame) -> DataFrame:
    """Slice metrics; recall, precision and F1 are null, not 0, where they are undefined."""
    positives = F.col("tp") + F.col("fn")
    alarms = F.col("tp") + F.col("fp")
    # 2PR/(P+R) equals 2TP/(2TP+FP+FN); undefined without positives, alarms or hits
    f1 = F.when(
        (positives > 0) & (alarms > 0) & (F.col("tp") > 0),
        F.round(F.col("tp") * 2 / (F.col("tp") * 2 + F.col("fp") + F.col("fn")), 6),
    )
    return sums.withColumns({
        "failures": positives,
        "failure_rate": ratio_or_null(positives, "rows"),
        "recall": ratio_or_null("tp", positives),
        "precision": ratio_or_null("tp", alarms),
        "f1": f1,
        "cost_eur": expected_cost(),
    })


def overall_metrics(cells: DataFrame) -> DataFrame:
    return _metrics(_sums(cells, []))


def slice_metrics(cells: DataFrame, labels: dict) -> DataFrame:
    """Metrics and cost share for every value of every slice."""
    picks = F.array(*[
        F.struct(F.lit(s).alias("slice"), F.col(s).alias("value_no")) for s in labels
    ])
    long = cells.select(F.explode(picks).alias("p"), "rows", "tp", "fp", "fn").select(
        "p.*", "rows", "tp", "fp", "fn"
    )
    table = _metrics(_sums(long, ["slice", "value_no"]))
    total = F.sum("cost_eur").over(Window.partitionBy("slice"))
    return table.withColumns({
        "value": _label(labels, F.col("slice"), F.col("value_no")),
        "cost_share": F.round(F.coalesce(F.try_divide(F.col("cost_eur"), total), F.lit(0.0)), 6),
    })


def _label(labels: dict, name: Column, number: Column) -> Column:
    pairs = F.create_map(*[
        x for s, values in labels.items() for i, v in values.items()
        for x in (F.lit(f"{s}|{i}"), F.lit(v))
    ])
    return pairs[F.concat_ws("|", name, number.cast("string"))]


def cross_metrics(
    cells: DataFrame,
    labels: dict,
    pair: tuple[str, str],
    metric: str = "recall",
    min_rows: int = C.MIN_SLICE_ROWS,
) -> DataFrame:
    """A metric and the cell size for two slices at once, columns in the second slice's order.

    The metric is null below ``min_rows`` rows; the size is always shown.
    """
    a, b = pair
    columns = range(1, PARTS + 2)  # the last one: rows that are in no band
    table = _metrics(_sums(cells, [a, b])).withColumn(
        "m", F.when(F.col("rows") >= min_rows, F.col(metric))
    )
    wide = table.groupBy(a).agg(
        *[F.max(F.when(F.col(b) == i, F.col("m"))).alias(f"{metric}_{i}") for i in columns],
        *[F.max(F.when(F.col(b) == i, F.col("rows"))).alias(f"rows_{i}") for i in columns],
    )
    return wide.select(
        F.lit(f"{a} x {b}").alias("pair"),
        F.col(a).alias("row_no"),
        _label(labels, F.lit(a), F.col(a)).alias("row_value"),
        *[f"{metric}_{i}" for i in columns],
        *[f"rows_{i}" for i in columns],
    )


def metrics_by_cause(df: DataFrame, threshold: float = C.THRESHOLD) -> DataFrame:
    """Found and missed failures per cause; groups overlap where a failure has several causes.

    Causes without failures stay in the table with null recall; the row for failures without any
    recorded cause appears only if there are such failures.
    """
    failed = F.col(C.TARGET) == 1
    hit = alarm(threshold=threshold)
    groups = {c: F.col(c) == 1 for c in C.CAUSES}
    groups["none recorded"] = F.greatest(*[F.col(c) for c in C.CAUSES]) == 0
    wide = df.where(failed).agg(*[
        F.struct(
            F.coalesce(F.sum(cond.cast("long")), F.lit(0)).alias("failures"),
            F.coalesce(F.sum((cond & hit).cast("long")), F.lit(0)).alias("found"),
            F.round(F.avg(F.when(cond, F.col(C.PROBABILITY))), 6).alias("mean_probability"),
        ).alias(name)
        for name, cond in groups.items()
    ])
    rows = F.array(*[
        F.struct(F.lit(name).alias("cause"), F.col(f"`{name}`").alias("s")) for name in groups
    ])
    return (
        wide.select(F.explode(rows).alias("p")).select("p.cause", "p.s.*")
        .where((F.col("cause") != "none recorded") | (F.col("failures") > 0))
        .withColumn("missed", F.col("failures") - F.col("found"))
        .withColumn("recall", ratio_or_null("found", "failures"))
    )


def worst_slices(
    cells: DataFrame,
    labels: dict,
    min_rows: int = C.MIN_SLICE_ROWS,
    top: int = C.WORST_SLICES,
) -> DataFrame:
    """The slices with the largest recall gap to the whole table, worst first."""
    table = slice_metrics(cells, labels)
    overall = F.try_divide(
        F.sum("tp").over(Window.partitionBy("slice")),
        F.sum(F.col("tp") + F.col("fn")).over(Window.partitionBy("slice")),
    )
    gap = F.round(F.try_divide(F.col("tp"), F.col("failures")) - overall, 6)
    return (
        table.withColumn("recall_gap", gap)
        .where((F.col("rows") >= min_rows) & (F.col("failures") > 0))
        .select(
            "slice", "value_no", "value", "rows", "failures", "recall", "recall_gap", "fn",
            "cost_eur", "cost_share",
        )
        .orderBy("recall_gap", "slice", "value_no")
        .limit(top)
    )
