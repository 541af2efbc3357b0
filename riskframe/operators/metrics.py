"""Classification metrics and costs, all derived from counts per distinct score."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.decision import (
    alarm,
    do_nothing_cost,
    expected_cost,
    outcome_counts,
    ratio_or_zero,
)


def confusion_counts(df: DataFrame, threshold: float = C.THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, recall and precision (0 where undefined) at one threshold."""
    counts = df.groupBy(*by).agg(*outcome_counts(C.TARGET, alarm(threshold=threshold)))
    return counts.withColumns({
        "recall": ratio_or_zero("tp", F.col("tp") + F.col("fn")),
        "precision": ratio_or_zero("tp", F.col("tp") + F.col("fp")),
    })


def cost_summary(df: DataFrame, threshold: float = C.THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    """Expected cost, cost of never acting, and the saving."""
    counts = df.groupBy(*by).agg(*outcome_counts(C.TARGET, alarm(threshold=threshold)))
    return counts.select(
        *by,
        expected_cost().alias("cost_eur"),
        do_nothing_cost(F.col("tp") + F.col("fn")).alias("do_nothing_eur"),
        (do_nothing_cost(F.col("tp") + F.col("fn")) - expected_cost()).alias("saving_eur"),
    )


def score_counts(
    df: DataFrame,
    by: Sequence[str] = (),
    score: str = C.PROBABILITY,
    label: str = C.TARGET,
    weight: Column | None = None,
) -> DataFrame:
    """Rows and positives per distinct score.

    Scores carry six decimals, so this has at most 1,000,001 rows per group however large the
    table is; it is the input of every ranking metric.
    """
    w = weight if weight is not None else F.lit(1)
    return df.groupBy(*by, score).agg(
        F.sum(w).alias("n"), F.sum(w * F.col(label)).alias("pos")
    )


def with_ranking(counts: DataFrame, by: Sequence[str] = (), score: str = C.PROBABILITY) -> DataFrame:
    """Add the rows and positives at or above each score."""
    above = (
        Window.partitionBy(*by).orderBy(F.desc(score))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return counts.withColumns({
        "cum_n": F.sum("n").over(above), "cum_pos": F.sum("pos").over(above)
    })


def average_precision_column() -> Column:
    """Sum over distinct scores of the recall step times the precision there."""
    return F.try_divide(
        F.sum(F.col("pos") * F.try_divide(F.col("cum_pos"), F.col("cum_n"))), F.sum("pos")
    )


def roc_auc_column() -> Column:
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    neg = F.col("n") - F.col("pos")
    pos_above = F.col("cum_pos") - F.col("pos")
    pairs = F.sum((neg * (pos_above + F.col("pos") / 2)).cast("double"))
    return F.try_divide(pairs, F.sum("pos").cast("double") * F.sum(neg).cast("double"))


def average_precision(
    df: DataFrame, by: Sequence[str] = (), digits: int = 6, weight: Column | None = None
) -> DataFrame:
    ranked = with_ranking(score_counts(df, by, weight=weight), by)
    return ranked.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.sum("pos").cast("long").alias("failures"),
        F.round(average_precision_column(), digits).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    ranked = with_ranking(score_counts(df, by), by)
    return ranked.groupBy(*by).agg(F.round(roc_auc_column(), digits).alias("roc_auc"))


def evaluate(
    df: DataFrame, threshold: float = C.THRESHOLD, by: Sequence[str] = (), digits: int = 6
) -> DataFrame:
    """All metrics of a scored table at a threshold, from one pass over it."""
    return evaluate_counts(score_counts(df, by), threshold, by, digits)


def evaluate_counts(
    counts: DataFrame, threshold: float = C.THRESHOLD, by: Sequence[str] = (), digits: int = 6
) -> DataFrame:
    hit = alarm(threshold=threshold)
    neg = F.col("n") - F.col("pos")

    def where(cond: Column, what: Column) -> Column:
        return F.sum(F.when(cond, what).otherwise(0)).cast("long")

    totals = with_ranking(counts, by).groupBy(*by).agg(
        F.sum("n").cast("long").alias("rows"),
        F.sum("pos").cast("long").alias("failures"),
        F.round(average_precision_column(), digits).alias("pr_auc"),
        F.round(roc_auc_column(), digits).alias("roc_auc"),
        where(hit, F.col("pos")).alias("tp"),
        where(hit, neg).alias("fp"),
        where(~hit, F.col("pos")).alias("fn"),
        where(~hit, neg).alias("tn"),
    )
    return totals.withColumns({
        "recall": ratio_or_zero("tp", F.col("tp") + F.col("fn"), digits),
        "precision": ratio_or_zero("tp", F.col("tp") + F.col("fp"), digits),
        "cost_eur": expected_cost(),
        "do_nothing_eur": do_nothing_cost("failures"),
        "saving_eur": do_nothing_cost("failures") - expected_cost(),
    })


METRIC_COLUMNS = ["pr_auc", "roc_auc", "recall", "precision", "cost_eur"]


def metric_rows(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per metric instead of one column per metric."""
    return metrics.unpivot(
        list(by), [F.col(m).cast("double").alias(m) for m in METRIC_COLUMNS], "metric", "value"
    )


def metric_gap(df: DataFrame, left: str, right: str, digits: int = 6) -> DataFrame:
    """Metrics of two splits side by side with the gap ``left - right``."""
    both = evaluate(df.where(F.col("split").isin(left, right)), by=["split"])
    return (
        metric_rows(both, ["split"])
        .groupBy("metric")
        .agg(
            F.max(F.when(F.col("split") == left, F.col("value"))).alias(left),
            F.max(F.when(F.col("split") == right, F.col("value"))).alias(right),
        )
        .withColumn("gap", F.round(F.col(left) - F.col(right), digits))
    )


def baseline_rules(train: DataFrame, val: DataFrame, key: str = C.KEY) -> DataFrame:
    """"Never alarm" and "alarm at random with the class rate", evaluated on ``val``.

    The random draw is a hash of the row key, so a rerun after a lost executor repeats it.
    """
    rate = train.agg(F.avg(C.TARGET).alias("rate")).first()["rate"]
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("baseline|"), F.col(key))), 1, 8), 16, 10).cast(
        "double"
    ) / float(2**32)
    rules = F.array(
        F.struct(F.lit("never").alias("rule"), F.lit(0.0).alias(C.PROBABILITY)),
        F.struct(
            F.lit("random").alias("rule"),
            F.when(draw < F.lit(rate), 1.0).otherwise(0.0).alias(C.PROBABILITY),
        ),
    )
    exploded = val.select(C.TARGET, F.explode(rules).alias("r")).select(C.TARGET, "r.*")
    return evaluate(exploded, C.DEFAULT_THRESHOLD, by=["rule"]).select(
        "rule", "pr_auc", "roc_auc", "recall", "precision", "cost_eur"
    )


def score_distribution(df: DataFrame, score: str = C.PROBABILITY) -> DataFrame:
    """Count, mean, spread, percentiles and shares at or above both thresholds."""
    counts = df.groupBy(score).agg(F.count("*").alias("n"))
    x, n = F.col(score), F.col("n")
    total = F.sum(n)
    mean = F.sum(x * n) / total
    spread = F.sqrt((F.sum(x * x * n) - F.pow(F.sum(x * n), 2) / total) / (total - 1))
    probs = [0.5, 0.9, 0.95, 0.99]
    q = F.percentile(score, probs, n)
    return counts.agg(
        total.alias("rows"),
        F.round(mean, 6).alias("mean"),
        F.round(spread, 6).alias("std"),
        F.min(x).alias("min"),
        *[F.round(q[i], 6).alias(f"p{int(p * 100)}") for i, p in enumerate(probs)],
        F.max(x).alias("max"),
        F.round(F.sum(F.when(x >= C.DEFAULT_THRESHOLD, n).otherwise(0)) / total, 6).alias(
            "share_at_default"
        ),
        F.round(F.sum(F.when(x >= C.THRESHOLD, n).otherwise(0)) / total, 6).alias(
            "share_at_threshold"
        ),
    )
