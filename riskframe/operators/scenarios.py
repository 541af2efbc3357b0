"""What-if scenarios: perturb a table, score it again, compare drift, quality and cost."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.decision import alarm, error_kind, expected_cost, ratio_or_zero
from riskframe.functions.stats import verdict
from riskframe.operators.drift import (
    bin_sql,
    psi_from_counts,
    reference_edges,
    worst_verdict,
)
from riskframe.operators.splits import first_share
from riskframe.session import stage


@dataclass
class Scenario:
    """Replacement columns for some input fields; labels are never changed.

    ``changes`` receives the current table, so a scenario may look up what it needs of it.
    """

    description: str
    changes: Callable[[DataFrame], dict[str, Column]] = field(default=lambda df: {})

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.changes(df))


SCENARIOS = {
    "control": Scenario("the table as it is, to compare with"),
    "temperature_calibration": Scenario(
        "sensor offset: + 3 K on the process temperature",
        lambda df: {"process_temperature_k": F.col("process_temperature_k") + 3.0},
    ),
    "high_wear": Scenario(
        "later tool changes: + 60 min of wear",
        lambda df: {"tool_wear_min": F.col("tool_wear_min") + 60},
    ),
    "type_shift": Scenario(
        "product mix: four of five parts become type H",
        lambda df: {"type": F.when(first_share(df, 0.8), "H").otherwise(F.col("type"))},
    ),
}


def scenario_rows(df: DataFrame, scenarios: dict[str, Scenario] = SCENARIOS) -> DataFrame:
    """One row per scenario and row, from a single scan; columns outside the inputs are kept."""
    variants = []
    for name, s in scenarios.items():
        new = s.changes(df)
        variants.append(F.struct(
            F.lit(name).alias("scenario"),
            *[
                new.get(c, F.col(c)).cast(df.schema[c].dataType).alias(c)
                for c in C.INPUT_FIELDS
            ],
        ))
    rest = [c for c in df.columns if c not in C.INPUT_FIELDS]
    return df.select(*rest, F.explode(F.array(*variants)).alias("v")).select(*rest, "v.*")


def scenario_table(
    ref: DataFrame,
    cur: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    scenarios: dict[str, Scenario] = SCENARIOS,
    threshold: float = C.THRESHOLD,
) -> DataFrame:
    """Drift, alarm rate, quality and cost of every scenario against one reference.

    All scenarios are scored and counted in one job: a scenario's row adds to one conditional sum for each
    bin and outcome, grouped by scenario and category, so no row is multiplied by its columns.
    """
    edges = reference_edges(ref, [*C.MEASURES, C.PROBABILITY])
    numeric = [*C.MEASURES, C.PROBABILITY]
    bins = [(c, i) for c in numeric for i in range(max(1, len(edges[c]) - 1))]
    kinds = ["TP", "FP", "FN", "TN"]

    def cells(df: DataFrame, side: int, keys: Sequence[str]) -> DataFrame:
        # as text: hundreds of column objects take longer to build than to run
        df = df.selectExpr("*", *[f"{bin_sql(c, edges[c])} as `__{c}`" for c in numeric])  # once for all its sums
        sums = [F.expr(f"sum(if(`__{c}` = {i}, 1L, 0L)) as b{k}") for k, (c, i) in enumerate(bins)]
        packed = [f"'{c}', '{i}', b{k}" for k, (c, i) in enumerate(bins)] + ["'type', cast(type as string), of_type"]
        if not side:
            df = df.withColumn("__kind", error_kind(C.TARGET, alarm(threshold=threshold)))
            sums += [F.expr(f"sum(if(__kind = '{name}', 1L, 0L)) as {name}") for name in kinds]
            packed += [f"'outcome', '{name}', {name}" for name in kinds]
        wide = df.groupBy(*keys, "type").agg(F.count("*").alias("of_type"), *sums)
        entries = F.expr(f"stack({len(packed)}, {', '.join(packed)}) as (feature, bin, n)")
        n = F.coalesce("n", F.lit(0))
        zero = F.lit(0).cast("long")
        return wide.select(*keys, entries).where("bin is not null").select(
            *keys, "feature", "bin", (n if side else zero).alias("n_ref"), (zero if side else n).alias("n_cur")
        )

    names = F.array(*[F.lit(n) for n in scenarios])
    reference = cells(ref, 1, []).withColumn("scenario", F.explode(names))
    current = cells(score(scenario_rows(cur, scenarios)), 0, ["scenario"])
    counts = reference.unionByName(current).groupBy("scenario", "feature", "bin").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    ).where("n_ref + n_cur > 0")
    counts = stage(counts, "scenario-counts")  # a row per scenario and bin, read for drift and outcomes
    psi = psi_from_counts(counts.where("feature <> 'outcome'"), ["scenario"])
    inputs = F.col("feature") != C.PROBABILITY
    drift = psi.groupBy("scenario").agg(
        F.max(F.when(inputs, F.round("psi", 4))).alias("max_psi"),
        # largest rounded PSI, first name among equals
        F.min(F.when(inputs, F.struct(-F.round("psi", 4), F.col("feature")))).alias("worst"),
        F.max(F.when(~inputs, F.round("psi", 4))).alias("prediction_psi"),
        F.max(F.when(~inputs, verdict(F.col("psi")))).alias("prediction_verdict"),
        F.collect_set(verdict(F.col("psi"))).alias("verdicts"),  # four possible values
    )
    outcome = counts.where("feature = 'outcome'").groupBy("scenario").agg(*[
        F.sum(F.when(F.col("bin") == k.upper(), F.col("n_cur")).otherwise(0)).alias(k)
        for k in ("tp", "fp", "fn", "tn")
    ])
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    return drift.join(F.broadcast(outcome), "scenario").select(  # one row per scenario
        "scenario",
        worst_verdict(F.col("verdicts")).alias("verdict"),
        "max_psi",
        F.col("worst.feature").alias("max_psi_feature"),
        "prediction_psi", "prediction_verdict",
        ratio_or_zero(tp + fp, tp + fp + fn + tn, 4).alias("alarm_rate"),
        ratio_or_zero(tp, tp + fn, 4).alias("recall"),
        ratio_or_zero(tp, tp + fp, 4).alias("precision"),
        expected_cost().alias("cost_eur"),
    )


def _with_control(table: DataFrame) -> DataFrame:
    """Every other scenario with the control's numbers beside it (one row per scenario)."""
    whole = Window.partitionBy()
    control = F.col("scenario") == "control"
    beside = {
        f"c_{c}": F.max(F.when(control, F.col(c))).over(whole)
        for c in ("alarm_rate", "recall", "cost_eur")
    }
    return table.withColumns(beside).where(~control)


def silent_failure(table: DataFrame) -> DataFrame:
    """The scenario whose recall falls most while the alarm rate looks normal."""
    quiet = F.abs(F.col("alarm_rate") - F.col("c_alarm_rate")) <= 0.25 * F.col("c_alarm_rate")
    drop = F.round(F.col("c_recall") - F.col("recall"), 4)
    return (
        _with_control(table).withColumn("recall_drop", drop)
        .where(quiet & (F.col("recall_drop") >= 0.05))
        .orderBy(F.desc("recall_drop"), "scenario").limit(1)
        .select("scenario", "alarm_rate", "recall", "recall_drop", "max_psi", "prediction_psi")
    )


def harmless_drift(table: DataFrame) -> DataFrame:
    """Scenarios with a drift alarm but unchanged recall and cost."""
    return (
        _with_control(table)
        .where(
            (F.col("verdict") == "act")
            & (F.col("recall") >= F.col("c_recall") - 0.01)
            & (F.abs(F.col("cost_eur") - F.col("c_cost_eur")) < 1.0)
        )
        .select("scenario", "max_psi", "max_psi_feature", "recall", "cost_eur")
    )


def self_check(table: DataFrame) -> DataFrame:
    """The control must be stable and every other scenario must be noticed."""
    control = F.col("scenario") == "control"
    stable = F.col("verdict") == "stable"
    return table.agg(
        F.bool_and(F.when(control, stable)).alias("control_stable"),
        F.bool_and(F.when(~control, ~stable)).alias("all_noticed"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(~control & stable, F.col("scenario"))))).alias(
            "unnoticed"
        ),
    ).withColumn("passed", F.col("control_stable") & F.col("all_noticed"))
