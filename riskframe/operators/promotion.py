"""Quality gate, run ledger, gated promotion, champion and the one-time final evaluation."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import metrics
from riskframe.operators.bootstrap import bootstrap_interval
from riskframe.session import stage
from riskframe.sources import versions as versioned

# limit -> (metric, comparison); limits themselves pass
RULES = {
    "min_pr_auc": ("pr_auc", "<"),
    "min_recall": ("recall", "<"),
    "max_expected_cost_eur": ("cost_eur", ">"),
}


def quality_gate(table: DataFrame, limits: dict[str, float | Column] = C.QUALITY_GATE) -> DataFrame:
    """Add all violations of the configured limits and whether the row passes.

    A metric that is absent or null is a violation; a limit that is not configured is not checked.
    """
    found = []
    for name, (metric, op) in RULES.items():
        if name not in limits:
            continue
        limit = limits[name]
        if metric not in table.columns:
            found.append(F.lit(f"{metric} missing"))
            continue
        value = F.col(metric)
        bound = limit if isinstance(limit, Column) else F.lit(float(limit))
        broken = value < bound if op == "<" else value > bound
        found.append(
            F.when(value.isNull(), F.lit(f"{metric} missing"))
            .when(broken, F.concat(F.lit(f"{metric}{op}"), F.format_string("%.2f", bound)))
        )
    return table.withColumn("violations", F.array_compact(F.array(*found))).withColumn(
        "passed", F.size("violations") == 0
    )


def cost_limit_for(rows: str = "rows", limit: float = C.QUALITY_GATE["max_expected_cost_eur"], per: int = 1500) -> Column:
    """The cost limit, stated for ``per`` rows, scaled to the rows actually evaluated."""
    return F.col(rows) * F.lit(limit / per)


LEDGER_COLUMNS = [
    "run_no", "run_name", "params", "rows", "pr_auc", "roc_auc", "recall", "precision", "cost_eur",
    "passed", "violations", "code_version", "status",
]


def ledger_rows(
    gated: DataFrame, params: Column, code_version: str, status: str = "finished", facts: dict[str, Column] | None = None
) -> DataFrame:
    """Ledger rows of gated runs (run_no, run_name and metrics are columns of ``gated``).

    ``facts`` are further columns, such as the durations of the run's steps.
    """
    return gated.withColumns({
        "params": params,
        "code_version": F.lit(code_version),
        "status": F.lit(status),
    }).select(*LEDGER_COLUMNS, *[v.alias(k) for k, v in (facts or {}).items()])


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add rows to the ledger; concurrent runs follow one another, none is lost."""

    def with_rows(ledger: DataFrame | None, _version) -> DataFrame:
        # one row per run: a snapshot is one small file
        return (rows if ledger is None else ledger.unionByName(rows, allowMissingColumns=True)).coalesce(1)

    versioned.update(rows.sparkSession, path, with_rows)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest snapshot of the ledger, or None before its first row."""
    return versioned.read(spark, path)


def failed_run(spark: SparkSession, run_no: int, run_name: str, error: str, code_version: str) -> DataFrame:
    """The ledger row of a run that raised; written so that failures leave a record too."""
    schema = (
        "run_no int, run_name string, params string, rows long, pr_auc double, roc_auc double,"
        " recall double, precision double, cost_eur double, passed boolean,"
        " violations array<string>, code_version string, status string"
    )
    row = (run_no, run_name, None, None, None, None, None, None, None, False, [], code_version, f"failed: {error}"[:500])
    return spark.createDataFrame([row], schema)


def versions(ledger: DataFrame) -> DataFrame:
    """Promoted versions: runs that passed, numbered in run order."""
    return ledger.where("passed").select(
        F.row_number().over(Window.orderBy("run_no")).cast("long").alias("version"),  # one row per passed run
        "run_no", "run_name", "pr_auc", "recall", "cost_eur",
    )


def champion(ledger: DataFrame, back: int = 0) -> DataFrame:
    """The newest passing version, or the one ``back`` versions before it (rollback)."""
    newest = F.row_number().over(Window.orderBy(F.desc("version")))
    return versions(ledger).withColumn("r", newest).where(F.col("r") == back + 1).drop("r")


def run_compare(ledger: DataFrame, names: list[str]) -> DataFrame:
    """Runs side by side: one row per metric, one column per named run."""
    long = metrics.metric_rows(ledger, ["run_name"])
    return long.groupBy("metric").agg(*[
        F.max(F.when(F.col("run_name") == n, F.col("value"))).alias(n) for n in names
    ])


def promote(
    spark: SparkSession,
    gated: DataFrame,
    ledger_path: str,
    save: Callable[[str], None],
    model_path: str,
    params: Column,
    code_version: str,
    facts: dict[str, Column] | None = None,
) -> bool:
    """Record the run, and save the model as a new version only if the gate passed.

    A failing run leaves every earlier version untouched.
    """
    gated = stage(gated, "gated-run")  # one row; the evaluation behind it runs once
    run = gated.select("run_no", "passed").first()
    if run["passed"]:  # first the model: a recorded version always has one
        save(f"{model_path}/version={run['run_no']}")
    append_ledger(ledger_rows(gated, params, code_version, facts=facts), ledger_path)
    return run["passed"]


def final_evaluation(
    df: DataFrame,
    draws: int = C.BOOTSTRAP_DRAWS,
    threshold: float = C.THRESHOLD,
    interval_digits: int = 4,
) -> DataFrame:
    """Test metrics with intervals, cost and saving, gap to validation, and the gate check."""
    both = metrics.evaluate(df.where("split in ('val', 'test')"), threshold, by=["split"])
    compared = ["pr_auc", "roc_auc", "recall", "precision"]
    row = both.agg(
        F.max(F.when(F.col("split") == "test", F.struct(*[c for c in both.columns if c != "split"]))).alias("t"),
        *[F.max(F.when(F.col("split") == "val", F.col(m))).alias(f"v_{m}") for m in compared],
    ).select("t.*", *[f"v_{m}" for m in compared])
    gated = quality_gate(
        row, {**C.QUALITY_GATE, "max_expected_cost_eur": cost_limit_for()}
    )
    ends = bootstrap_interval(
        df.where("split = 'test'"), draws, threshold, digits=interval_digits
    ).first()  # one row
    interval = {
        c: F.lit(ends[c]).cast("double")
        for c in ("pr_auc_low", "pr_auc_high", "recall_low", "recall_high")
    }
    gaps = [
        F.round(F.col(m) - F.col(f"v_{m}"), 6).alias(f"{m}_gap") for m in compared
    ]
    return gated.withColumns(interval).select(
        "rows", "failures", "pr_auc", "pr_auc_low", "pr_auc_high", "roc_auc", "recall",
        "recall_low", "recall_high", "precision", "tp", "fp", "fn", "tn", "cost_eur",
        "do_nothing_eur", "saving_eur", *gaps, "passed",
        F.concat_ws(",", "violations").alias("violations"),
    )


def final_evaluation_once(
    df: DataFrame,
    path: str,
    force: bool = False,
    reason: str | None = None,
    draws: int = C.BOOTSTRAP_DRAWS,
) -> DataFrame:
    """Run the final evaluation and store it; a second run needs ``force`` and a reason."""
    if force and not reason:
        raise ValueError("a forced repetition needs a reason")
    spark = df.sparkSession
    earlier = versioned.latest(spark, path)
    if earlier is not None and not force:
        raise RuntimeError("the final evaluation has been run; force it with a reason to repeat it")
    before = None if earlier is None else versioned.read(spark, path, earlier.number)
    # the test set is claimed before it is looked at: of two runs that start together one is refused
    claim = spark.createDataFrame([(earlier is None, reason if earlier else None)], "first_run boolean, repeat_reason string")
    claim = claim.withColumns({"measured_at": F.current_timestamp(), "state": F.lit("claimed")})
    kept = claim if before is None else before.unionByName(claim, allowMissingColumns=True)
    try:
        claimed = versioned.commit(kept.coalesce(1), path, earlier.number if earlier else 0, {"state": "claimed"})
    except versioned.CommitConflict as lost:
        raise RuntimeError("another run is doing the final evaluation; force it with a reason to repeat it") from lost
    row = final_evaluation(df, draws).withColumns({
        "first_run": F.lit(earlier is None),
        "repeat_reason": F.lit(reason if earlier is not None else None).cast("string"),
        "measured_at": F.current_timestamp(),
        "state": F.lit("measured"),
    })
    rows = row if before is None else before.unionByName(row, allowMissingColumns=True)
    versioned.commit(rows.coalesce(1), path, claimed.number, {"state": "measured"})
    return read_ledger(spark, path)
