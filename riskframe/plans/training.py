"""A complete training run: check, split, fit, evaluate, gate, store, and record."""

import time
from contextlib import contextmanager

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions.features import drop_leakage
from riskframe.operators import contract, metrics, models, promotion, splits
from riskframe.session import stage
from riskframe.sources import ingest, stores


class Steps:
    """How long the steps of a run took, and the fingerprint of its data."""

    def __init__(self):
        self.seconds: dict[str, float] = {}
        self.fingerprint: str | None = None

    @contextmanager
    def of(self, name: str):
        """Time a step, also one that raises."""
        start = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = round(time.monotonic() - start, 3)

    def facts(self) -> dict[str, Column]:
        pairs = [F.lit(x) for item in self.seconds.items() for x in item]
        return {
            "step_seconds": F.create_map(*pairs).cast("map<string,double>"),
            "fingerprint": F.lit(self.fingerprint).cast("string"),
        }


def train_run(
    states: DataFrame,
    store: str,
    run_no: int,
    run_name: str,
    estimator: Estimator | None = None,
    code_version: str = "unknown",
    threshold: float = C.THRESHOLD,
    limits: dict | None = None,
) -> bool:
    """Train on ``states`` and promote the model if the gate passes.

    Below ``store``: the split table, the run ledger, one directory per promoted version (model
    with its threshold), and the drift reference sample of the newest promoted version. The ledger row tells
    how long each step took and the fingerprint of the data; a run that raises is recorded as
    failed, with the steps it got through, before the error goes on.
    """
    spark = states.sparkSession
    ledger, steps = f"{store}/ledger", Steps()
    try:
        with steps.of("fingerprint"):
            mark = ingest.table_fingerprint(states, [C.KEY, *C.INPUT_FIELDS, C.TARGET]).first()  # one row
            steps.fingerprint = f"{mark['rows']}:{mark['hash_sum']}:{mark['hash_min']}:{mark['hash_max']}"
        with steps.of("contract"):
            contract.require_valid(states)
        with steps.of("split"):
            stores.write_splits(splits.stratified_split(drop_leakage(states)), f"{store}/splits")
        train = stores.read_split(spark, f"{store}/splits", "train")
        val = stores.read_split(spark, f"{store}/splits", "val").drop("split")
        with steps.of("fit"):
            model = models.fit(train, estimator or models.random_forest())
        with steps.of("evaluate"):
            scored = models.score(model, val)
            table = stage(metrics.evaluate(scored, threshold), "run-metrics").withColumns({
                "run_no": F.lit(run_no), "run_name": F.lit(run_name)
            })
        bounds = {**C.QUALITY_GATE, "max_expected_cost_eur": promotion.cost_limit_for()}
        passed = promotion.promote(
            spark, promotion.quality_gate(table, limits or bounds), ledger,
            lambda path: models.save_model(model, path, threshold, run_name=run_name),
            f"{store}/models", F.lit(f"threshold={threshold}"), code_version, steps.facts(),
        )
        if passed:
            stores.write_reference(splits.uniform_sample(scored), f"{store}/reference")
        return passed
    except Exception as e:
        failed = promotion.failed_run(spark, run_no, run_name, str(e), code_version)
        promotion.append_ledger(failed.withColumns(steps.facts()), ledger)
        raise
