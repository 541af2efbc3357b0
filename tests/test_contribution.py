"""Permutation importance, and drift that concerns the scorer."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import contribution


@pytest.fixture
def table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((f"k{i}", a, b, c, int(rng.random() < 0.8 * a * a + 0.1 * b)))
    return spark.createDataFrame(rows, f"{C.KEY} string, a double, b double, c double, {C.TARGET} int")


def scorer(df):
    return df.withColumn(C.PROBABILITY, F.round(0.8 * F.col("a") ** 2 + 0.1 * F.col("b"), 6))


@pytest.mark.parametrize("lots", [None, 1, 7, 4000])
def test_variants_are_permutations(table, lots):
    out = contribution.permuted(table, ["a", "b", "c"], lots=lots).toPandas()
    plain = table.toPandas().set_index(C.KEY)
    for name, part in out.groupby("permuted"):
        part = part.set_index(C.KEY).loc[plain.index]
        for c in ("a", "b", "c"):
            if c == name:
                assert sorted(part[c]) == sorted(plain[c])
                assert lots == 4000 or (part[c] != plain[c]).mean() > 0.98
            else:
                assert (part[c] == plain[c]).all()
        assert (part[C.TARGET] == plain[C.TARGET]).all()


def test_large_lots_are_ordered_in_ranges(table, monkeypatch):
    def pairs(df):
        return sorted(tuple(r) for r in df.collect())

    rows = table.unionByName(table.where("a < 0.2").withColumn("b", F.col("b") / 2))  # some keys come twice
    whole = contribution.permuted(rows, ["a", "b", "c"], lots=2)
    monkeypatch.setattr(contribution, "LOT", 50)
    cut = contribution.permuted(rows, ["a", "b", "c"], lots=2)
    assert pairs(cut) == pairs(whole)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan.split("Window", 1)[1]  # a lot is not one group
    assert cut.count() == 4 * rows.count()


def test_importance_ranks_the_features(table):
    got = {r["feature"]: r["importance"] for r in contribution.permutation_importance(table, ["a", "b", "c"], scorer).collect()}
    assert got["a"] > 0.2 > got["b"] > -0.02 and got["c"] == 0.0


def test_only_drift_of_contributing_features_triggers(spark):
    runs = spark.createDataFrame(
        [(1, "a", "stable"), (1, "c", "act"), (2, "a", "act"), (2, "c", "act"), (3, "a", "watch"), (3, "x", "act")],
        "run int, feature string, persistent_verdict string",
    )
    importance = spark.createDataFrame([("a", 0.3, 0.2), ("c", 0.5, 0.0)], "feature string, pr_auc double, importance double")
    got = {r["run"]: (r["contributing"], r["other"], r["retrain"]) for r in contribution.contributing_drift(runs, importance).collect()}
    assert got == {1: ("", "c", False), 2: ("a", "c", True), 3: ("", "x", False)}
