"""Versioned tables: one winner per version, no lost updates, whole snapshots."""

import os
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F
from score_tables import scored

from riskframe.operators import promotion
from riskframe.sources import versions


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int").coalesce(1)


def test_of_two_writers_from_one_version_exactly_one_wins(spark, tmp_path):
    root = str(tmp_path / "a table")

    def write(k):
        try:
            return versions.commit(numbers(spark, k), root, 0, {"by": k}).meta["by"]
        except versions.CommitConflict:
            return None

    with ThreadPool(4) as pool:
        won = [k for k in pool.map(write, range(4)) if k is not None]
    assert len(won) == 1
    assert versions.latest(spark, root).meta == {"by": won[0]}
    assert [r["n"] for r in versions.read(spark, root).collect()] == won
    # the losers leave nothing behind
    assert sum(n.startswith("data-") for n in os.listdir(root)) == 1
    assert os.listdir(f"{root}/_versions") != [] and not [n for n in os.listdir(f"{root}/_versions") if n.startswith("_")]


def test_concurrent_updates_follow_one_another(spark, tmp_path):
    root = str(tmp_path / "t")

    def add(k):
        versions.update(spark, root, lambda now, _: numbers(spark, k) if now is None else now.union(numbers(spark, k)))

    with ThreadPool(4) as pool:
        pool.map(add, range(6))
    assert sorted(r["n"] for r in versions.read(spark, root).collect()) == list(range(6))
    assert versions.latest(spark, root).number == 6
    assert versions.read(spark, root, 2).count() == 2  # earlier versions stay readable


def test_nothing_yet_and_nothing_to_do(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.latest(spark, root) is None and versions.read(spark, root) is None
    assert versions.update(spark, root, lambda now, _: None) is None
    versions.commit(numbers(spark, 1), root, 0)
    assert versions.update(spark, root, lambda now, v: None).number == 1


def test_of_two_final_evaluations_one_is_refused(spark, tmp_path):
    df = scored(spark, [1, 0, 0, 1] * 10, [0.9, 0.01, 0.2, 0.03] * 10).withColumn("split", F.lit("test"))
    df = df.unionByName(df.withColumn("split", F.lit("val")))
    path = str(tmp_path / "final")

    def evaluate(_):
        try:
            return promotion.final_evaluation_once(df, path, draws=10).count()
        except RuntimeError:
            return 0

    with ThreadPool(3) as pool:
        assert sorted(pool.map(evaluate, range(3))) == [0, 0, 1]
    row = promotion.read_ledger(spark, path).first()
    assert row["first_run"] and row["state"] == "measured"


def test_a_claim_without_result_needs_force(spark, tmp_path):
    path = str(tmp_path / "final")
    broken = scored(spark, [1], [0.5]).withColumn("split", F.lit("test")).drop("machine_failure")
    with pytest.raises(Exception, match="machine_failure"):
        promotion.final_evaluation_once(broken, path, draws=5)
    good = scored(spark, [1, 0], [0.5, 0.1]).withColumn("split", F.lit("test"))
    with pytest.raises(RuntimeError):
        promotion.final_evaluation_once(good, path, draws=5)
    rows = promotion.final_evaluation_once(good, path, force=True, reason="first try broke", draws=5).collect()
    assert {r["state"]: r["first_run"] for r in rows} == {"claimed": True, "measured": False}
