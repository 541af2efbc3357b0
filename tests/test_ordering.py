import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import ordering
from riskframe.functions.ranks import ValueRanks, exact_percentiles


def keyed(spark, n, copies=0):
    rows = [(hashlib.md5(str(i).encode()).hexdigest(), i % 10 == 0) for i in range(n)]
    rows += [rows[min(3, n - 1)]] * copies
    return rows, spark.createDataFrame(rows, "k string, y boolean")


def test_rank_cuts_equal_sorted_ranks(spark):
    rows, df = keyed(spark, 1000)
    cuts = ordering.rank_cuts(df, "k", [0.15, 0.30], "y", digits=2)
    for y in (True, False):
        keys = sorted(k for k, v in rows if v == y)
        n = len(keys)
        assert cuts[y] == [keys[int(f * n + 0.5) - 1] for f in (0.15, 0.30)]


def test_rank_cuts_keep_copies_together_without_losing_rows(spark):
    rows, df = keyed(spark, 300, copies=150)  # one key holds a third of the rows
    cuts = ordering.rank_cuts(df, "k", [0.5], digits=1)
    out = df.withColumn("p", ordering.position("k", cuts))
    assert out.groupBy("k").agg(F.count_distinct("p").alias("c")).where("c > 1").count() == 0
    assert out.count() == len(rows)


def test_rank_cut_of_nothing_is_none(spark):
    _, df = keyed(spark, 3)
    assert ordering.rank_cuts(df, "k", [0.1], rounding=0.0) == {}
    assert ordering.rank_cuts(df.limit(0), "k", [0.5]) == {}


def test_too_many_strata_are_refused(spark):
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    with pytest.raises(ValueError):
        ordering.rank_cuts(df, "k", [0.5], "id", rounding=0.9)


def test_numbered_rows_of_a_hot_group(spark):
    rng = random.Random(1)
    ids = list(range(3000))
    rng.shuffle(ids)
    rows = [("hot" if i % 3 else f"g{i % 60}", i) for i in ids]
    df = spark.createDataFrame(rows, "g string, id long").repartition(7)
    plain = ordering.numbered_rows(df, ["g"], "id", "n").collect()
    lots = ordering.numbered_rows(
        df, ["g"], "id", "n", lot=F.floor(F.col("id") / 64), hot_rows=100
    ).collect()
    want = {}
    for g in {g for g, _ in rows}:
        for n, i in enumerate(sorted(i for h, i in rows if h == g)):
            want[g, i] = n
    assert {(r["g"], r["id"]): r["n"] for r in plain} == want
    assert {(r["g"], r["id"]): r["n"] for r in lots} == want


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_percentiles_equal_numpy(spark, partitions):
    rng = np.random.default_rng(7)
    a = rng.normal(300, 2, 4000)
    b = np.concatenate([rng.lognormal(0, 4, 2500), np.full(1500, 5.0)])  # outliers and one hot value
    b[:3] = [-1e12, 1e15, 0.0]
    df = spark.createDataFrame(
        [(float(x), float(y)) for x, y in zip(a, b, strict=True)] + [(None, None)], "a double, b double"
    )
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_percentiles(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None)}, probs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    np.testing.assert_allclose(got["a"], np.quantile(a, probs), rtol=1e-12)
    np.testing.assert_allclose(got["b"], np.quantile(b, probs), rtol=1e-12)
    assert got["none"] == [None] * len(probs)


def test_percentiles_of_an_empty_column_are_none(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert exact_percentiles(df, {"a": F.col("a")}, [0.5]) == {"a": [None]}
    assert exact_percentiles(df, {}, [0.5]) == {}


def test_distances_equal_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 700).round(2), np.concatenate([rng.normal(0.3, 1, 300), np.full(200, 0.5)]).round(2)
    rows = [(0, float(x), 1) for x in a] + [(0, float(x), 0) for x in b] + [(1, 2.0, 1), (1, 2.0, 0), (2, 1.0, 1)]
    df = spark.createDataFrame(rows, "spec int, value double, left int").repartition(5)
    ranks = ValueRanks(df, {"x": F.sum("left"), "y": F.sum(1 - F.col("left"))})
    got = {r["spec"]: r["distance"] for r in ranks.distances("x", "y").collect()}
    points = np.unique(np.concatenate([a, b]))
    want = max(abs((a <= p).mean() - (b <= p).mean()) for p in points)
    assert got[0] == pytest.approx(want, abs=1e-12) and got[1] == 0.0 and got[2] is None
