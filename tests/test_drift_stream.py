"""Drift state across micro-batches equals the batch computation."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.times import utc_day
from riskframe.operators import drift
from riskframe.streaming import drift_stream, log_stream

SCHEMA = "ts timestamp, x double, y double"


def rows(rng, day, n, shift=0.0):
    base = dt.datetime(2024, 3, 1) + dt.timedelta(days=day)
    return [
        (base + dt.timedelta(seconds=float(s)), float(rng.normal(shift, 1)), float(v) if v else None)
        for s, v in zip(rng.uniform(0, 86_399, n), rng.integers(0, 4, n), strict=True)
    ]


def test_runs_equal_the_batch_result_over_restarts(spark, tmp_path):
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame([r for d in range(-3, 0) for r in rows(rng, d, 300)], SCHEMA)
    shifts = [0, 1.5, 1.5, 1.5, 1.5, 0, 0, 1, 1]
    days = [rows(rng, d, 150, s) for d, s in enumerate(shifts)]
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    # a day arrives in two parts, in different micro-batches; each append is taken by a new query
    parts = [days[0] + days[1][:70], days[1][70:] + days[2], days[3] + days[4] + days[5][:10], days[5][10:] + days[6] + days[7] + days[8]]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 3).parquet(src)
        log_stream.finish(drift_stream.store_runs(drift_stream.drift_runs(stream, ref, ["x", "y"], delay="30 hours"), out, cp))
    got = {
        (r["feature"], r["run"]): (pytest.approx(r["psi"], abs=5e-5), r["verdict"], r["persistent_verdict"])
        for r in spark.read.parquet(out).collect()
    }
    cur = spark.createDataFrame([r for d in days for r in d], SCHEMA).withColumn("day", utc_day("ts"))
    batch = drift.persistent_drift(drift.psi_by_run(ref, cur, "day", ["x", "y"]))
    first = (dt.date(2024, 3, 1) - dt.date(1970, 1, 1)).days
    want = {
        (r["feature"], (r["run"] - dt.date(1970, 1, 1)).days): (r["psi"], r["verdict"], r["persistent_verdict"])
        for r in batch.collect()
    }
    assert got.keys() <= want.keys() and {k[1] for k in got} == {first + d for d in range(7)}
    assert all(want[k] == v for k, v in got.items())
    assert {v[2] for v in got.values()} == {"stable", "act"}


def test_rows_of_closed_runs_are_dropped(spark, tmp_path):
    rng = np.random.default_rng(6)
    ref = spark.createDataFrame(rows(rng, 0, 300), SCHEMA)
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in (rows(rng, 0, 50), rows(rng, 3, 50), rows(rng, 0, 50), rows(rng, 6, 5)):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        log_stream.finish(drift_stream.store_runs(drift_stream.drift_runs(stream, ref, ["x"]), out, cp))
    found = spark.read.parquet(out).orderBy("run").collect()
    assert [r["rows"] for r in found] == [50, 50]


def test_null_values_are_in_no_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)] * 50, "x double")
    bins = drift.reference_bins(df, ["x"])["x"]
    assert sum(bins.reference) == 100 and len(bins.reference) == 10
    got = drift.psi_by_run(df, df.withColumn("run", F.lit(1)), "run", ["x"]).first()
    assert got["psi"] == pytest.approx(0)
