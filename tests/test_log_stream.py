import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import predlog, splits
from riskframe.sources import ingest, stores
from riskframe.streaming import log_stream


@pytest.fixture
def calls(spark, states):
    return states.withColumns({
        "ts": F.to_timestamp(F.lit("2024-03-01 23:59:59")),
        "request_id": F.lit("r1"),
        "row_no": F.ascii("state_id") - 97,
        "latency_ms": F.lit(1.23456),
        "warnings": F.array(F.lit("torque_nm>90")),
        "probability": F.lit(0.0600000004),
    })


def test_record_fields_and_rounding(calls):
    r = predlog.log_records(calls, model_version="v7").orderBy("row_no").first()
    assert r["probability"] == 0.06 and r["alarm"] is True and r["latency_ms"] == 1.235
    assert r["threshold"] == C.THRESHOLD and r["model_version"] == "v7"
    assert r["inputs"]["torque_nm"] == 42.8 and r["warnings"] == ["torque_nm>90"]


def test_decision_is_taken_before_rounding(calls):
    below = calls.withColumn("probability", F.lit(0.0599999999))
    r = predlog.log_records(below).first()
    assert r["probability"] == 0.06 and r["alarm"] is False


def test_inputs_can_be_left_out(calls):
    records = predlog.log_records(calls, with_inputs=False)
    assert records.where("inputs is not null").count() == 0
    assert predlog.features_from_log(records).count() == 0


def test_two_appends_accumulate_in_both_stores(spark, calls, tmp_path):
    records = predlog.log_records(calls)
    lines, table = str(tmp_path / "j"), str(tmp_path / "t")
    for _ in range(2):
        assert predlog.append_json(records, lines) == 4
        assert predlog.append_table(records, table) == 4
    assert predlog.read_json(spark, lines, records).count() == 8
    stored = spark.read.parquet(table)
    assert stored.count() == 8 and stored.first()["alarm"] == 1
    assert json.loads(stored.first()["warnings"]) == ["torque_nm>90"]
    back = predlog.features_from_log(stored)
    assert set(C.INPUT_FIELDS) < set(back.columns) and back.count() == 8


def test_appends_write_rows_once_and_count_them(spark, calls, tmp_path):
    from riskframe import session

    records = predlog.log_records(calls)
    before = len(session._WRITTEN)
    assert predlog.append_json(records, str(tmp_path / "j")) == 4
    assert predlog.append_table(records, str(tmp_path / "t")) == 4
    assert predlog.append_json(records.limit(0), str(tmp_path / "j")) == 0
    assert predlog.append_table(records.where("row_no < 0"), str(tmp_path / "t")) == 0
    assert len(session._WRITTEN) == before  # no copy beside the store
    assert {p.suffix for p in (tmp_path / "j").glob("part-*")} == {".gz"}
    assert predlog.read_json(spark, str(tmp_path / "j"), records).count() == 4


def test_failed_append_is_reported_not_raised(calls, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("x")
    assert predlog.append_json(predlog.log_records(calls), str(blocker / "sub")) == 0


def test_daily_stats_counters_and_latest(spark):
    rows = [
        (i, dt.datetime(2024, 1, 1 + i // 3, 12, i), f"r{i // 2}", i % 2, 0.1 * i, i > 1, 10.0 * i,
         i == 5, ["w"] * (i % 3), "x")
        for i in range(6)
    ]
    log = spark.createDataFrame(
        rows, "id int, ts timestamp, request_id string, row_no int, probability double,"
        " alarm boolean, latency_ms double, failed boolean, warnings array<string>, inputs string",
    )
    days = predlog.daily_stats(log).collect()
    assert [str(r["day"]) for r in days] == ["2024-01-02", "2024-01-01"]
    assert days[0]["alarm_rate"] == 1 and days[1]["alarm_rate"] == pytest.approx(1 / 3, abs=1e-6)
    c = predlog.counters(log).first()
    assert (c["requests"], c["requests_failed"], c["predictions"], c["warnings"]) == (3, 1, 6, 6)
    assert [r["id"] for r in predlog.latest_records(log, 2).collect()] == [5, 4]


def test_batches_are_cut_and_exploded_back(spark):
    rows = [("a", i, i / 100, i % 2 == 0, 1.0) for i in range(25)] + [("b", 0, 0.5, True, 3.0)]
    log = spark.createDataFrame(
        rows, "request_id string, row_no int, probability double, alarm boolean, latency_ms double"
    ).repartition(5)
    packed = predlog.batches(log, max_items=10)
    assert max(r["n"] for r in packed.select(F.size("items").alias("n")).collect()) == 10
    back = predlog.explode_batches(packed, max_items=10).collect()
    assert sorted((r["request_id"], r["row_no"], r["probability"], r["alarm"]) for r in back) == sorted(
        r[:4] for r in rows
    )


def test_raw_file_with_mark_is_read_and_checked(spark, states, tmp_path):
    full = states.withColumns({c: F.lit(0) for c in C.CAUSES}).withColumns({
        "udi": F.lit(1), "product_id": F.lit("L1")
    })
    path = str(tmp_path / "raw")
    ingest.write_raw(full, path)
    back = ingest.load_raw(spark, path, expected_rows=4)
    assert back.columns == list(C.RAW_COLUMNS.values())
    assert back.where("udi = 1").count() == 4 and back.agg(F.max("torque_nm")).first()[0] == 49.4
    with pytest.raises(ValueError, match="row count"):
        ingest.load_raw(spark, path, expected_rows=5)
    short = str(tmp_path / "short.csv")
    states.write.option("header", True).csv(short)
    with pytest.raises(ValueError, match="Torque"):
        ingest.load_raw(spark, short)
    assert ingest.read_any(spark, short).count() == 4


def test_file_hashes_equal_hashlib(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    digest = hashlib.sha256(b"abc" * 1000).hexdigest()
    assert ingest.file_hashes(spark, str(tmp_path)).first()["sha256"] == digest
    ingest.check_integrity(spark, str(tmp_path), {"a.bin": digest})
    ingest.check_integrity(spark, str(tmp_path), {})
    with pytest.raises(ValueError, match="a.bin"):
        ingest.check_integrity(spark, str(tmp_path), {"a.bin": "0"})


def test_files_beyond_the_cell_limit_are_streamed(spark, tmp_path):
    parts = {"a b.bin": b"0123456789" * 1000, "small.bin": b"x", "ü.bin": bytes(range(256)) * 40}
    for name, content in parts.items():
        (tmp_path / name).write_bytes(content)
    got = {r["file"]: (r["bytes"], r["sha256"]) for r in ingest.file_hashes(spark, str(tmp_path), cell_limit=100).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in parts.items()}


def test_a_file_longer_than_any_cell(tmp_path):
    import pandas as pd

    path, size = tmp_path / "long.bin", 2**31 + 5
    with open(path, "wb") as f:
        f.truncate(size)  # a sparse file takes no room
    digest = hashlib.sha256()
    for _ in range(size // 2**20):
        digest.update(bytes(2**20))
    digest.update(bytes(size % 2**20))
    row = next(ingest.block_hashes(iter([pd.DataFrame({"path": [f"file:{path}"]})]))).iloc[0]
    assert (row["bytes"], row["sha256"]) == (size, digest.hexdigest())


def test_fingerprint_ignores_order_and_files(spark, states):
    cols = ["state_id", "type", "torque_nm"]
    a = ingest.table_fingerprint(states, cols).first()
    b = ingest.table_fingerprint(states.orderBy(F.desc("torque_nm")).repartition(3), cols).first()
    c = ingest.table_fingerprint(states.withColumn("type", F.lit("L")), cols).first()
    assert a == b and a != c


def test_split_store_and_reproduction(spark, tmp_path):
    df = spark.range(800).select(
        F.md5(F.col("id").cast("string")).alias("state_id"), (F.col("id") % 8 == 0).cast("int").alias(C.TARGET)
    )
    split = splits.stratified_split(df)
    path = str(tmp_path / "s")
    stores.write_splits(split, path)
    assert stores.read_split(spark, path, "test").count() == 120
    stored = stores.read_split(spark, path).select(*split.columns)
    assert splits.split_reproducible(stored, splits.stratified_split(df)).first()["reproduced"]
    other = splits.split_reproducible(stored, splits.stratified_split(df, test=0.2)).first()
    assert not other["reproduced"]
    overlap = splits.split_overlap(split).first()
    assert (overlap["train_val"], overlap["train_test"], overlap["val_test"]) == (0, 0, 0)
    folds = splits.stratified_folds(df, 5)
    per = folds.groupBy("fold", C.TARGET).count().collect()
    assert {r["count"] for r in per if r[C.TARGET] == 1} == {20}
    with pytest.raises(FileNotFoundError):
        stores.read_split(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        stores.read_reference(spark, str(tmp_path / "none"))


def test_uniform_sample_is_reproducible_and_bounded(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("state_id"))
    a, b = (splits.uniform_sample(df.repartition(k), 20).collect() for k in (2, 5))
    assert sorted(a) == sorted(b) and len(a) == 20
    assert splits.uniform_sample(df, 500).count() == 50


def test_stream_drops_repeated_records(spark, tmp_path):
    rows = [("r", i % 3, dt.datetime(2024, 1, 1, 0, i)) for i in range(9)]
    src = spark.createDataFrame(rows, "request_id string, row_no int, ts timestamp")
    src.write.json(str(tmp_path / "in"))
    stream = log_stream.json_stream(spark, str(tmp_path / "in"), src.schema)
    out = str(tmp_path / "out")
    log_stream.finish(log_stream.append_stream(log_stream.deduplicated(stream), out, str(tmp_path / "cp")))
    assert spark.read.parquet(out).count() == 3


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    schema = "ts timestamp, probability double, alarm boolean, latency_ms double"
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for day in (1, 2, 2):
        spark.createDataFrame([(dt.datetime(2024, 1, day, 5), 0.5, True, 2.0)], schema).write.mode(
            "append").json(src)
        stream = log_stream.json_stream(spark, src, spark.read.schema(schema).json(src).schema)
        log_stream.finish(log_stream.update_stream(log_stream.daily_stats_stream(stream), out, cp))
    got = {str(r["day"]): r["requests"] for r in log_stream.current_daily_stats(spark, out).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2}
