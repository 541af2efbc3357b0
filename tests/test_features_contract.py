import copy
import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.functions import features
from riskframe.operators import contract, profiling
from riskframe.sources import tables


def test_engineered_features_by_hand(states):
    r = features.add_engineered(states).where("state_id = 'b'").first()
    assert r["temp_difference_k"] == pytest.approx(9.8)
    assert r["power_w"] == pytest.approx(46.3 * 1408 * 2 * math.pi / 60)
    assert r["wear_torque_min_nm"] == pytest.approx(85 * 46.3)


def test_dropping_leakage_ignores_absent_columns(states):
    wide = states.withColumns({"twf": F.lit(1), "udi": F.lit(1)})
    out = features.drop_leakage(wide)
    assert out.columns == states.columns
    assert features.removed_columns(wide, out) == ["twf", "udi"]


def test_one_hot_drops_first_level_and_tolerates_unknown(spark):
    df = spark.createDataFrame([("H",), ("L",), ("M",), ("X",), (None,)], "type string")
    out = features.one_hot(df, "type", features.category_levels(df.where("type <> 'X'"), "type"))
    rows = [(r["type_L"], r["type_M"]) for r in out.collect()]
    assert rows == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [(r["a"], r["b"]) for r in features.standardize(df, ["a", "b"]).collect()] == [
        (-1.0, 0.0), (1.0, 0.0)
    ]


def summary(df, rules=C.CONTRACT):
    return contract.contract_summary(contract.contract_report(df, rules)).first()


def test_valid_table_passes(states):
    s = summary(states.drop("state_id"))
    assert s["valid"] and s["errors"] == 0 and s["warnings"] == 0
    assert s["checks_run"] == 37


def test_row_count_check_adds_one(states):
    rules = {**C.CONTRACT, "check_row_count": True, "expected_row_count": 5}
    s = summary(states.drop("state_id"), rules)
    assert s["checks_run"] == 38 and s["failed_checks"] == "row_count"


def test_all_violations_are_collected(states):
    bad = states.drop("state_id", "tool_wear_min").withColumns({
        "torque_nm": F.when(F.col("type") == "L", -1.0).otherwise(95.0),
        "type": F.when(F.col("type") == "H", "Z").otherwise(F.col("type")),
        "air_temperature_k": F.col("air_temperature_k").cast("string"),
        "extra": F.lit(1),
    })
    s = summary(bad)
    assert set(s["failed_checks"].split(",")) == {
        "present:tool_wear_min", "min:torque_nm", "allowed:type", "type:air_temperature_k"
    }
    assert set(s["warned_checks"].split(",")) == {
        "warn_min:torque_nm", "warn_max:torque_nm", "unexpected"
    }
    with pytest.raises(ValueError, match="min:torque_nm"):
        contract.require_valid(bad)


def test_nulls_violate_only_the_missing_ratio(states):
    one = states.drop("state_id").withColumn("torque_nm", F.when(F.col("type") != "H", F.col("torque_nm")))
    assert summary(one)["failed_checks"] == "missing:torque_nm"
    lenient = copy.deepcopy(C.CONTRACT)
    lenient["max_missing_ratio"] = 0.25
    assert summary(one, lenient)["valid"]


def test_empty_table_passes(states):
    assert summary(states.drop("state_id").limit(0))["valid"]


def test_row_level_reject_and_warn(spark):
    rows = [
        ("L", 298.1, 308.6, 1551, 42.8, 0),
        ("L", 250.0, 380.0, 10000, 200.0, 1000),
        ("Q", 249.9, 308.6, 1551, 42.8, None),
    ]
    df = spark.createDataFrame(
        rows, "type string, air_temperature_k double, process_temperature_k double,"
        " rotational_speed_rpm int, torque_nm double, tool_wear_min int",
    )
    out = contract.quarantine(df).withColumn("w", contract.soft_warnings()).collect()
    assert [r["accepted"] for r in out] == [True, True, False]
    assert out[2]["reject_reasons"] == ["type", "air_temperature_k", "tool_wear_min"]
    assert out[0]["w"] == []
    assert out[1]["w"] == [
        "air_temperature_k<293", "process_temperature_k>317", "rotational_speed_rpm>3000",
        "torque_nm>90", "tool_wear_min>260",
    ]


def test_json_fields(spark):
    df = spark.createDataFrame([('{"a": 1, "x": 2}',), ('{"a": 1, "b": 2}',)], "t string")
    out = df.select(*contract.json_fields("t", ["a", "b"])).collect()
    assert (out[0]["unknown_fields"], out[0]["missing_fields"]) == (["x"], ["b"])
    assert (out[1]["unknown_fields"], out[1]["missing_fields"]) == ([], [])


def test_failure_rate_lists_unknown_categories(spark):
    df = spark.createDataFrame([("L", 1), ("M", 0), ("X", 1), ("X", 0), (None, 0)], "type string, machine_failure int")
    out = {r["type"]: (r["order_no"], r["rows"], r["failures"]) for r in profiling.failure_rate_by(df, "type", ["L", "M"]).collect()}
    assert out == {"L": (1, 1, 1), "M": (2, 1, 0), "X": (3, 2, 1), None: (3, 1, 0)}


def test_column_profile_counts_exactly(spark):
    rows = [(i % 70_000 - 35_000 if i % 7 else None, i % 3, f"v{i % 1000}" if i % 2 else None, i / 4 % 50, i % 5 == 0) for i in range(4000)]
    rows += [(2**62, 1, "", -0.0, None), (-(2**62), 1, "", 0.0, None)]
    df = spark.createDataFrame(rows, "`a.b` long, k int, s string, x double, flag boolean")
    for exact in (True, False):
        got = {r["column"]: r for r in profiling.column_profile(df.toDF("a", "k", "s", "x", "flag"), exact).collect()}
        for i, (name, kind) in enumerate((("a", "bigint"), ("k", "int"), ("s", "string"), ("x", "double"), ("flag", "boolean"))):
            values = [r[i] for r in rows]
            distinct = len({v for v in values if v is not None})
            assert got[name]["type"] == kind and got[name]["missing"] == values.count(None)
            assert got[name]["distinct_values"] == (distinct if exact else pytest.approx(distinct, rel=0.1))
    empty = {r["column"]: (r["missing"], r["distinct_values"]) for r in profiling.column_profile(df.toDF(*"abcde").limit(0)).collect()}
    assert empty == dict.fromkeys("abcde", (0, 0))


def test_column_profile_sorts_no_rows_and_reads_once(spark):
    edges = [-(2**63), -(2**63) + 1, -65, -64, -1, 0, 63, 64, 2**63 - 1, None, None, -1, 63]
    df = spark.createDataFrame([(v, v and v % 128 - 64, None, str(v)) for v in edges], "v long, t tinyint, n int, s string")
    out = profiling.column_profile(df)
    got = {r["column"]: (r["type"], r["missing"], r["distinct_values"]) for r in out.collect()}
    small = {v and v % 128 - 64 for v in edges} - {None}
    assert got == {"v": ("bigint", 2, 9), "t": ("tinyint", 2, len(small)), "n": ("int", 13, 0), "s": ("string", 0, 10)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Sort" not in plan and plan.count("stack(") == 1


def test_rounded_equals_round_to_the_last_bit(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 17) for _ in range(20_000)]
    ties = [k / 2 / 10**d for k in range(-400, 400) for d in (0, 1, 6)] + [rng.randrange(2 * 10**9) / 2 / 10**rng.choice((0, 1, 6)) for _ in range(5000)]
    values += [y for x in ties for y in (x, math.nextafter(x, -math.inf), math.nextafter(x, math.inf))]
    values += [None, 0.0, -0.0, -0.04, -1e-9, 5e-324, 1e300, -1e300, math.inf, -math.inf, math.nan, 1e9, 1e8 + 0.05]
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(4)
    for digits in (0, 1, 6):
        both = df.select("x", F.round("x", digits).cast("string").alias("a"), F.expr(features.rounded("x", digits)).cast("string").alias("b"))
        assert both.where("not (a <=> b)").collect() == []


def test_states_and_scores_leave_round_to_ties(spark, tmp_path):
    row = (1, 2, 3, 1, 17.0, 24386.67, 0.04, 0.02, "N", datetime.datetime(1998, 3, 2))
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
    )
    spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    states = tables.scored_states(spark, str(tmp_path))
    r = states.first()
    assert (r["air_temperature_k"], r["process_temperature_k"], r["temp_difference_k"]) == (299.0, 308.0, 9.0)
    assert r["probability"] == round(r["probability"], 6)
    plan = states._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("round(") == plan.count("ELSE round(") == 5
