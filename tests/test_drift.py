import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.operators import drift
from riskframe.operators.scenarios import Scenario, harmless_drift, scenario_table, self_check, silent_failure


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(11)
    n = 500
    return {
        "type": rng.choice(["L", "M", "H"], n, p=[0.5, 0.3, 0.2]).tolist(),
        "air_temperature_k": rng.normal(300, 2, n).tolist(),
        "torque_nm": rng.normal(40, 10, n).tolist(),
        "probability": rng.beta(1, 20, n).round(6).tolist(),
    }


def frame(spark, columns):
    schema = ", ".join(
        f"{c} {'string' if isinstance(v[0], str) else 'double'}" for c, v in columns.items()
    )
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema)


def one(spark, ref, cur, **kw):
    r = spark.createDataFrame([(float(x),) for x in ref], "x double")
    c = spark.createDataFrame([(float(x),) for x in cur], "x double")
    return drift.DriftCheck(r, c, **kw)


def brute_psi(ref, cur, bins=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    edges[0], edges[-1] = -np.inf, np.inf
    r = np.clip(np.histogram(ref, edges)[0] / len(ref), 1e-6, None)
    a = np.clip(np.histogram(cur, edges)[0] / len(cur), 1e-6, None)
    return float(((a - r) * np.log(a / r)).sum())


def brute_ks(ref, cur):
    at = np.sort(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), at, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), at, side="right") / len(cur)
    return float(np.abs(f - g).max())


@pytest.mark.parametrize("case", ["normal", "ties", "shifted", "hot value"])
def test_psi_and_ks_equal_brute_force(spark, case):
    rng = np.random.default_rng(4)
    ref, cur = {
        "normal": (rng.normal(0, 1, 900), rng.normal(0.1, 1, 700)),
        "ties": (rng.integers(0, 60, 900), rng.integers(5, 70, 700)),
        "shifted": (rng.normal(0, 1, 900), rng.normal(3, 1, 700)),
        "hot value": (
            np.concatenate([np.full(300, 7.0), rng.lognormal(0, 3, 600)]),
            np.concatenate([np.full(350, 7.0), rng.lognormal(0.2, 3, 350), [-1e9, 1e12]]),
        ),
    }[case]
    r = one(spark, ref, cur).numeric_summary().first()
    assert r["psi"] == pytest.approx(brute_psi(ref, cur), rel=1e-9)
    assert r["statistic"] == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert r["ref_mean"] == pytest.approx(np.mean(ref), rel=1e-9)


def test_same_sample_has_no_drift_and_no_negative_psi(spark):
    x = np.random.default_rng(1).normal(0, 1, 400)
    r = one(spark, x, x).numeric_summary().first()
    assert r["psi"] == pytest.approx(0, abs=1e-12) and r["statistic"] == 0 and r["p"] == 1
    for shift in (-3.0, -0.5, 0.5, 3.0):
        assert one(spark, x, x + shift).numeric_summary().first()["psi"] >= 0


def test_constant_reference_is_flagged(spark):
    r = one(spark, np.zeros(50), np.ones(50)).numeric_summary().first()
    assert r["psi"] == 0 and r["degenerate_reference"]


def test_empty_side_is_unknown(spark):
    ref = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    cur = spark.createDataFrame([(None, None)], "x double, c string")
    rows = drift.drift_table(ref, cur).collect()
    assert {r["verdict"] for r in rows} == {"unknown"}
    assert all(r["statistic"] is None and r["p_value"] is None for r in rows)


def test_column_without_values_is_listed_as_unknown(spark):
    df = spark.createDataFrame([(1.0, None, None), (2.0, None, None)], "x double, y double, c string")
    rows = {r["feature"]: r["verdict"] for r in drift.drift_table(df, df).collect()}
    assert rows == {"x": "stable", "y": "unknown", "c": "unknown"}


def test_prediction_only_pair_has_an_empty_feature_table(spark):
    df = spark.createDataFrame([(0.5,)], "probability double")
    assert drift.drift_table(df, df).count() == 0


def chi2(spark, ref, cur):
    mk = lambda d: spark.createDataFrame([(k,) for k, n in d.items() for _ in range(n)], "c string")
    return drift.chi2_from_counts(drift.category_counts(mk(ref), mk(cur), ["c"])).first()


def test_chi_square_cases(spark):
    same = chi2(spark, {"L": 500, "M": 300, "H": 200}, {"L": 250, "M": 150, "H": 100})
    assert same["statistic"] == pytest.approx(0, abs=1e-9) and same["p"] == pytest.approx(1)
    other = chi2(spark, {"L": 500, "M": 300, "H": 200}, {"H": 800, "L": 200})
    assert other["p"] < 0.05 and other["dof"] == 2
    single = chi2(spark, {"L": 100}, {"L": 100})
    assert (single["statistic"], single["p"]) == (0, 1)


def test_two_categories_are_corrected(spark):
    # 10/20 against 20/10: expected 15 everywhere, |5| - 0.5 = 4.5, 4 * 4.5^2 / 15
    r = chi2(spark, {"a": 10, "b": 20}, {"a": 20, "b": 10})
    assert r["statistic"] == pytest.approx(5.4) and r["p"] == pytest.approx(0.020137, abs=1e-6)


def test_categorical_psi_counts_missing_categories(spark):
    mk = lambda s: spark.createDataFrame([(c,) for c in s], "c string")
    r = drift.psi_from_counts(drift.category_counts(mk("aab"), mk("aac"), ["c"])).first()
    one_third, floor = 1 / 3, 1e-6
    want = 2 * (one_third - floor) * np.log(one_third / floor)
    assert r["psi"] == pytest.approx(want)


def test_table_operations_and_verdict(spark, sample):
    ref = frame(spark, sample)
    same = drift.DriftCheck(ref, ref)
    rows = same.table().collect()
    assert {r["feature"] for r in rows} == {"type", "air_temperature_k", "torque_nm"}
    assert {r["verdict"] for r in rows} == {"stable"} and not any(r["significant"] for r in rows)
    assert same.verdict().first()["verdict"] == "stable"
    moved = ref.withColumns({
        "torque_nm": F.col("torque_nm") + 15, "probability": F.least(F.col("probability") + 0.3, F.lit(1.0))
    })
    check = drift.DriftCheck(ref, moved)
    by_name = {r["feature"]: r for r in check.table().collect()}
    assert by_name["torque_nm"]["verdict"] == "act" and by_name["torque_nm"]["significant"]
    assert by_name["air_temperature_k"]["verdict"] == "stable"
    ops = check.operations().first()
    assert ops["prediction_psi"] > C.PSI_ALARM and ops["prediction_verdict"] == "act"
    assert ops["alarm_rate_current"] > ops["alarm_rate_reference"]
    assert check.verdict().first()["verdict"] == "act"


def test_too_few_rows_give_no_verdict(spark, sample):
    ref = frame(spark, sample)
    r = drift.drift_verdict(ref, ref.limit(20)).first()
    assert not r["enough_data"] and r["verdict"] == "too little data"


def test_prediction_drift_alone_decides_without_common_features(spark, sample):
    ref = frame(spark, sample).select("probability")
    cur = ref.select((F.col("probability") + 0.5).alias("probability"))
    check = drift.DriftCheck(ref, cur)
    assert check.table().count() == 0
    assert check.verdict().first()["verdict"] == "act"


def test_confirmed_needs_both(spark):
    rows = [("a", 0.3, "act", 0.01, True), ("b", 0.3, "act", 0.2, False), ("c", 0.01, "stable", 0.0, True)]
    df = spark.createDataFrame(rows, "feature string, psi double, verdict string, p_value double, significant boolean")
    assert [r["feature"] for r in drift.confirmed(df).collect()] == ["a"]


def test_persistence_needs_three_runs(spark):
    psi = [0.3, 0.3, 0.05, 0.3, 0.3, 0.12, 0.3, 0.3, 0.3]
    df = spark.createDataFrame([(i, "f", p) for i, p in enumerate(psi)], "run int, feature string, psi double")
    got = [r["persistent_verdict"] for r in drift.persistent_drift(df).orderBy("run").collect()]
    assert got == ["stable"] * 5 + ["watch"] * 3 + ["act"]


def test_psi_by_run_equals_separate_checks(spark):
    rng = np.random.default_rng(8)
    ref = rng.normal(0, 1, 400)
    runs = {1: rng.normal(0, 1, 200), 2: rng.normal(1, 1, 150), 3: np.full(20, 9.0)}
    r = spark.createDataFrame([(0, float(x)) for x in ref], "run int, x double")
    c = spark.createDataFrame([(k, float(x)) for k, v in runs.items() for x in v], "run int, x double")
    got = {row["run"]: row["psi"] for row in drift.psi_by_run(r, c, "run", ["x"]).collect()}
    for k, v in runs.items():
        assert got[k] == pytest.approx(brute_psi(ref, v), rel=1e-9)


def scenario_input(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1200):
        dt, wear = float(rng.uniform(7, 12)), int(rng.integers(0, 200))
        y = int(dt < 8.0 or wear > 190)
        rows.append((
            f"{i:08x}", str(rng.choice(["L", "M"])), 300.0, 300.0 + dt,
            int(rng.integers(1200, 2800)), float(rng.uniform(20, 60)), wear, y,
        ))
    return spark.createDataFrame(
        rows, "state_id string, type string, air_temperature_k double, process_temperature_k double,"
        " rotational_speed_rpm int, torque_nm double, tool_wear_min int, machine_failure int",
    )


def test_scenarios_show_silent_and_harmless_drift(spark):
    from riskframe.operators.scenarios import SCENARIOS

    def score(df):
        hot = F.expr("process_temperature_k - air_temperature_k < 8.0")
        worn = F.col("tool_wear_min") > 190
        return df.withColumn("probability", F.when(hot | worn, 0.9).otherwise(0.01))

    df = scenario_input(spark)
    ref = score(df)
    sensor = Scenario(
        "wear counter misses a fifth",
        lambda d: {"tool_wear_min": (F.col("tool_wear_min") * 0.8).cast("int")},
    )
    table = scenario_table(ref, df, score, {**SCENARIOS, "worn_sensor": sensor})
    rows = {r["scenario"]: r for r in table.collect()}
    assert rows["control"]["verdict"] == "stable" and rows["control"]["max_psi"] == 0
    assert rows["control"]["recall"] == 1
    assert rows["temperature_calibration"]["max_psi_feature"] == "process_temperature_k"
    assert rows["type_shift"]["max_psi_feature"] == "type"
    assert rows["type_shift"]["recall"] == 1
    assert self_check(table).first()["passed"]
    assert silent_failure(table).first()["scenario"] == "worn_sensor"
    assert "type_shift" in {r["scenario"] for r in harmless_drift(table).collect()}
    shifted = SCENARIOS["type_shift"].apply(df).where("type = 'H'").count()
    assert shifted == 960


def test_volume_counts_rows_labelled_since_the_last_training(spark):
    log = spark.createDataFrame(
        [(d, y) for d, n in ((1, 5), (2, 3), (3, 2)) for y in [1] * n + [None]], "d int, label int"
    ).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    out = drift.since_training(log, F.col("day"), F.col("label"), "2024-01-02")
    assert [tuple(r)[1:] for r in out.orderBy("run").collect()] == [(3, 1), (5, 2)]
    again = drift.since_training(log, F.col("day"), F.col("label"), "2024-01-03")
    assert [tuple(r)[1:] for r in again.collect()] == [(2, 1)]
