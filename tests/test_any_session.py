"""Fitted models keep scoring whatever else the session has registered."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskframe.operators import models
from riskframe.plans.queries import all_queries  # noqa: F401 - registers what a session may run
from riskframe.sources import ingest


def table(spark):
    rows = [
        (str(i), "LMH"[i % 3], 298.0 + i % 5, 308.0 + i % 4, 1300 + 7 * i % 500, 20.0 + i % 40, i % 200, int(i % 7 == 0))
        for i in range(200)
    ]
    return spark.createDataFrame(
        rows,
        "state_id string, type string, air_temperature_k double, process_temperature_k double,"
        " rotational_speed_rpm int, torque_nm double, tool_wear_min int, machine_failure int",
    )


def test_scoring_after_an_observation(spark):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    df = table(spark)
    for estimator, scaled in ((models.random_forest(5, 3), False), (models.logistic_regression(200, max_iter=5), True)):
        assert models.score(models.fit(df, estimator, scaled=scaled), df).count() == 200


def test_raw_files_with_other_headers_or_bad_numbers_fail(spark, tmp_path):
    import pytest

    df = table(spark).withColumns({
        "udi": F.col("state_id").cast("long"), "product_id": F.col("state_id"),
        **{c: F.lit(0) for c in ("twf", "hdf", "pwf", "osf", "rnf")},
    })
    path = str(tmp_path / "raw")
    assert ingest.write_raw(df.coalesce(1), path) == 200
    assert ingest.load_raw(spark, path, expected_rows=200).count() == 200
    part = next((tmp_path / "raw").glob("part-*.csv"))
    header, *lines = part.read_text(encoding="utf-8").splitlines()
    names = header.split(",")
    (tmp_path / "raw" / "part-other.csv").write_text("\n".join([",".join(reversed(names)), *lines[:2]]), encoding="utf-8")
    with pytest.raises(ValueError, match="differ"):
        ingest.load_raw(spark, path)
    bad = tmp_path / "bad.csv"
    cells = lines[0].split(",")
    cells[names.index("Torque [Nm]")] = "abc"
    bad.write_text("\n".join([header, ",".join(cells)]), encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        ingest.load_raw(spark, str(bad)).collect()
