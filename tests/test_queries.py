"""Registered queries against their SQL on the smallest test data."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracle import TABLES, normal  # noqa: E402

from riskframe.plans.oracle import all_sql  # noqa: E402
from riskframe.plans.queries import all_queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "best_threshold", "threshold_comparison", "evaluate_scores", "contract_report", "contract_summary",
    "stratified_split", "stratified_folds", "baseline_rules", "slice_metrics", "cross_metrics",
    "drift_table", "drift_verdict", "scenario_table", "drift_persistent", "champion",
    "log_daily_stats", "explode_batches", "stream_scored", "quantile_bands", "box_stats", "raw_ingest",
    "contract_broken", "split_changed", "permutation_importance", "retrain_contributing", "column_profile",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    got = all_queries()[name](spark, FOLDER).toPandas()
    want = con.execute(all_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_bootstrap_is_near_plain_resampling(spark, con):
    """The SQL resamples row by row with other random numbers: ends agree as far as 2,000 draws do."""
    got = all_queries()["bootstrap_ci"](spark, FOLDER).first()
    want = con.execute(all_sql()["bootstrap_ci"]).df().iloc[0]
    assert got["draws"] == want["draws"]
    for c in ("pr_auc_low", "pr_auc_high", "recall_low", "recall_high"):
        assert abs(got[c] - want[c]) <= 0.02


def test_every_sql_has_a_query():
    assert set(all_sql()) <= set(all_queries())
