import itertools
import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions import stats
from riskframe.functions.stats import chi2_p, kolmogorov_p, verdict


@pytest.mark.parametrize(
    ("x", "dof", "p"),
    [
        (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
        (9.487729036781154, 4, 0.05), (11.070497693516351, 5, 0.05), (18.307038053275146, 10, 0.05),
        (0.6331, 2, 0.728659), (0.0, 1, 1.0), (700.0, 3, 0.0),
        (0.1025866, 2, 0.95), (0.35184632, 3, 0.95),
    ],
)
def test_chi_square_tail(spark, x, dof, p):
    got = spark.range(1).select(chi2_p(F.lit(x), F.lit(dof)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=2e-5)


@pytest.mark.parametrize(("lam", "p"), [(0.5, 0.9639452), (0.8, 0.5441424), (1.0, 0.2699997), (1.36, 0.0494859), (2.0, 0.0006709)])
def test_kolmogorov_tail(spark, lam, p):
    n = 2_000_000
    d = lam / math.sqrt(n / 2)
    got = spark.range(1).select(kolmogorov_p(F.lit(d), F.lit(n), F.lit(n)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=1e-6)


def test_verdict_limits_are_inclusive(spark):
    rows = [(None,), (0.05,), (0.10,), (0.175,), (0.25,), (2.5,)]
    got = spark.createDataFrame(rows, "p double").select(verdict(F.col("p")).alias("v"))
    assert [r["v"] for r in got.collect()] == ["unknown", "stable", "watch", "watch", "act", "act"]


def plain_ks_p(d, n, m):
    """Share of all orders of two samples whose distance reaches ``d``."""
    hits = total = 0
    for places in itertools.combinations(range(n + m), n):
        chosen, a, b, far = set(places), 0, 0, 0.0
        for k in range(n + m):
            a, b = a + (k in chosen), b + (k not in chosen)
            far = max(far, abs(a * m - b * n))
        total += 1
        hits += far >= round(d * n * m)
    return hits / total


@pytest.mark.parametrize(("n", "m"), [(1, 1), (3, 5), (4, 4), (6, 3), (5, 7)])
def test_exact_ks_p_equals_enumeration(n, m):
    for k in range(1, n * m + 1):
        assert stats.ks_path_p(k / (n * m), n, m) == pytest.approx(plain_ks_p(k / (n * m), n, m), abs=1e-12)


def test_exact_ks_p_of_large_and_far_samples(spark):
    assert stats.ks_path_p(0.0133333333, 1000, 1500) == pytest.approx(0.999902, abs=2e-6)
    assert stats.ks_path_p(1.0, 40, 60) == pytest.approx(2 / math.comb(100, 40), rel=1e-9)
    assert stats.ks_path_p(0.0, 5, 5) == 1.0
    df = spark.createDataFrame([(0.4, 5, 5), (None, 5, 5), (0.4, 0, 5)], "d double, n long, m long")
    got = [r[0] for r in df.select(stats.exact_kolmogorov_p(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert got[0] == pytest.approx(plain_ks_p(0.4, 5, 5)) and got[1:] == [None, None]
