"""Column expressions for the drift statistics: PSI terms, verdicts and test p-values."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe import config as C
from riskframe.session import by_value

by_value(__name__)


def psi_term(ref_share: Column, cur_share: Column) -> Column:
    """One bin's contribution; shares are floored, not renormalized."""
    r = F.greatest(ref_share, F.lit(C.SHARE_FLOOR))
    a = F.greatest(cur_share, F.lit(C.SHARE_FLOOR))
    return (a - r) * F.ln(a / r)


def verdict(psi: Column) -> Column:
    return (
        F.when(psi.isNull(), "unknown")
        .when(psi >= C.PSI_ALARM, "act")
        .when(psi >= C.PSI_WARN, "watch")
        .otherwise("stable")
    )


def kolmogorov_p(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov distance.

    The alternating series converges fast for large arguments, its theta transform for small ones.
    """
    r, c = n_ref.cast("double"), n_cur.cast("double")  # whole numbers would overflow
    lam = F.sqrt(F.try_divide(r * c, r + c)) * distance
    large = sum(
        (F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam) for k in range(1, 9)),
        F.lit(0.0),
    )
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * sum(
        (
            F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8) / (lam * lam))
            for k in range(1, 5)
        ),
        F.lit(0.0),
    )
    p = F.when(lam <= 1e-3, F.lit(1.0)).when(lam < 1.0, small).otherwise(large)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def exact_kolmogorov_p(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Exact two-sided p-value of the two-sample Kolmogorov-Smirnov distance, for bounded samples.

    Under the null hypothesis the merged sample is a random lattice path from (0, 0) to (n, m). The path is
    followed step by step, all its positions at once, and the probability that leaves the band in which
    the distribution functions are closer than the distance is summed up: no cancellation, so tiny p-values
    keep their digits. Time and memory grow with n * m and n: whether a sample is small enough is the
    caller's choice, not made here.
    """

    @F.pandas_udf("double")
    def p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([
            None if pd.isna(x) or pd.isna(a) or pd.isna(b) or not a or not b else ks_path_p(float(x), int(a), int(b))
            for x, a, b in zip(d, n, m, strict=True)
        ], dtype="float64")

    return p(distance, n_ref.cast("long"), n_cur.cast("long"))


def ks_path_p(distance: float, n: int, m: int) -> float:
    """P(D >= distance) for samples of ``n`` and ``m`` without ties."""
    # distances are multiples of 1 / lcm: compare whole numbers
    unit = math.lcm(n, m)
    limit = math.ceil(distance * unit - 1e-4)
    if limit <= 0:
        return 1.0
    i = np.arange(n + 1)
    inside, outside = np.zeros(n + 1), 0.0
    inside[0] = 1.0
    for k in range(1, n + m + 1):
        # steps to the right take one of the n - i that are left of the first sample, of N - k + 1 in all
        right = inside * (n - i) / (n + m - k + 1)
        up = inside * np.maximum(m - (k - 1 - i), 0) / (n + m - k + 1)
        inside = up
        inside[1:] += right[:-1]
        out = np.abs(i * (unit // n) - (k - i) * (unit // m)) >= limit
        outside += inside[out].sum()
        inside[out] = 0.0
    return float(min(outside, 1.0))


def chi2_p(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for any whole number of degrees of freedom.

    Even: a finite Poisson sum. Odd: complementary error function plus a finite sum; the error
    function is its power series, whose terms are all positive.
    """
    h = statistic / 2
    no_steps = F.array().cast("array<int>")

    def series(first: Column, steps: Column, ratio) -> Column:
        """first * (1 + ratio(1) + ratio(1)*ratio(2) + ...), ``steps`` terms after the first."""
        return F.aggregate(
            F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(no_steps),
            F.struct(first.alias("term"), first.alias("total")),
            lambda acc, i: F.struct(
                (acc["term"] * ratio(i)).alias("term"),
                (acc["total"] + acc["term"] * ratio(i)).alias("total"),
            ),
        )["total"]

    further = (F.floor(dof / 2) - 1).cast("int")
    even = series(F.exp(-h), further, lambda i: h / i)
    first = F.lit(2.0 / math.sqrt(math.pi)) * F.sqrt(h) * F.exp(-h)
    erf = series(first, F.lit(150), lambda i: h * 2 / (i * 2 + 1))
    erfc = F.when(h > 30, F.lit(0.0)).otherwise(F.lit(1.0) - erf)
    odd = erfc + F.when(dof >= 3, series(first, further, lambda i: h / (i + 0.5))).otherwise(0.0)
    p = F.when(dof % 2 == 0, even).otherwise(odd)
    p = F.when((dof < 1) | (h <= 0), F.lit(1.0)).when(h > 300, F.lit(0.0)).otherwise(p)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
