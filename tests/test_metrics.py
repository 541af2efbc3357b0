import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from score_tables import scored

from riskframe import config as C
from riskframe.operators import bootstrap, metrics, thresholds
from riskframe.operators.bootstrap import bootstrap_interval, replicates
from riskframe.operators.slicing import (
    cross_metrics,
    metrics_by_cause,
    overall_metrics,
    slice_cells,
    slice_metrics,
    worst_slices,
)


def brute_ap(y, p):
    total, ap, hits, seen = sum(y), 0.0, 0, 0
    for s in sorted(set(p), reverse=True):
        group = [a for a, b in zip(y, p, strict=True) if b == s]
        seen += len(group)
        hits += sum(group)
        ap += sum(group) / total * hits / seen
    return ap


def brute_auc(y, p):
    pos = [b for a, b in zip(y, p, strict=True) if a]
    neg = [b for a, b in zip(y, p, strict=True) if not a]
    return sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg)) / len(pos) / len(neg)


def test_ranking_metrics_equal_brute_force_with_ties(spark):
    rng = random.Random(3)
    y = [int(rng.random() < 0.2) for _ in range(400)]
    p = [round(rng.random() * 0.3 + 0.3 * v, 2) for v in y]
    got = metrics.evaluate(scored(spark, y, p), digits=12).first()
    assert got["pr_auc"] == pytest.approx(brute_ap(y, p))
    assert got["roc_auc"] == pytest.approx(brute_auc(y, p))
    assert got["tp"] == sum(a == 1 and b >= C.THRESHOLD for a, b in zip(y, p, strict=True))


def test_metrics_without_positives(spark):
    r = metrics.evaluate(scored(spark, [0, 0], [0.1, 0.01])).first()
    assert r["pr_auc"] is None and r["roc_auc"] is None
    assert r["recall"] == 0 and r["precision"] == 0 and r["cost_eur"] == 500


def test_cost_formula(spark):
    y = [1] * 44 + [0] * 42 + [1] * 7 + [0] * 3
    p = [0.9] * 86 + [0.01] * 10
    r = metrics.cost_summary(scored(spark, y, p)).first()
    assert r["cost_eur"] == 126_200
    assert r["do_nothing_eur"] == 510_000


def test_curve_equals_99_passes(spark):
    rng = random.Random(5)
    y = [int(rng.random() < 0.3) for _ in range(300)]
    p = [round(rng.random(), rng.choice([2, 6])) for _ in y]
    p[:4] = [0.06, 0.0, 1.0, 0.29]
    for r in thresholds.cost_curve(scored(spark, y, p)).collect():
        i = round(r["threshold"] * 100)
        hit = [b >= i / 100 for b in p]
        assert r["tp"] == sum(a and h for a, h in zip(y, hit, strict=True))
        assert r["fp"] == sum((not a) and h for a, h in zip(y, hit, strict=True))


def test_best_threshold_takes_the_largest_of_equals(spark):
    curve = thresholds.cost_curve(scored(spark, [0, 0, 1, 1], [0.01, 0.02, 0.90, 0.95]))
    best = thresholds.best_threshold(curve).first()
    assert best["threshold"] == 0.90 and best["cost_eur"] == 1600
    assert best["tied_candidates"] == 88


def test_bootstrap_is_reproducible_and_covers_the_estimate(spark):
    rng = random.Random(9)
    y = [int(rng.random() < 0.1) for _ in range(2000)]
    p = [round(min(1.0, max(0.0, rng.gauss(0.05 + 0.2 * v, 0.08))), 6) for v in y]
    df = scored(spark, y, p)
    first, again = (bootstrap_interval(df, 60).first() for _ in range(2))
    assert first == again and first["draws"] == 60
    assert first["pr_auc_low"] < brute_ap(y, p) < first["pr_auc_high"]


def test_bootstrap_skips_draws_without_positives(spark):
    df = scored(spark, [1] + [0] * 50, [0.5] + [0.1] * 50)
    n = replicates(df, 200).count()
    assert 100 < n < 152  # a single positive is drawn in about 63 % of the draws


@pytest.mark.parametrize("cells", [1, 40, 4096])
def test_bootstrap_agrees_with_plain_resampling(spark, monkeypatch, cells):
    monkeypatch.setattr(bootstrap, "BLOCK_CELLS", cells)
    rng = random.Random(4)
    y = [int(rng.random() < 0.15) for _ in range(600)]
    p = [round(min(1.0, max(0.0, rng.gauss(0.05 + 0.1 * v, 0.08))), 2 + cells % 3) for v in y]
    drawn = replicates(scored(spark, y, p), 2000).toPandas()
    assert (drawn["rows"] == 600).all() and len(drawn) == 2000
    plain = np.random.default_rng(7)
    aps, recalls, yy, pp = [], [], np.array(y), np.array(p)
    for _ in range(2000):
        at = plain.integers(0, 600, 600)
        aps.append(brute_ap(yy[at].tolist(), pp[at].tolist()))
        recalls.append(yy[at][pp[at] >= C.THRESHOLD].sum() / yy[at].sum())
    for got, want in ((drawn["pr_auc"], aps), (drawn["recall"], recalls)):
        assert got.mean() == pytest.approx(np.mean(want), abs=4 * np.std(want) / 2000**0.5)
        assert got.std() == pytest.approx(np.std(want), rel=0.08)
        for q in (0.025, 0.5, 0.975):
            assert got.quantile(q) == pytest.approx(np.quantile(want, q), abs=0.2 * np.std(want))


def test_resamples_of_any_size_keep_their_rows():
    """Cells far beyond any normal approximation: totals hold, spreads are those of the binomial."""
    totals = np.array([[3 * 10**15, 5], [10**12, 0]])
    blocks, cells = np.array([9, 4]), np.array([[2 * 10**15, 10**15], [10**12 - 7, 7]])
    drawn, before = bootstrap.resampled(9, blocks, totals, cells, 0, 400, 1)
    rest, upto = bootstrap.resampled(4, blocks, totals, np.array([[5, 0], [0, 0]]), 0, 400, 1)
    assert (before == 0).all() and (upto == drawn.sum(axis=2)).all()
    assert (drawn.sum(axis=(0, 2)) + rest.sum(axis=(0, 2)) == totals.sum()).all()
    assert drawn[1, :, 1].mean() == pytest.approx(7, abs=0.6) and drawn[1, :, 1].var() == pytest.approx(7, rel=0.3)
    share = 2 * 10**15 / totals.sum()
    assert drawn[0, :, 0].std() == pytest.approx((totals.sum() * share * (1 - share)) ** 0.5, rel=0.15)


def test_bootstrap_of_empty_tables(spark):
    row = bootstrap_interval(scored(spark, [1], [0.5]).limit(0)).first()
    assert row["draws"] == 0 and row["pr_auc_low"] is None
    assert bootstrap_interval(scored(spark, [0, 0], [0.5, 0.1])).first()["draws"] == 0


CAUSE_ROWS = [
    (1, 0.9, 1, 0), (1, 0.8, 0, 1), (1, 0.7, 0, 1), (1, 0.01, 1, 0), (0, 0.4, 0, 0),
    (0, 0.3, 0, 0), (0, 0.0, 0, 0), (0, 0.0, 0, 0), (0, 0.0, 0, 0), (0, 0.0, 0, 0),
]


def test_metrics_by_cause(spark):
    rows = [(y, p, t, h, 0, 0, 0) for y, p, t, h in CAUSE_ROWS]
    cols = "machine_failure int, probability double, twf int, hdf int, pwf int, osf int, rnf int"
    got = {r["cause"]: r for r in metrics_by_cause(spark.createDataFrame(rows, cols)).collect()}
    assert set(got) == set(C.CAUSES)
    assert (got["twf"]["failures"], got["twf"]["recall"]) == (2, 0.5)
    assert (got["hdf"]["failures"], got["hdf"]["recall"]) == (2, 1.0)
    assert got["osf"]["failures"] == 0 and got["osf"]["recall"] is None
    extra = spark.createDataFrame([*rows, (1, 0.5, 0, 0, 0, 0, 0)], cols)
    named = {r["cause"]: r["found"] for r in metrics_by_cause(extra).collect()}
    assert named["none recorded"] == 1


@pytest.fixture
def sliced(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(600):
        y = int(rng.random() < 0.15)
        rows.append((
            rng.choice("LMH"), y, round(min(1.0, max(0.0, rng.gauss(0.03 + 0.1 * y, 0.05))), 6),
            rng.randrange(0, 250), rng.uniform(3, 70), rng.randrange(1200, 2800),
            rng.uniform(7, 12), rng.uniform(500, 15000),
        ))
    df = spark.createDataFrame(
        rows, "type string, machine_failure int, probability double, tool_wear_min int,"
        " torque_nm double, rotational_speed_rpm int, temp_difference_k double, power_w double",
    )
    return df, *slice_cells(df)


def test_slices_add_up_to_the_whole(sliced):
    df, cells, labels = sliced
    whole = overall_metrics(cells).first()
    assert whole["rows"] == 600
    assert whole["cost_eur"] == metrics.cost_summary(df).first()["cost_eur"]
    sums: dict = {}
    for r in slice_metrics(cells, labels).collect():
        s = sums.setdefault(r["slice"], [0, 0, 0.0])
        s[0] += r["rows"]
        s[1] += r["fn"]
        s[2] += r["cost_share"]
    for rows, fn, share in sums.values():
        assert rows == 600 and fn == whole["fn"] and share == pytest.approx(1, abs=1e-5)


def test_slice_recall_is_null_without_failures(spark):
    rows = [("L", 0, 0.01, i, 1.0 * i, 1500 + i, 9.0, 5000.0 + i) for i in range(20)]
    df = spark.createDataFrame(
        rows, "type string, machine_failure int, probability double, tool_wear_min int,"
        " torque_nm double, rotational_speed_rpm int, temp_difference_k double, power_w double",
    )
    r = overall_metrics(slice_cells(df)[0]).first()
    assert r["recall"] is None and r["precision"] is None and r["f1"] is None


def test_unlisted_types_and_missing_measures_stay_in_all_tables(sliced):
    df, _, _ = sliced
    odd = df.limit(7).withColumns({"type": F.when(F.col("machine_failure") == 1, "X"), "tool_wear_min": F.lit(None).cast("int")})
    cells, labels = slice_cells(df.unionByName(odd))
    assert overall_metrics(cells).first()["rows"] == 607
    table = {(r["slice"], r["value"]): r["rows"] for r in slice_metrics(cells, labels).collect()}
    assert table["type", "other"] == 7 and table["wear_band", "missing"] == 7
    crossed = {r["row_value"]: r for r in cross_metrics(cells, labels, ("type", "wear_band")).collect()}
    assert crossed["other"]["rows_5"] == 7 and crossed["L"]["rows_5"] is None


def test_small_cells_are_masked_but_counted(sliced):
    _, cells, labels = sliced
    out = cross_metrics(cells, labels, ("type", "wear_band"), min_rows=50).collect()
    assert sum(r[f"rows_{i}"] or 0 for r in out for i in range(1, 5)) == 600
    for r in out:
        for i in range(1, 5):
            assert (r[f"rows_{i}"] or 0) >= 50 or r[f"recall_{i}"] is None


def test_worst_slices_are_sorted_by_gap(sliced):
    _, cells, labels = sliced
    gaps = [r["recall_gap"] for r in worst_slices(cells, labels, top=5).collect()]
    assert len(gaps) == 5 and gaps == sorted(gaps)
