"""Chosen-path join against comparing all pairs."""

import random

import pytest
from brute import near

from riskframe.llm import neardup


def edited(text, n, seed):
    w, rng = text.split(), random.Random(seed)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"q{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture
def docs(prose):
    base = [prose(rng_n, seed=i) for i, rng_n in enumerate([40, 80, 200, 400, 30, 60])]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        for k in range(9):
            rows.append((100 + 10 * i + k, edited(t, k, seed=k * 7 + i)))
    rows += [(300 + k, base[0]) for k in range(5)]
    common = prose(25, seed=99)
    rows += [(400 + k, common + " " + prose(10, seed=1000 + k)) for k in range(60)]
    rows += [(500, ""), (501, None), (502, "  \n\t"), (503, "one"), (504, "ONE"), (505, "two words"), (506, "Two  Words")]
    return rows


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_equals_all_pairs(spark, table, docs, n, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(table(docs), n, percent).collect()}
    want = {i: (s, c, i == c) for i, (s, c) in near(docs, n, percent).items()}
    assert got == want


def test_large_groups_of_near_copies(spark, table, prose, monkeypatch):
    base = prose(120, seed=3)
    # all copies are near their original, few are near one another
    docs = [(200, base)] + [(k, edited(base, 2, seed=k)) for k in range(150)] + [(1000 + k, prose(50, seed=50 + k)) for k in range(40)]
    monkeypatch.setattr(neardup, "LEVELS", 2)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(docs), 3, 85).collect()}
    want = {i: c for i, (_, c) in near(docs, 3, 85).items()}
    assert got == want


def test_chained_copies_in_large_nodes(spark, table, prose, monkeypatch):
    # copies of copies: each is near the one before, the ends of a chain are near no common centre
    docs = []
    for chain in range(2):
        text = prose(200, seed=70 + chain)
        for k in range(60):
            docs.append((100 * chain + k, text))
            text = edited(text, 3, seed=1000 * chain + k)
    monkeypatch.setattr(neardup, "LEVELS", 2)
    monkeypatch.setattr(neardup, "SMALL", 3)
    want = {i: c for i, (_, c) in near(docs, 3, 85).items()}
    for outside, deeper in ((64, 4), (2, 1)):
        monkeypatch.setattr(neardup, "OUTSIDE", outside)
        monkeypatch.setattr(neardup, "DEEPER", deeper)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(docs), 3, 85).collect()}
        assert got == want


def test_odd_rows(spark, table):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "A B C D E F"), (3, "word " * 50_000)]
    out = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(table(docs)).collect())
    assert out == [(-1, -1, True), (-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    kept = neardup.one_of_each(table(docs))
    assert kept.columns == table(docs).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 3]
    assert neardup.near_duplicates(table([])).count() == 0
    assert neardup.one_of_each(table([])).count() == 0


def test_parities_drop_no_similar_pair(spark, prose):
    import numpy as np
    from pyspark.sql import functions as F

    from riskframe.llm.common import WordHash

    hashes, rows = WordHash(), []
    for i, n in enumerate([5, 40, 250, 1500, 6000]):
        text = prose(n, seed=i)
        a = neardup.shingles(text, 3, hashes)
        for k in [0, 1, *[round(n * x / 100) for x in (1, 2, 2.5, 3, 8, 12, 20)]]:
            b = neardup.shingles(edited(text, k, seed=n + k), 3, hashes)
            common = len(np.intersect1d(a, b))
            rows.append((*[(len(e), *neardup.parities(e)) for e in (a, b)], 100 * common / (len(a) + len(b) - common)))
    cell = "struct<size:long," + ",".join(f"{c}:long" for c in neardup._ODD) + ">"
    got = spark.createDataFrame(rows, f"l {cell}, r {cell}, percent double").select("percent", F.expr("l.size").alias("n"), neardup._parities_allow(85).alias("ok")).collect()
    assert all(r.ok for r in got if r.percent >= 85) and sum(r.percent >= 85 for r in got) >= 10
    far = [r for r in got if r.percent < 70 and 30 < r.n < 2000]
    assert len(far) >= 5 and not any(r.ok for r in far)


def test_pairs_below_the_threshold_are_not_confirmed_one_by_one(spark, table, prose, monkeypatch):
    # all pairs are somewhat below the threshold: many candidates, no link
    base = prose(220, seed=5)
    docs = [(k, edited(base, 7, seed=k)) for k in range(120)]
    monkeypatch.setattr(neardup, "LEVELS", 2)
    sizes, confirmed = [], neardup._confirmed
    monkeypatch.setattr(neardup, "_confirmed", lambda pairs, *more: sizes.append(pairs.count()) or confirmed(pairs, *more))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(docs), 3, 85).collect()}
    want = {i: c for i, (_, c) in near(docs, 3, 85).items()}
    assert got == want and sum(sizes) < 200


def test_full_sets_of_many_classes(spark, table, docs, monkeypatch):
    monkeypatch.setattr(neardup, "FEW_CLASSES", 0)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(docs), 3, 85).collect()}
    assert got == {i: c for i, (_, c) in near(docs, 3, 85).items()}


def _stages(monkeypatch):
    from riskframe.llm import components

    names, stage = [], neardup.stage
    for module in (neardup, components):
        monkeypatch.setattr(module, "stage", lambda df, name: names.append(name) or stage(df, name))
    return names


def test_groups_below_the_threshold_are_compared_without_branching_on(spark, table, prose, monkeypatch):
    # no link inside a large node: it is compared at once, not on every further level
    base = prose(220, seed=5)
    docs = [(k, edited(base, 7, seed=k)) for k in range(120)] + [(500, base)]
    monkeypatch.setattr(neardup, "LEVELS", 2)
    names = _stages(monkeypatch)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(docs), 3, 85).collect()}
    assert got == {i: c for i, (_, c) in near(docs, 3, 85).items()}
    assert [n for n in names if n.startswith("near-mixed")] == ["near-mixed-3"]
    assert "near-level-3" not in names


def test_settled_stars_are_not_repeated(spark, monkeypatch):
    from riskframe.llm.components import components

    names = _stages(monkeypatch)
    edges = [(k, 1) for k in range(2, 30)] + [(40, 41), (41, 42), (42, 41), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 30)} | {k: 40 for k in (40, 41, 42)}
    assert names == ["edges", "stars"]
    chain = spark.createDataFrame([(k, k + 1) for k in range(60)], "a long, b long")
    assert {r.component for r in components(chain, stored=True).collect()} == {0}
    assert components(chain.where("a < 0")).count() == 0
