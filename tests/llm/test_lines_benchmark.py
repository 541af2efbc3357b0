"""Line dedup and winnowing against plain versions."""

import pytest
from brute import hits, line_dedup

from riskframe.llm import decontaminate, linededup


@pytest.fixture
def lined(prose):
    shared = [prose(4, seed=k) for k in range(6)]
    rows = []
    for i in range(80):
        lines = [prose(5, seed=100 + i * 7 + k) for k in range(i % 5)]
        lines += [shared[k] for k in range(6) if (i * (k + 3)) % 4 == 0]
        lines += ["the very same line"] * (1 + i % 2) + ["short", ""]
        rows.append((i, "\n".join(lines)))
    return rows + [(100, "\t " + shared[0].upper() + " \r\n" + shared[0]), (101, None), (102, ""), (103, "\n\n")]


@pytest.mark.parametrize("per_range", [250_000, 20])
def test_line_dedup_equals_plain(spark, table, lined, monkeypatch, per_range):
    monkeypatch.setattr(linededup, "RANGE_ROWS", per_range)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in linededup.deduplicated(table(lined)).collect()}
    assert got == line_dedup(lined)


def test_line_dedup_odd_rows(spark, table):
    line = "a line of some length"
    docs = [(5, line), (5, line), (None, line), (7, f"{line}\n" * 3 + "x" * 300_000)]
    out = sorted(((r.doc_id or -1), r.kept[:30], r.n_dropped) for r in linededup.deduplicated(table(docs)).collect())
    assert out == [(-1, line, 0), (5, "", 1), (5, "", 1), (7, "x" * 30, 3)]
    same = linededup.without_repeats(table(docs))
    assert same.columns == table(docs).columns and same.count() == 4
    assert linededup.deduplicated(table([])).count() == 0


@pytest.fixture
def items(spark, prose):
    rows = [(i, prose(30, seed=500 + i)) for i in range(12)]
    rows += [(20, prose(9, seed=600)), (21, "three word item"), (22, ""), (23, None), (24, rows[0][1]), (None, prose(12, seed=700))]
    return rows


@pytest.mark.parametrize("block_bytes", [8 * 1024 * 1024, 400])
def test_decontamination_equals_plain(spark, table, prose, items, block_bytes):
    docs = []
    for i in range(60):
        text = items[i % 12][1].split()
        docs.append((i, f"{prose(i, seed=i)} {' '.join(text[i % 9 : i % 9 + 5 + i % 17])}, {prose(3, seed=i + 1)}"))
    docs += [(100, items[0][1].upper()), (101, items[12][1]), (102, "Three, WORD\nitem"), (103, None), (104, "..."), (105, items[-1][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, block int")
    found = decontaminate.contamination(table(docs), bench, block_bytes=block_bytes)
    got = {}
    for r in found.collect():
        f = r._found
        got[r.doc_id] = (f.n_words, sum(f.spans[1::2]) - sum(f.spans[::2]), f["items"])
    want = hits(docs, [("null" if i is None else i, t) for i, t in items])
    assert got == want
    left = decontaminate.clean(table(docs), bench)
    assert left.columns == table(docs).columns
    assert {r.doc_id for r in left.collect()} == {i for i, v in want.items() if not v[2]}


def test_decontamination_odd_tables(spark, table, prose):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = [(1, prose(40)), (1, None), (None, "x")]
    assert decontaminate.clean(table(docs), none).count() == 3
    one = spark.createDataFrame([(1, prose(20, seed=1)), (1, prose(20, seed=1))], "item_id long, text string")
    long = prose(60_000, seed=2) + " " + prose(20, seed=1)
    out = decontaminate.contamination(table([(1, long), (2, long)]), one).collect()
    assert [(r._found.spans, r._found["items"]) for r in out] == [([60_000, 60_020], ["1"])] * 2
    assert decontaminate.clean(table([]), one).count() == 0
