"""Filter audit, SimHash near-dedup and conversation repair against plain versions."""

import random

import pytest
from brute import (
    audited,
    cheapest_repair,
    conversation_faults,
    linked,
    repaired_conversations,
    simhash,
)

from riskframe.llm import conversation_repair, filter_audit
from riskframe.llm import simhash as near

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def counts(frame):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in frame.collect()}


@pytest.fixture
def sourced(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, bits int, part string")

    return make


@pytest.fixture
def labelled(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


def test_audit_equals_plain(sourced, labelled, prose):
    long = [prose(200 + k, seed=k) for k in range(8)]
    docs = []
    for i in range(60):
        text = [long[i % 8], prose(30, seed=i), "same same " * 150, long[i % 3] + " #", "LOUD " * 30 + long[i % 8]][i % 5]
        docs.append((i, f"s{i % 3}", text))
    docs += [
        (100, None, None), (101, "", ""), (102, "s0", "\t \n"), (None, "s1", long[0]), (None, None, None), (103, "s1", long[0]),
        (103, "s1", long[0]), (103, "s2", long[0]), (104, "s2", "a b" * 90 + "é" * 300_000), (5, "s0", "x"),
    ]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 60, 3)] + [(0, 1, 0), (None, 1, 1), (999, 1, 1), (103, 1, None), (103, None, 1)]
    assert counts(filter_audit.audit(sourced(docs), labelled(labels))) == audited(docs, labels)


def test_audit_odd_tables(sourced, labelled):
    assert filter_audit.audit(sourced([]), labelled([(1, 1, 1)])).count() == 0
    got = counts(filter_audit.audit(sourced([(1, "a", "same")] * 40 + [(2, "a", "same")]), labelled([])))
    assert len(got) == 600 and got["a", "EABCD", 1] == (40, 1, 0, 0, 0, 0, 60)
    assert got["a", "ABCDE", 5] == (0, 0, 1, 0, 0, 0, 60)


def test_equal_hashes_of_different_texts_are_told_apart(spark):
    rows = [(1, 7, 4, "p", "left"), (2, 7, 4, "p", "rite"), (3, 7, 4, "p", "rite"), (4, 8, 4, "p", "rite")]
    docs = spark.createDataFrame(rows, "doc_id long, hash long, size int, part string, text string")
    assert [r.doc_id for r in filter_audit.repeated(docs, docs.drop("text")).collect()] == [3]


def test_fingerprints_equal_plain(spark, table, prose):
    texts = [prose(n, seed=n) for n in (1, 2, 3, 4, 50, 400)] + ["Ab  CD\tab cd AB CD ab cd", None, "", " \n", "é ü x", "word " * 5000]
    texts += [prose(5_000, seed=1) * 20]
    rows = table(list(enumerate(texts)))
    got = {r.doc_id: r.fingerprint for r in near.near_duplicates(rows).collect()}
    assert got == {i: f"{simhash(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("dense", [64, 3])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, dense):
    monkeypatch.setattr(near, "DENSE", dense)
    rng = random.Random(dense)
    prints = [rng.getrandbits(64) for _ in range(150)] + [0, (1 << 64) - 1, 1 << 63]
    for k in range(200):  # chains, stars and near misses around the first ones
        p = prints[rng.randrange(153 + k)]
        for b in rng.sample(range(64), rng.randint(1, 3)):
            p ^= 1 << b
        prints.append(p)
    base = rng.getrandbits(64)
    prints += [base ^ 1 << b for b in range(64)] + [base ^ 3 << b for b in range(0, 62, 2)]
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "p long")
    from riskframe.llm.components import components

    seen = {r.node: r.component for r in components(near.links(frame)).collect()}
    groups = {}
    for p, low in zip(signed, linked(prints), strict=True):
        groups.setdefault(low, set()).add(p)
    for group in groups.values():
        assert {seen.get(p, p) for p in group} == {min(group)}


def test_near_duplicates_equal_plain(spark, table, prose):
    rng = random.Random(9)
    docs = []
    for i in range(40):
        w = prose(400, seed=i).split()
        docs.append((i, " ".join(w)))
        for k in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            docs.append((100 + 10 * i + k, " ".join(v).upper() if k else " ".join(v)))
    docs += [(900, ""), (901, None), (902, " "), (5, docs[8][1]), (None, docs[0][1]), (None, "alone"), (903, docs[0][1])]
    prints = [simhash(t) for _, t in docs]
    low = {}
    for root, (i, _) in zip(linked(prints), docs, strict=True):
        if i is not None:
            low[root] = min(i, low.get(root, i))
    want = sorted((i is None, i or 0, f"{p:016x}", low.get(r)) for (i, _), p, r in zip(docs, prints, linked(prints), strict=True))
    out = near.near_duplicates(table(docs))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in out.collect()) == want
    assert near.near_duplicates(table([])).count() == 0


@pytest.fixture
def talk(spark):
    def make(rows):
        return spark.createDataFrame(
            [(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, gone int"
        )

    return make


def result(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r[n] for n in names) for r in frame.collect()}


def test_repair_equals_plain(talk):
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Why?", "well ", "Sure! \n", "", " \t", None, f"t{turn}.", f"t{turn}"])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None, 2]), role, text))
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (-5, 1, "user", "x.")] + [(700, 1, "user", "a.")] * 3
    rows += [(800, t, "user" if t % 2 == 0 else "assistant", "w" * 400_000 + " .") for t in range(6)]
    got = result(conversation_repair.repaired(conversation_repair.damaged(talk(rows))))
    assert got == repaired_conversations(rows)
    assert conversation_repair.repaired(conversation_repair.damaged(talk([]))).count() == 0


def test_conversation_of_dropped_rows_only(talk):
    import zlib

    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = result(conversation_repair.repaired(conversation_repair.damaged(talk([(conv, 0, "user", "a.")]))))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")}


@pytest.mark.parametrize(("settle", "base"), [(4096, 1_000_003), (7, 1_000_003), (4096, 0), (7, 1)])
def test_long_repairs_settled_and_with_colliding_hashes(monkeypatch, settle, base):
    """A hash base of 0 or 1 makes almost all prefixes collide; the result must not change."""
    monkeypatch.setattr(conversation_repair, "SETTLE", settle)
    monkeypatch.setattr(conversation_repair, "_HASH_BASE", base)
    rng = random.Random(base)
    for n in (0, 1, 40, 90):
        turns = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", f"{k}.", "c!"])) for k in range(n)]
        rows = [(*t, f) for t, f in zip(turns, conversation_faults(turns), strict=True)]
        repair = conversation_repair.Repair()
        for r in rows:
            repair.feed(*r)
        assert repair.result() == cheapest_repair(rows)


def test_edit_prefixes_compare_like_strings():
    rng = random.Random(1)
    edits, nodes = conversation_repair.Edits(), [(0, "")]
    for _ in range(400):
        at, text = rng.choice(nodes[-40:])
        e = rng.choice("DIKR")
        nodes.append((edits.add(at, e), text + e))
    for _ in range(3000):
        (x, s), (y, t) = rng.choice(nodes), rng.choice(nodes)
        assert edits.precedes(x, y) == (s < t)
        assert edits.text(x) == s
