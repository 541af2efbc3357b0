"""License scan and sketches against plain versions."""

import random

import pytest
from brute import jaccard, paragraphs, sha, words
from pyspark.sql import functions as F

from riskframe.llm import fingerprints, licenses


def plain(text):
    w, at, base = words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split(" ")
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                base.add(label)
    found, best = set(), 0.0
    for name, template in licenses.TEMPLATES.items():
        t = set(words(template))
        for line in (text or "").split("\n"):
            n, own = len(t & set(words(line))), set(licenses.REQUIRED[name].split())
            if n >= licenses._needed(len(t), licenses.CONTAINMENT) and own <= set(words(line)):
                found.add(name)
                best = max(best, n / len(t))
    ends = (min(at), max(at)) if at else (None, None)
    return (len(w), len(at), *ends, ",".join(sorted(base)), ",".join(sorted(base | found)), best)


def test_licenses_equal_plain(spark, table, prose):
    rng, docs = random.Random(2), []
    texts = list(licenses.TEMPLATES.values())
    for i in range(150):
        w = rng.choice(texts).split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(["the", "license", "zzz", "GNU"])
        docs.append((i, f"{prose(i % 30, seed=i)}\n{' '.join(w)} {prose(3, seed=i)}\nMIT, License {'mit license ' * (i % 3)}"))
    docs += [(200, None), (201, ""), (202, "..."), (203, "mit\nlicense"), (204, "MIT licenses"), (205, "general public license"), (206, "x " * 100_000 + "apache license")]
    got = {}
    for r in licenses.licenses(table(docs)).collect():
        got[r.doc_id] = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
    assert got == {i: plain(t) for i, t in docs}


def test_licenses_odd_rows(spark, table):
    docs = [(1, "mit license"), (1, "mit license"), (None, "released under the MIT License"), (None, None)]
    out = sorted((r.doc_id or -1, r.labels) for r in licenses.licenses(table(docs)).collect())
    assert out == [(-1, ""), (-1, "mit,mit-notice"), (1, "mit"), (1, "mit")]
    assert licenses.licenses(table([])).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("licensed under the GNU General Public License, version 3", "gpl,gpl-notice"),
        ("licensed under the GNU General Public License", "gpl"),
        ("licensed under the GNU Affero General Public License", "agpl-notice,gpl"),
        ("Released under the Apache License", "apache"),
        ("released under the MIT License", "mit,mit-notice"),
        ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0-notice"),
        ("the general public, licensed under a GNU license", ""),
    ],
)
def test_labels_need_their_own_words(spark, table, text, labels):
    assert [r.labels for r in licenses.licenses(table([(1, text), (2, text.replace(" ", "\n"))])).collect()] == [labels] * 2


WRAPPED = {
    "gpl-text": [
        "you can redistribute it and/or modify",
        "it under the terms of the GNU General Public License as published by",
    ],
    "bsd-text": [
        "Redistribution and use in source and binary forms, with or without",
        "modification, are permitted provided that the following conditions",
    ],
}


@pytest.mark.parametrize("name", sorted(WRAPPED))
@pytest.mark.parametrize("before", ["", " * ", "# "])
def test_licenses_outlive_line_breaks(spark, table, prose, name, before):
    lines = [prose(40, seed=1), *WRAPPED[name], prose(40, seed=2)]
    assert all(name not in plain(x)[5] for x in lines)
    narrow = [" ".join(w) for w in zip(*[iter(" ".join(lines).split())] * 3, strict=False)]
    docs = [(i, "\n".join(before + x for x in some)) for i, some in enumerate((lines, narrow, lines[:2], lines[2:]))]
    got = {r.doc_id: (r.labels.split(","), r.score) for r in licenses.licenses(table(docs)).collect()}
    assert all(name in got[i][0] and got[i][1] == 1.0 for i in (0, 1))
    assert all(name not in got[i][0] for i in (2, 3))


def test_license_windows_equal_plain(spark, table, prose):
    rng, docs = random.Random(4), []
    for i in range(60):
        w = " ".join(rng.choice(list(licenses.TEMPLATES.values())) + " " + prose(2, seed=i) for _ in range(3)).split()
        for _ in range(rng.randrange(12)):
            w.insert(rng.randrange(len(w)), rng.choice(["the", "license", "zzz", "GNU"]))
        docs.append((i, "".join(x + rng.choice(" \n") for x in w)))

    def reached(text):
        w, out, best = words(text), set(plain(text)[5].split(",")) - {""}, plain(text)[6]
        for name, template in licenses.TEMPLATES.items():
            t = set(words(template))
            o = licenses._needed(len(t), licenses.CONTAINMENT)
            size = len(words(template)) + len(t) - o
            own = set(licenses.REQUIRED[name].split())
            seen = [set(w[i : i + size]) for i in range(len(w))]
            n = max((len(t & x) for x in seen if own <= x), default=0)
            if n >= o:
                out.add(name)
                best = max(best, n / len(t))
        return ",".join(sorted(out)), best

    got = {r.doc_id: (r.labels, r.score) for r in licenses.licenses(table(docs)).collect()}
    assert got == {i: reached(t) for i, t in docs}


@pytest.mark.parametrize("rows_per_range", [200_000, 7])
def test_fingerprints_equal_plain(spark, table, prose, monkeypatch, rows_per_range):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", rows_per_range)
    docs = [(i * 3, "\n".join(prose(10, seed=i * 50 + k) + "." for k in range(i % 40))) for i in range(45)]
    docs += [(500 + i, docs[30][1].replace("a", "b", i)) for i in range(4)]
    docs += [(600, None), (601, ""), (602, "\n\n"), (603, "é" * 10), (604, "same\n" * 50), (605, docs[10][1])]
    got = {r.doc_id: r for r in fingerprints.fingerprints(table(docs)).collect()}
    order = sorted(docs, reverse=True, key=lambda d: d[0])
    prints = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        a, b, c = paragraphs(text), paragraphs(edited), paragraphs(after)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        assert r.near_edited == pytest.approx(jaccard(a, b)) and r.near_next == pytest.approx(jaccard(a, c))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_peeling_recovers_or_says_so(spark):
    def keys(low, high):
        raw = F.transform(F.sequence(F.lit(low), F.lit(high)), lambda x: F.xxhash64(x).bitwiseAND(F.lit(-65536)))
        return F.transform(raw, lambda h: h.bitwiseOR(F.xxhash64(h).bitwiseAND(F.lit(65535))))

    df = spark.range(1).select(keys(1, 200).alias("one"), keys(6, 203).alias("two"), keys(1000, 1300).alias("three"))
    few = F.expr(fingerprints.peeled_sql(fingerprints.minus_sql(fingerprints.cells_sql("one"), fingerprints.cells_sql("two"))))
    many = F.expr(fingerprints.peeled_sql(fingerprints.minus_sql(fingerprints.cells_sql("one"), fingerprints.cells_sql("three"))))
    tries = [F.expr(fingerprints._larger("one", "three", 4, seed)) for seed in (11, 23, 37, 41)]
    out = df.select(few.alias("few"), many.alias("many"), F.array(*tries).alias("larger")).first()
    assert (out.few.a, out.few.b, out.few.done) == (5, 3, True)
    assert not out.many.done
    recovered = [(t.a, t.b) for t in out.larger if t.done]
    assert recovered and set(recovered) == {(200, 301)}


def test_fingerprints_odd_rows(spark, table):
    one = fingerprints.fingerprints(table([(1, "abc def")])).first()
    assert one.edited_sha256 == sha("abc d" + "ab") and one.near_next == 1.0
    docs = [(2, "x y."), (2, "x y."), (None, "z.\n" * 30_000), (1, "q")]
    out = fingerprints.fingerprints(table(docs)).collect()
    assert sorted(r.doc_id or -1 for r in out) == [-1, 1, 2, 2]
    assert fingerprints.fingerprints(table([])).count() == 0
