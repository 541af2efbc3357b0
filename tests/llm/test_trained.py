"""Trained operators: held-out accuracy, odd input. Piece lattice: round trip, sentencepiece's own paths."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.llm import dom, html, pieces, secrets, toxicity


def test_toxicity_on_held_out_rows(spark, prose):
    rng, rows = random.Random(1), []
    for i in range(1200):
        w, bad = prose(80, seed=i).split(), i % 6 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vileword", "Nastyword", "foulword"]))
        rows.append((i, " ".join(w), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    out = df.select("toxic", toxicity.is_held_out().alias("h"), toxicity.score(df, model).alias("s")).where("h").collect()
    assert len(out) > 200
    right = sum((r.s >= toxicity.REJECT) == bool(r.toxic) for r in out)
    assert right / len(out) > 0.97


def test_toxicity_learns_nothing_from_held_out_labels(spark, prose):
    docs = spark.createDataFrame([(i, prose(20, seed=i)) for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(toxicity.is_held_out(), 1).otherwise(0).alias("toxic"))
    used = toxicity.training_sample(docs, labels)
    assert used.where("toxic = 1").count() == 0 and used.count() > 100
    assert toxicity.training_sample(docs, labels, rows=10).count() == 10


def test_toxicity_odd_rows(spark, table):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (3, 7)], "doc_id long, toxic int")
    docs = table([(1, None), (2, ""), (2, "x" * 200_000), (None, "abc def")])
    out = docs.select(toxicity.score(docs, toxicity.train(docs, labels)).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in out) and len(out) == 4
    assert toxicity.without_toxic(docs, labels).columns == docs.columns
    assert toxicity.without_toxic(table([]), labels).count() == 0


@pytest.fixture(scope="module")
def page_model(spark):
    rng = random.Random(4)
    word = ["".join(rng.choice("abdeéginost") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows = [(i, "<article>" + "".join(f"<p>{' '.join(rng.choices(word, k=40))}.</p>" for _ in range(4)) + "</article>") for i in range(300)]
    return html.fit(html.labelled_pages(spark.createDataFrame(rows, "page_id long, html string")))


PAGES = {
    "<nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav><article><h1>A title</h1><p>First &amp; second\n  line.<br>Third.<p>Unclosed <b>bold text here</article><footer>&copy; me</footer>":
        "A title\nFirst & second line. Third.\nUnclosed bold text here",
    "<html><head><title>no</title><style>p{}</style><script>var a='</p>';</script></head><body><header><a href=/>Site</a></header><div class='cookie-banner'><p>We use cookies, really.</p></div><main><h1>Head</h1><p>Some long text of the page, with more words.</p><ul><li>one</li><li>two</li></ul></main><aside class=sidebar><ul><li><a href=x>Other</a></li></ul></aside><form><label>Mail</label><button>Go</button></form>":
        "Head\nSome long text of the page, with more words.\none\ntwo",
    "<div id=header>Top</div><div class=post><h2>T</h2><p>Body text one, and more of it here.</p><p>Body text two, and more.</p></div><div id=comments><div class=comment><p>I like it, thanks a lot for this.</p></div><div class=comment><p>Me too, really.</p></div></div>":
        "T\nBody text one, and more of it here.\nBody text two, and more.",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages_of_other_layouts(page_model, page):
    assert html.main_texts(page_model, [page]) == [PAGES[page]]


def test_held_out_layouts(spark, page_model):
    fresh = [html.labelled_page(10_000 + i, "<p>" + " ".join(f"w{k % 37}" for k in range(300)) + "</p>") for i in range(60)]
    good = total = 0
    for page in fresh:
        forest = html.Forest([dom.read_page(page)], page_model["index"])
        belief, _ = forest.passed(page_model["weights"], page_model["edges"])
        good += int(((belief[:, 1] >= -0.6931471805599453) == forest.labels).sum())
        total += len(forest.labels)
    assert good / total > 0.97


def test_marginals_equal_enumeration(page_model):
    import itertools

    import numpy as np

    nodes = dom.read_page("<div><p>a b c</p><ul><li>d<li>e</ul></div>")
    forest = html.Forest([nodes], page_model["index"])
    weights, edges = page_model["weights"], page_model["edges"]
    own = np.bincount(forest.rows, weights=weights[forest.cols], minlength=len(nodes))
    sums = np.zeros((len(nodes), 2))
    for state in itertools.product((0, 1), repeat=len(nodes)):
        e = sum(own[i] * s for i, s in enumerate(state))
        e += sum(edges[forest.kind[i], state[forest.parent[i]], state[i]] for i in range(1, len(nodes)))
        for i, s in enumerate(state):
            sums[i, s] += np.exp(e)
    belief, _ = forest.passed(weights, edges)
    assert np.allclose(np.exp(belief), sums / sums.sum(axis=1, keepdims=True))


def test_odd_pages(spark, page_model):
    odd = [None, "", "<", "<p", "<!-- x", "<script>never closed", "</p></div>", "<p>" * 2000 + "deep", "<div>" * 300 + "x"]
    assert len(html.main_texts(page_model, odd)) == len(odd)
    pages = spark.createDataFrame([(1, None, 2), (1, "<p>x</p>", 3)], "page_id long, html string, text int")
    assert pages.select(html.extract(pages, page_model)).count() == 2
    none = spark.createDataFrame([], "page_id long, html string")
    empty = html.fit(html.labelled_pages(none))
    assert none.select(html.extract(none, empty)).count() == 0


def test_secrets_held_out(spark, prose):
    rng, rows = random.Random(8), []
    for i in range(600):
        w = prose(30, seed=i).split()
        kind, hexes = i % 4, "".join(rng.choice("0123456789abcdef") for _ in range(32))
        if kind == 0:
            w[10:10] = ["token", "=", f'"{hexes}"']
        elif kind == 1:
            w[10:10] = ["password=" + hexes[:18]]
        elif kind == 2:
            w[10:10] = ["".join(rng.choice("0123456789") for _ in range(16))]
        else:
            w[10:10] = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOP23") for _ in range(14)) + "7Q"]
        rows.append((i, " ".join(w), f"src/{i % 3}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.weak_labels(secrets.candidates(docs))
    assert {r.doc_id for r in found.collect()} >= {i for i in range(600) if i % 4 < 3}
    hidden = found.withColumn("label", F.when(F.col("doc_id") % 5 != 0, F.col("label")))
    out = secrets.scan(hidden).where("doc_id % 5 = 0").collect()
    assert len(out) > 80
    assert all(r.secret == (r.doc_id % 4 != 2) for r in out)


def test_secrets_odd_rows(spark):
    schema = "doc_id long, text string, source string, label int"
    docs = spark.createDataFrame([(1, None, None, 1), (2, "", "a", 1), (None, "key 123456789012345678", None, 2), (None, "key 123456789012345678", None, 2), (3, "a" * 100_000, "b", 1)], schema)
    out = secrets.scan(secrets.weak_labels(secrets.candidates(docs))).collect()
    assert [(r.doc_id, r.n_chars, r.score) for r in out] == [(None, 18, 1.0)] * 2
    assert secrets.scan(secrets.weak_labels(secrets.candidates(docs.limit(0)))).count() == 0


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The public pieces as a unigram model, with moderate scores for runs of spaces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.score < -1e6:
            p.score = -40_000
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path), sentencepiece.SentencePieceProcessor(model_file=str(path)), proto


TEXTS = [
    "Hello world, this is a test.", "  two  spaces   and tabs\tand\nnewlines \n", "Éléphant über façade ñandú", "數學 is 漢字 and 𝒳 🙂",
    "literal ▁ mark ▁▁", "x" * 200, " " * 40, "\n\n\n", "12.345,67 a_b-c '²' ½", "word " * 300, "",
]


def test_pieces_round_trip(spark, table):
    vocabulary = pieces.load()
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(90, None), (1, TEXTS[1]), (None, "null id")]
    coded = pieces.encode(table(docs), vocabulary, block_bytes=300)
    out = coded.withColumn("back", pieces.decode(coded, vocabulary)).collect()
    assert sorted((r.doc_id or -1, r.back or "") for r in out) == sorted((i or -1, t or "") for i, t in docs)
    assert [r.ids for r in out if r.doc_id == 90] == [None]
    assert pieces.encode(table([]), vocabulary).count() == 0


def test_pieces_find_the_best_path(spark, table, unigram, prose):
    path, model, proto = unigram
    docs = [(i, t) for i, t in enumerate(TEXTS[:4] + TEXTS[8:10])] + [(50 + i, prose(40, seed=i)) for i in range(20)]
    got = {r.doc_id: r.ids for r in pieces.encode(table(docs), pieces.load(path)).collect()}
    score = lambda ids: sum(proto.pieces[i].score for i in ids)
    for i, text in docs:
        assert score(got[i]) == pytest.approx(score(model.encode(text)), abs=0.5), text


def test_crossing_vocabulary_is_refused():
    with pytest.raises(ValueError, match="cross"):
        pieces.Vocabulary([(300, "a b", -1.0)], list(range(256)), 301)
