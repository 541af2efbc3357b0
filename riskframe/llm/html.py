"""HTML extraction by a tree-structured graphical model over DOM nodes.

Every block element and every block of text is a binary variable (content or not). A node's features
give its own potential, each parent-child edge a 2 x 2 potential by the kind of the child. Messages are
passed from the leaves to the root and back (sum-product); the resulting marginals decide which blocks
of text are kept. Weights are learned by gradient steps on the likelihood of labelled pages, the
gradient being observed minus expected features and edges under the same message passing.

Pages are read and scored inside tasks, a few at a time; messages of all their nodes are passed level by
level. The training sample is bounded (``TRAIN_PAGES``).

Defined results: a null or empty page, and one without content, has empty text; entities are decoded; white space
inside a block is one space; blocks are joined by line feeds in page order; ``br`` is white space; unclosed
and truncated markup is read to the end of the page; repeated rows get equal rows; an empty table gives an
empty table; extra columns pass through. Without labelled pages all blocks have marginal 0.5 and are kept.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import dom
from riskframe.llm.common import stage

#: Bound of the labelled pages that the model is fitted on.
TRAIN_PAGES = 1_200
STEPS, RATE, L2 = 150, 0.2, 2e-4

#: Page layouts for labelled pages. ``{p}`` stands for paragraphs, ``{s}`` for a short text,
#: ``{m}`` for a menu of links. ``data-main`` marks what is and is not the article.
LAYOUTS = (
    '<nav><ul>{m}</ul></nav><div class="ad">{s}</div><article data-main="1"><h1>{s}</h1>{p}</article><footer>&copy; {s}</footer>',
    '<header><a href="/">{s}</a><nav>{m}</nav></header><main data-main="1"><h1>{s}</h1>{p}</main><aside class="sidebar"><h3>{s}</h3><ul>{m}</ul></aside><footer><p>{s}</p></footer>',
    '<div id="top" class="navbar"><ul>{m}</ul></div><div class="wrapper"><div id="content" data-main="1"><h1>{s}</h1>{p}</div><div id="sidebar">{p}</div></div><div id="footer">{s}</div>',
    '<header class="site-header"><p>{s}</p></header><div class="cookie-notice"><p>{s}</p><button>{s}</button></div><article class="post" data-main="1"><h2>{s}</h2>{p}</article><section id="comments" class="comments"><h3>{s}</h3><ol><li><p>{c}</p></li><li><p>{c}</p></li></ol></section><footer>{s}</footer>',
    '<div class="header">{s}</div><div class="menu"><ul>{m}</ul></div><div class="post-content" data-main="1"><h1>{s}</h1>{p}<div class="ad" data-main="0">{s}</div>{p}</div><div class="related"><h4>{s}</h4><ul>{m}</ul></div><form action="/subscribe"><label>{s}</label><input><button>{s}</button></form>',
    '<table><tr><td class="menu">{m}</td><td class="content" data-main="1"><h1>{s}</h1>{p}</td></tr></table><div class="copyright">&copy; {s}</div>',
    '<nav class="breadcrumb">{m}</nav><article data-main="1"><header><h1>{s}</h1></header>{p}<aside class="promo" data-main="0"><p>{s}</p></aside>{p}<footer data-main="0">{s}</footer></article><div class="comment-list"><div class="comment"><p>{c}</p></div><div class="comment"><p>{c}</p></div><div class="comment"><p>{c}</p></div></div>',
    '<div class="banner sponsored"><p>{p}</p></div><section class="main"><article data-main="1"><h1>{s}</h1>{p}<ul><li>{t}</li><li>{t}</li></ul><blockquote>{t}</blockquote>{p}</article></section><div class="newsletter"><form><p>{s}</p><input><button>{s}</button></form></div><footer><ul>{m}</ul><p>&copy; {s}</p></footer>',
    '<div class="alert notice"><p>{t}</p></div><article data-main="1"><h1>{s}</h1>{p}<figure><figcaption>{s}</figcaption></figure>{p}<div class="share" data-main="0"><a href="#">{s}</a></div></article><aside><div class="widget">{p}</div></aside><div id="disqus_thread"><p>{c}</p><p>{c}</p></div>',
    '<header>{s}</header><main><article data-main="1"><h1>{s}</h1>{p}</article></main><section id="comments"><h2>{s}</h2><article class="comment"><p>{c}</p></article><article class="comment"><p>{c}</p></article></section><form><input><button>{s}</button></form>',
    '<article data-main="1">{t}</article>',
    '<nav>{m}</nav><article data-main="1">{t} {t}</article><footer>&copy; {s}</footer>',
    '<div data-main="1">{p}</div>',
    '<h1 data-main="1">{s}</h1><div data-main="1">{p}</div><div class="footer">{s}</div>',
    '<nav>{m}</nav><div class="entry" data-main="1"><h1>{s}</h1><p><b>{s}</b><br>{t}<p>{t}<p>{t}</div><div class="ads">{s}</div><footer>{s} &middot; {s}</footer>',
)


def _pieces(seed: int, texts: list[str]):
    """A source of paragraphs, short texts and menus from a page's own words."""
    words = [w for t in texts for w in t.split()] or ["text"]
    rng = np.random.default_rng(seed)

    def some(low: int, high: int) -> str:
        n, i = int(rng.integers(low, high)), int(rng.integers(0, len(words)))
        found, odd = words[i : i + n] or words[:n], rng.random()
        if odd < 0.1:  # no punctuation
            found = [w.strip(".,!?:;") or w for w in found]
        elif odd < 0.2:  # one word again and again
            found = [found[0].strip(".,!?:;") or found[0]] * n
        elif odd < 0.3:  # a table-like line
            found = [x for w in found for x in (w, "|")]
        elif odd < 0.4:
            found = found[:1]
        return " ".join(found).replace("&", "&amp;").replace("<", "&lt;")

    def dot() -> str:
        return "." if rng.random() < 0.8 else ""

    def many() -> int:
        return int(rng.integers(1, 9) if rng.random() < 0.75 else rng.integers(9, 60))

    return {
        "{p}": lambda: "".join(f"<p>{some(3, 120)}{dot()}</p>" for _ in range(many())),
        "{s}": lambda: some(1, 12),
        "{t}": lambda: some(4, 60) + dot(),
        "{c}": lambda: some(3, 70) + dot(),
        "{m}": lambda: "".join(
            f'<li><a href="/{i}">{some(1, 3)}</a></li>' for i in range(int(rng.integers(3, 9)))
        ),
    }


def labelled_page(seed: int, html: str | None) -> str:
    """A page of a layout drawn by ``seed``, filled with words of a given page."""
    fill = _pieces(seed, [n.text for n in dom.read_page(html) if n.tag == "#text"])
    body = LAYOUTS[seed % len(LAYOUTS)]
    for slot, make in fill.items():
        while slot in body:
            body = body.replace(slot, make(), 1)
    return f"<html><head><title>x</title></head><body>{body}</body></html>"


def labelled_pages(pages: DataFrame, rows: int = TRAIN_PAGES) -> DataFrame:
    """At most ``rows`` labelled pages (``html`` with ``data-main`` marks) made from pages' words."""

    @F.pandas_udf("string")
    def make(ids: pd.Series, pages: pd.Series) -> pd.Series:
        seeds = [int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) for i in ids]
        return pd.Series([labelled_page(s, h) for s, h in zip(seeds, pages, strict=True)], dtype=object)

    chosen = pages.select("page_id").where(F.col("page_id").isNotNull()).distinct().orderBy(
        F.xxhash64("page_id"), "page_id"
    ).limit(rows)
    few = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").dropDuplicates(["page_id"])
    return few.select(make("page_id", "html").alias("html"))


class Forest:
    """The nodes of some pages as one forest, with levels for message passing."""

    def __init__(self, pages: list[list[dom.Node]], index: dict[str, int], grow: bool = False):
        parents, rows, cols, kinds, depth, labels = [], [], [], [], [], []
        for nodes in pages:
            base, known = len(parents), []
            for i, (node, names) in enumerate(zip(nodes, dom.features(nodes), strict=True)):
                parents.append(node.parent + base if node.parent >= 0 else -1)
                kinds.append(dom.edge_kind(node))
                depth.append(node.depth)
                up = known[node.parent] if node.parent >= 0 else 0
                known.append(int(node.main) if node.main in ("0", "1") else up)
                for name in names:
                    k = index.setdefault(name, len(index)) if grow else index.get(name)
                    if k is not None:
                        rows.append(base + i)
                        cols.append(k)
            # a region above the article holds it: only nodes that lie in it count as content
            labels += known
        self.parent, self.kind = np.array(parents, np.int64), np.array(kinds, np.int64)
        self.rows, self.cols = np.array(rows, np.int64), np.array(cols, np.int64)
        self.labels = np.array(labels, np.int64)
        depth = np.array(depth, np.int64)
        self.levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]

    def passed(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product: the log-marginals of all nodes and of the edges above them."""
        n = len(self.parent)
        own = np.zeros((n, 2))
        own[:, 1] = np.bincount(self.rows, weights=weights[self.cols], minlength=n)
        up, told = own.copy(), np.zeros((n, 2))  # belief from below; message to the parent
        for level in reversed(self.levels):
            joint = edges[self.kind[level]] + up[level][:, None, :]  # parent state x own state
            told[level] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            for state in range(2):
                up[:, state] += np.bincount(self.parent[level], weights=told[level, state], minlength=n)
        belief = up.copy()
        pair = np.zeros((n, 2, 2))
        for level in self.levels:
            above = self.parent[level]
            rest = belief[above] - told[level]  # all that the parent knows but from this child
            joint = rest[:, :, None] + edges[self.kind[level]] + up[level][:, None, :]
            pair[level] = joint
            belief[level] = np.logaddexp(joint[:, 0, :], joint[:, 1, :])
        belief -= np.logaddexp(belief[:, 0], belief[:, 1])[:, None]
        flat = pair.reshape(n, 4)
        top = flat.max(axis=1, keepdims=True)
        flat = flat - top - np.log(np.exp(flat - top).sum(axis=1, keepdims=True))
        return belief, flat.reshape(n, 2, 2)


def fit(pages: DataFrame) -> dict:
    """Weights from labelled pages: maximum likelihood of their labels under the tree model."""
    texts = [r["html"] for r in stage(pages.select("html"), "labelled-pages").collect()]
    index: dict[str, int] = {}
    forest = Forest([dom.read_page(t) for t in texts], index, grow=True)
    theta = np.zeros(len(index) + dom.EDGE_KINDS * 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    below = np.flatnonzero(forest.parent >= 0)
    observed = np.zeros((dom.EDGE_KINDS, 2, 2))
    np.add.at(observed, (forest.kind[below], forest.labels[forest.parent[below]], forest.labels[below]), 1)
    for step in range(1, STEPS + 1 if texts else 1):
        weights, edges = theta[: len(index)], theta[len(index) :].reshape(-1, 2, 2)
        belief, pair = forest.passed(weights, edges)
        miss = forest.labels - np.exp(belief[:, 1])
        expected = np.zeros_like(observed)
        np.add.at(expected, forest.kind[below], np.exp(pair[below]))
        grad = np.append(
            np.bincount(forest.cols, weights=miss[forest.rows], minlength=len(index)), (observed - expected).ravel()
        ) / max(1, len(texts)) - L2 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        rate = RATE / (1 + step / 50)
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return {"index": index, "weights": theta[: len(index)], "edges": theta[len(index) :].reshape(-1, 2, 2)}


def main_texts(model: dict, pages: list[str | None]) -> list[str]:
    read = [dom.read_page(h) for h in pages]
    forest = Forest(read, model["index"])
    belief, _ = forest.passed(model["weights"], model["edges"])
    out, at = [], 0
    for nodes in read:
        mine = belief[at : at + len(nodes), 1]
        at += len(nodes)
        out.append("\n".join(n.text for n, b in zip(nodes, mine, strict=True) if n.tag == "#text" and b >= np.log(0.5)))
    return out


def extract(pages: DataFrame, model: dict, column: str = "html"):
    """The main text as a column over ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            out: list[str] = []
            for i in range(0, len(rows), 32):
                out += main_texts(shared.value, rows.iloc[i : i + 32].tolist())
            yield pd.Series(out, dtype=object)

    return text(F.col(column))
