"""Benchmark decontamination by winnowing.

Texts and items are cut into words. Of every ``SPAN - GRAM + 1`` consecutive ``GRAM``-word hashes the
smallest is kept as a fingerprint, so any shared run of ``SPAN`` words shares a fingerprint. A text's
fingerprints are joined with the items' ones, and each hit is extended: the runs of ``SPAN`` words
around it are looked up among the items' runs. Items of fewer words are looked up whole.

The items are the stated query set. They are taken in blocks of at most ``BLOCK_BYTES`` of text (one
item at least), each sent to the executors; texts stay where they are and are read once per block.

Defined results: null, empty and wordless texts are clean and have no words; wordless items match
nothing; repeated items and items with equal identifiers count once; an item without identifier is
listed as ``null``; an empty benchmark leaves all texts clean; extra columns pass through. Words are
compared by 64-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import WORD_BYTES, WordHash, fresh, own_columns, rolling, text_bytes

SPAN, GRAM = 10, 5
BLOCK_BYTES = 8 * 1024 * 1024

_HITS = "n_words long, spans array<int>, items array<string>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Which hashes are the smallest of some run of ``width`` consecutive ones."""
    m = len(grams) - width + 1
    kept = np.zeros(len(grams), dtype=bool)
    if m <= 0:
        return kept
    low = grams[:m].copy()
    for i in range(1, width):
        np.minimum(low, grams[i : i + m], out=low)
    for i in range(width):
        kept[i : i + m] |= grams[i : i + m] == low
    return kept


def _postings(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, the start of each one's items, and the items."""
    if not pairs:
        return np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.int64)
    h = np.array([p[0] for p in pairs], dtype=np.uint64)
    items = np.array([p[1] for p in pairs], dtype=np.int64)
    order = np.lexsort((items, h))
    h, items = h[order], items[order]
    first = np.append(True, (h[1:] != h[:-1]) | (items[1:] != items[:-1]))
    h, items = h[first], items[first]
    keys, starts = np.unique(h, return_index=True)
    return keys, np.append(starts, len(h)), items


def index_items(items: list[tuple[str, str | None]], span: int = SPAN, gram: int = GRAM) -> dict:
    """Fingerprints and runs of a block of items."""
    hashes, names, prints = WordHash(), sorted({name for name, _ in items}), [np.empty(0, np.uint64)]
    number = {name: i for i, name in enumerate(names)}
    runs: dict[int, list] = {span: []}
    for name, text in items:
        h = hashes.of(words(text))
        if len(h) >= span:
            g = rolling(h, gram)
            prints.append(g[winnow(g, span - gram + 1)])
            runs[span] += [(int(x), number[name]) for x in rolling(h, span)]
        elif len(h):
            runs.setdefault(len(h), []).append((int(rolling(h, len(h))[0]), number[name]))
    return {
        "names": names,
        "prints": np.unique(np.concatenate(prints)),
        "runs": {n: _postings(pairs) for n, pairs in runs.items()},
        "span": span,
        "gram": gram,
    }


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted hash among sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def probe(index: dict, texts, hashes: WordHash) -> list[tuple[int, list, list]]:
    """Words, hit word ranges and item names of each text; the texts are hashed as one sequence."""
    each = [hashes.of(words(t)) for t in texts]
    lens = np.array([len(h) for h in each], dtype=np.int64)
    h = np.concatenate([*each, np.empty(0, np.uint64)])
    doc = np.repeat(np.arange(len(each)), lens)
    base = np.cumsum(lens) - lens
    span, gram = index["span"], index["gram"]
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    hits: dict[int, set] = {}
    for n, (keys, starts, items) in index["runs"].items():
        m = len(h) - n + 1
        if m <= 0 or not len(keys):
            continue
        if n == span:
            g = rolling(h, gram)
            near = np.flatnonzero(winnow(g, span - gram + 1))
            near = near[_found(index["prints"], g[near]) >= 0]
            # the runs that contain a matching fingerprint
            at = np.unique((near[:, None] - np.arange(span - gram + 1)[None, :]).ravel())
            at = at[(at >= 0) & (at < m)]
            wanted = np.full(len(at), n, dtype=np.uint64)
            wanted = rolling(h[at[:, None] + np.arange(n)].T.copy(), n)[0] if len(at) else wanted
        else:
            at, wanted = np.arange(m), rolling(h, n)
        same = doc[at] == doc[at + n - 1] if len(at) else np.empty(0, dtype=bool)
        at, wanted = at[same], wanted[same]
        k = _found(keys, wanted)
        at, k = at[k >= 0], k[k >= 0]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n, -1)
        for d, j in set(zip(doc[at].tolist(), k.tolist(), strict=True)):
            hits.setdefault(d, set()).update(items[starts[j] : starts[j + 1]].tolist())
    inside = np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]])
    out = []
    for d, n in enumerate(lens.tolist()):
        spans: list[int] = []
        if d in hits:
            part = np.concatenate([[0], inside[1 + base[d] : 1 + base[d] + n], [0]])
            edges = np.flatnonzero(np.diff(part))
            spans = edges.tolist()
        out.append((n, spans, sorted(index["names"][i] for i in hits.get(d, ()))))
    return out


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items, block by block."""
    blocks = max(1, -(-text_bytes(benchmark) // block_bytes))
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text"
    ).withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    for i in range(blocks):
        yield [(r["name"], r["text"]) for r in items.where(F.col("block") == i).select("name", "text").collect()]


def _hits(spark, items, span: int, gram: int):
    shared = spark.sparkContext.broadcast(index_items(items, span, gram))

    @F.pandas_udf(_HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for texts in batches:
            yield pd.DataFrame(probe(shared.value, texts, hashes), columns=["n_words", "spans", "items"])

    return hits


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _merged(spans: pd.Series) -> pd.Series:
    out = []
    for parts in spans:
        ranges = sorted((p[i], p[i + 1]) for p in parts for i in range(0, len(p), 2))
        flat: list[int] = []
        for a, b in ranges:
            if flat and a <= flat[-1]:
                flat[-1] = max(flat[-1], b)
            else:
                flat += [a, b]
        out.append([int(x) for x in flat])
    return pd.Series(out, dtype=object)


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All rows with ``_found``: ``n_words``, ``spans`` (flat start, end word pairs) and ``items``."""
    found, name = [], fresh(docs, "_found")
    for block in item_blocks(benchmark, block_bytes):
        found.append(_hits(docs.sparkSession, block, span, gram)(F.col("text")))
    names = [f"{name}{i}" for i in range(len(found))]
    wide = docs.select(*own_columns(docs), *[c.alias(n) for c, n in zip(found, names, strict=True)])
    spans = F.col(f"{names[0]}.spans")
    if len(names) > 1:
        spans = _merged(F.array(*[F.col(f"{n}.spans") for n in names]))
    return wide.select(
        *own_columns(docs),
        F.struct(
            F.col(f"{names[0]}.n_words").alias("n_words"),
            spans.alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.items") for n in names])))).alias("items"),
        ).alias(name),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows in which no item occurs, with their columns."""
    found = contamination(docs, benchmark)
    return found.where(F.size(f"{fresh(docs, '_found')}.items") == 0).select(*own_columns(docs))


def hit_words(spans: str = "spans"):
    """Number of words inside the flat ranges of a column."""
    return F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long")),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
