"""Toxicity: character n-gram linear classifier scaled by naive Bayes log-count ratios.

A text's features are the distinct 4- and 5-grams of its lower-cased characters, hashed into
``2**BITS`` cells. A cell's value, where it occurs, is its naive Bayes log-count ratio; a logistic
regression is fitted on these values. Cells found in fewer than ``MIN_DOCS`` training texts or with
a ratio below ``MIN_RATIO`` carry no evidence and are left out.

Defined results: null and empty texts score the model's bias; texts are scored whole; repeated rows
score alike; an empty table gives an empty table. Rows labelled other than 0 or 1, or without
identifier, are not learned from. Without rows of both classes every text scores the smoothed share
of toxic rows. Scores depend on the text only: extra columns pass through unread.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import fresh, own_columns, stage

SIZES = (4, 5)
BITS = 20
MIN_DOCS, MIN_RATIO = 5, 0.5
#: Bound of the training sample: rows of the labels, in the order of a hash of their identifier.
TRAIN_ROWS = 12_000
STEPS, L2 = 80, 1e-4
REJECT = 0.3

_MODEL = "bias double, cells binary, weights binary"


def cells(text: str | None) -> np.ndarray:
    """Cells of all n-grams of a text, with repetitions."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = points.astype(np.uint64)
    out = [np.empty(0, dtype=np.int32)]
    for n in SIZES:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += points[i : i + m]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out.append((h >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def distinct_cells(texts: pd.Series) -> pd.Series:
    return pd.Series([np.unique(cells(t)) for t in texts], dtype=object)


def is_held_out(column: str = "doc_id"):
    """Rows never learned from: crc32 of the identifier as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts that are not held out, the same ones on every run."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out()
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _solve(rows: list[np.ndarray], y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Ratios, then full-batch adaptive gradient steps on the ratio-scaled cells."""
    none = np.empty(0, dtype=np.int32)
    n1 = int(y.sum())
    n0 = len(y) - n1
    bias = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    if not n1 or not n0:
        return bias, none, none.astype(np.float64)
    size = 1 << BITS
    pos, neg = np.zeros(size), np.zeros(size)
    for r, label in zip(rows, y, strict=True):
        (pos if label else neg)[r] += 1
    ratio = np.log((pos + 1) / (n1 + 2)) - np.log((neg + 1) / (n0 + 2))
    kept = np.flatnonzero((pos + neg >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO)).astype(np.int32)
    if not len(kept):
        return bias, none, none.astype(np.float64)
    index = np.full(size, -1, dtype=np.int32)
    index[kept] = np.arange(len(kept))
    used = [index[r] for r in rows]
    used = [u[u >= 0] for u in used]
    row = np.repeat(np.arange(len(used)), [len(u) for u in used])
    col = np.concatenate(used)
    scale = ratio[kept]
    theta = np.append(np.zeros(len(kept)), bias)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights=(theta[:-1] * scale)[col], minlength=len(y)) + theta[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.append(
            np.bincount(col, weights=miss[row], minlength=len(kept)) * scale + L2 * theta[:-1], miss.sum()
        )
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        rate = 0.05 / (1 + step / 40)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return float(theta[-1]), kept, theta[:-1] * scale


def fit(sample: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """Fit on labelled texts (``text``, ``toxic``): bias, cells and their weights.

    The sample is bounded (``training_sample``): its cells are computed on all executors and stored,
    one task solves the regression, and only the model (at most ``2**BITS`` weights) is returned.
    """
    stored = stage(sample.select(F.col("toxic"), distinct_cells("text").alias("cells")), "toxic-cells")

    def solve(batches):
        rows, labels = [], []
        for b in batches:
            column = b.column("cells")
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *(0 if n is None else n for n in column.value_lengths().to_pylist())])
            rows += [flat[i:j].copy() for i, j in zip(ends[:-1], ends[1:], strict=True)]
            labels += b.column("toxic").to_pylist()
        bias, kept, weights = _solve(rows, np.array(labels, dtype=np.float64))
        yield pa.RecordBatch.from_pydict(
            {"bias": [bias], "cells": [kept.tobytes()], "weights": [weights.tobytes()]},
            pa.schema([("bias", pa.float64()), ("cells", pa.binary()), ("weights", pa.binary())]),
        )

    model = stored.coalesce(1).mapInArrow(solve, _MODEL).first()
    if model is None:
        return 0.0, np.empty(0, dtype=np.int32), np.empty(0)
    return model["bias"], np.frombuffer(model["cells"], np.int32), np.frombuffer(model["weights"])


def score(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray], column: str = "text"):
    """The probability of label 1 as a column over ``docs``."""
    bias, kept, weights = model
    shared = docs.sparkSession.sparkContext.broadcast((float(bias), kept, weights))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        b, ids, w = shared.value
        table = np.zeros(1 << BITS)
        table[ids] = w
        for texts in batches:
            out = []
            for t in texts:
                c = cells(t)
                c = np.unique(c[table[c] != 0])
                out.append(1 / (1 + np.exp(-np.clip(b + table[c].sum(), -500, 500))))
            yield pd.Series(out, dtype="float64")

    return probability(F.col(column))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS):
    return fit(training_sample(docs, labels, rows))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = REJECT) -> DataFrame:
    """The documents scoring below ``limit``, with their columns."""
    name = fresh(docs, "_toxicity")
    scored = docs.withColumn(name, score(docs, train(docs, labels)))
    return scored.where(F.col(name) < limit).select(*own_columns(docs))
