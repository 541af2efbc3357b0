"""Shared helpers: tables, shared-folder stages, words as bytes, code-point columns."""

import os
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import stage, work_path

# Workers of a cluster need not have this package on their path: functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules["riskframe.llm"])

__all__ = ["lower_ascii", "read", "stage", "stage_wide", "text_bytes", "work_path"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: other ASCII becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
#: Lower-cases A-Z only; ``bytes.split`` then cuts at ``[\x20\x09-\x0D]+``.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_MASK = (1 << 64) - 1


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_wide(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``stage`` with the rows dealt out by ``keys`` first."""
    return stage(df.repartition(*keys), name)


def lower_ascii(col):
    """Lower-case A-Z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")), UPPER, LOWER)


def text_bytes(df: DataFrame, column: str = "text"):
    """Sum of the text bytes, a single number (0 for an empty table)."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64 finaliser) over uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bound within a task."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        import xxhash

        self.limit, self.digest = limit, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.digest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(m, n, dtype=np.uint64)
    for i in range(n):
        out = mix64(out ^ h[i : i + m]) if i else mix64(h[:m] + np.uint64(n))
    return out


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(df: DataFrame, prefix: str = "") -> list:
    """All columns of ``df``, whatever their names."""
    return [F.col(f"{prefix}`{c.replace('`', '``')}`") for c in df.columns]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches short enough that a batch of very long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
