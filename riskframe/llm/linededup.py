"""Line dedup: range-partitioned line hashes, streamed first occurrences, keep bitmaps.

Every line's key (stripped of ASCII white space, A-Z lower-cased) is hashed to 128 bits. The hashes
are range-partitioned by hash and document and sorted, so a very frequent line is spread over many
partitions; each partition is streamed and all but the first document of a key lose their lines. The
first key of a partition may have begun in the one before: such rows are settled from the first and
last key of each partition, a table with one row per partition. The result is one compressed bitmap
for each document that loses lines; texts are not moved for it.

Defined results: null and empty texts have one empty line; keys shorter than ``min_chars`` code
points never count; repeated lines inside the smallest document stay; rows with the same identifier
are one document (each row has its own bitmap); rows without identifier form one document that sorts
first; an empty table gives an empty table; extra columns pass through.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import LOWER_BYTES, fresh, own_columns, stage

MIN_CHARS = 10
SPACE = " \t\n\x0b\x0c\r"
#: Line rows for each range partition.
RANGE_ROWS = 250_000

_LINES = "doc_id bigint, version bigint, hi bigint, lo bigint, n_lines int, at array<int>"
_MARKS = f"kind string, part int, {_LINES}"


def _arrow(names: str) -> pa.Schema:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, types[t]) for n, t in (c.split(" ") for c in names.split(", "))])


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document row and distinct key: its hash and the key's line numbers."""
    schema = _arrow(_LINES)

    def split(batches):
        import xxhash

        for b in batches:
            rows = []
            for doc, version, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                lines, places = (text or "").split("\n"), {}
                for i, line in enumerate(lines):
                    key = line.strip(SPACE)
                    if len(key) >= min_chars:
                        places.setdefault(key.encode().translate(LOWER_BYTES), []).append(i)
                for key, at in places.items():
                    h = xxhash.xxh3_128_intdigest(key)
                    hi, lo = (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)
                    rows.append((doc, version, hi, lo, len(lines), at))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(split, _LINES)


def _stream(batches):
    """Rows sorted by key and document: what is certainly not first, what may not be, both ends."""
    schema = _arrow(_MARKS)
    part = TaskContext.get().partitionId()
    start = key = None
    first = None
    for b in batches:
        rows, cols = [], [b.column(i).to_pylist() for i in range(b.num_columns)]
        for doc, version, hi, lo, n, at in zip(*cols, strict=True):
            if (hi, lo) != key:
                key, first = (hi, lo), doc
                start = start or key
            if doc != first:
                rows.append(("drop", part, doc, version, hi, lo, n, at))
            elif key == start:
                rows.append(("doubt", part, doc, version, hi, lo, n, at))
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
    if key:
        ends = [("start", part, None, None, *start, None, None), ("end", part, None, None, *key, None, None)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*ends, strict=True), schema, strict=True)], schema=schema
        )


@F.pandas_udf(T.BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for n, gone in zip(n_lines, dropped, strict=True):
        keep = np.ones(int(n), dtype=bool)
        keep[np.asarray(gone, dtype=np.int64)] = False
        out.append(zlib.compress(np.packbits(keep).tobytes()))
    return pd.Series(out, dtype=object)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents that lose lines: identifier, text hash, lines lost, compressed keep bitmap."""
    lines = stage(line_hashes(docs, min_chars), "lines")
    parts = max(1, -(-lines.count() // RANGE_ROWS))
    order = ["hi", "lo", "doc_id"]
    marks = stage(
        lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_stream, _MARKS),
        "line-marks",
    )
    # one row per range partition: the key with which the partition before ended
    ends = marks.where(F.col("kind") == "end").select("part", "hi", "lo")
    by_part = Window.orderBy("part")
    before = ends.select(
        "part", F.lag("hi").over(by_part).alias("was_hi"), F.lag("lo").over(by_part).alias("was_lo")
    )
    doubt = marks.where(F.col("kind") == "doubt").join(F.broadcast(before), "part")
    gone = marks.where(F.col("kind") == "drop").select("doc_id", "version", "n_lines", "at").unionByName(
        doubt.where((F.col("hi") == F.col("was_hi")) & (F.col("lo") == F.col("was_lo"))).select(
            "doc_id", "version", "n_lines", "at"
        )
    )
    per_document = gone.groupBy("doc_id", "version").agg(
        F.max("n_lines").alias("n_lines"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("dropped"),
    )
    return per_document.select(
        "doc_id",
        "version",
        F.size("dropped").cast("long").alias("n_dropped"),
        _bitmap("n_lines", "dropped").alias("keep"),
    )


@F.pandas_udf(T.StringType())
def apply_bitmap(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
    """The lines that a bitmap keeps, joined by line feeds; null without bitmap."""
    out = []
    for text, packed in zip(texts, bitmaps, strict=True):
        if packed is None:
            out.append(None)
            continue
        lines = text.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=len(lines))
        out.append("\n".join([line for line, k in zip(lines, keep, strict=True) if k]))
    return pd.Series(out, dtype=object)


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row ``doc_id``, ``kept`` (the text without dropped lines), ``n_lines`` and ``n_dropped``."""
    joined, kept = _with_bitmaps(docs.select("doc_id", "text"), min_chars)
    return joined.select(
        "d.doc_id",
        kept.alias("kept"),
        F.size(F.split(F.coalesce("d.text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("m._n", F.lit(0)).alias("n_dropped"),
    )


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns; ``text`` loses its dropped lines, ``n_chars`` (if present) is counted anew."""
    joined, kept = _with_bitmaps(docs, min_chars)
    new = fresh(docs, "_kept")
    changed = {"text": F.col(new), "n_chars": F.char_length(new).cast("long")}
    return joined.select(*own_columns(docs, "d."), kept.alias(new)).select(
        *[changed[c].alias(c) if c in changed else own for c, own in zip(docs.columns, own_columns(docs), strict=True)]
    )


def _with_bitmaps(docs: DataFrame, min_chars: int):
    """The rows (``d``) with their bitmaps (``m``), and the kept text as a column over both."""
    maps = keep_bitmaps(docs, min_chars).select(
        F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "keep", F.col("n_dropped").alias("_n")
    )
    joined = docs.alias("d").join(
        maps.hint("shuffle_hash").alias("m"),
        F.col("d.doc_id").eqNullSafe(F.col("m._doc")) & (F.xxhash64("d.text") == F.col("m._version")),
        "left",
    )
    hit = F.when(F.col("m.keep").isNotNull(), F.col("d.text"))
    return joined, F.coalesce(apply_bitmap(hit, F.col("m.keep")), F.col("d.text"), F.lit(""))
