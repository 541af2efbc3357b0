"""Reading raw files: header check and renaming, file hashes, content fingerprints."""

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C
from riskframe.session import by_value, stage

by_value(__name__)

RAW_TYPES = {
    "udi": T.LongType(), "product_id": T.StringType(), "type": T.StringType(),
    "air_temperature_k": T.DoubleType(), "process_temperature_k": T.DoubleType(),
    "rotational_speed_rpm": T.IntegerType(), "torque_nm": T.DoubleType(),
    "tool_wear_min": T.IntegerType(), C.TARGET: T.IntegerType(),
    **{c: T.IntegerType() for c in C.CAUSES},
}
BOM = "﻿"
HASH_LIMIT = 2**31 - 1  # a binary cell cannot be larger
BLOCK_BYTES = 8 * 1024 * 1024


def load_raw(spark: SparkSession, path: str, expected_rows: int | None = None) -> DataFrame:
    """Read raw CSV files with their original header under technical names.

    Fails when the files' headers differ, an expected column is absent, a value does not parse, or
    the row count differs; drops nothing. Types are declared, not inferred.
    """
    headers = (
        spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
        .select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
        .groupBy("file").agg(F.min_by("value", "line").alias("header")).select("header").distinct().limit(2).collect()
    )
    if len(headers) > 1:
        raise ValueError("the raw files differ in their headers: " + " | ".join(r["header"] for r in headers))
    names = [h.lstrip(BOM) for h in spark.read.option("header", True).csv(path).columns]
    absent = sorted(set(C.RAW_COLUMNS) - set(names))
    if absent:
        raise ValueError("expected columns are missing in the raw file: " + ", ".join(absent))
    schema = T.StructType([
        T.StructField(C.RAW_COLUMNS.get(n, n), RAW_TYPES.get(C.RAW_COLUMNS.get(n), T.StringType()))
        for n in names
    ])
    df = (
        spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
        .option("mode", "FAILFAST").csv(path)
    )
    if expected_rows is not None:
        found = df.count()
        if found != expected_rows:
            raise ValueError(f"unexpected row count: {found} instead of {expected_rows}")
    return df


def write_raw(df: DataFrame, path: str, bom: bool = True) -> int:
    """Write a table under the original header, optionally with a byte order mark.

    Returns the rows written; they are stored once, so that writing and counting see the same.
    """
    names = {tech: raw for raw, tech in C.RAW_COLUMNS.items()}
    cols = [F.col(t).alias(r) for t, r in names.items()]
    if bom:
        first = next(iter(names))
        cols[0] = F.col(first).alias(BOM + names[first])
    out = stage(df.select(*cols), "raw-rows")
    out.write.option("header", True).csv(path)
    return out.count()


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Read a current-data table by the suffix of its path: CSV or Parquet."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"neither .csv nor .parquet: {path}")


def file_hashes(spark: SparkSession, path: str, pattern: str = "*", cell_limit: int = HASH_LIMIT) -> DataFrame:
    """Size and SHA-256 per file, whatever its size.

    Files up to ``cell_limit`` bytes are hashed by Spark as one cell each; longer ones, which no cell can hold,
    are streamed in blocks into one running digest, a task per file. Spark's file scans skip empty files.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(path)
    )
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    hashed = files.where(F.col("length") <= cell_limit).select(
        name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )
    long = files.where(F.col("length") > cell_limit).select("path")
    return hashed.unionByName(
        long.repartition(F.col("path")).mapInPandas(block_hashes, "path string, bytes long, sha256 string").select(
            name, "bytes", "sha256"
        )
    )


def block_hashes(batches: Iterator[pd.DataFrame], block: int = BLOCK_BYTES) -> Iterator[pd.DataFrame]:
    """Digests of the files named in ``path``, a block in memory at a time."""
    for batch in batches:
        for path in batch["path"]:
            digest, size = hashlib.sha256(), 0
            uri = re.sub("^file:/+", "file:///", quote(path, safe=":/%"))
            store, inside = fs.FileSystem.from_uri(uri)
            with store.open_input_stream(inside) as stream:
                while part := stream.read(block):
                    digest.update(part)
                    size += len(part)
            yield pd.DataFrame({"path": [path], "bytes": [size], "sha256": [digest.hexdigest()]})


def check_integrity(spark: SparkSession, path: str, expected: dict[str, str], pattern: str = "*") -> DataFrame:
    """Hashes of the files at a path; an error when one differs from its frozen value.

    An empty expectation only computes.
    """
    hashes = file_hashes(spark, path, pattern)
    if expected:
        want = spark.createDataFrame(list(expected.items()), "file string, expected string")
        bad = (
            hashes.join(want, "file", "full")
            .where(~F.col("sha256").eqNullSafe(F.col("expected")))
            .orderBy("file").collect()  # at most the files and the expectations
        )
        if bad:
            raise ValueError("files differ from their frozen state: " + ", ".join(r["file"] for r in bad))
    return hashes


def table_fingerprint(df: DataFrame, cols: list[str]) -> DataFrame:
    """Order- and file-independent fingerprint of a table's content.

    Every row is hashed; the aggregate does not depend on how rows are spread over files.
    """
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols]))
    hashed = df.select(row.alias("h"))
    return hashed.agg(
        F.count("*").alias("rows"),
        F.sum(F.conv(F.substring("h", 1, 8), 16, 10).cast("long")).alias("hash_sum"),
        F.min("h").alias("hash_min"),
        F.max("h").alias("hash_max"),
    )
