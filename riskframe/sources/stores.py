"""Stored subsets, the drift reference sample, and report sinks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from riskframe import config as C


def write_splits(df: DataFrame, path: str) -> None:
    """One table partitioned by split; reading a subset prunes to its directory."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = _read(spark, path, "write_splits")
    return df if split is None else df.where(F.col("split") == split)


def write_reference(sample: DataFrame, path: str) -> None:
    """Store the reference sample with scores rounded to six decimals."""
    sample.withColumn(C.PROBABILITY, F.round(C.PROBABILITY, 6)).write.mode("overwrite").parquet(path)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "write_reference")


def write_report(df: DataFrame, path: str) -> None:
    """Append a result table as JSON lines."""
    df.write.mode("append").json(path)


def _read(spark: SparkSession, path: str, writer: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"nothing stored at {path}; call {writer} first") from e
