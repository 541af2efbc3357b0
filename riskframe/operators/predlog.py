"""Prediction log: records, appends, reads, daily statistics, counters and batches."""

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C
from riskframe.functions.times import utc_day

log = logging.getLogger(__name__)

INPUT_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("air_temperature_k", T.DoubleType()),
    T.StructField("process_temperature_k", T.DoubleType()),
    T.StructField("rotational_speed_rpm", T.DoubleType()),
    T.StructField("torque_nm", T.DoubleType()),
    T.StructField("tool_wear_min", T.DoubleType()),
])


def log_records(
    df: DataFrame,
    threshold: float = C.THRESHOLD,
    model_name: str = C.MODEL_NAME,
    model_version: str = "unknown",
    with_inputs: bool = True,
) -> DataFrame:
    """Log records of scored rows; ``df`` brings ts, request_id, row_no, latency_ms, warnings.

    The alarm is decided on the unrounded score. Inputs can be left out (null).
    """
    inputs = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INPUT_SCHEMA])
    return df.select(
        "ts", "request_id",
        F.col("row_no").cast("int").alias("row_no"),
        F.round(C.PROBABILITY, 6).alias("probability"),
        (F.col(C.PROBABILITY) >= threshold).alias("alarm"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.round("latency_ms", 3).alias("latency_ms"),
        "warnings",
        (inputs if with_inputs else F.lit(None).cast(INPUT_SCHEMA)).alias("inputs"),
    )


def append_json(records: DataFrame, path: str) -> int:
    """Append records as gzipped JSON lines; a failed write is reported and returns 0, never raised."""
    return _append(records, lambda df: df.write.mode("append").json(path, compression="gzip"))


def append_table(records: DataFrame, path: str) -> int:
    """Append records to a table partitioned by day, nested fields as JSON text, alarm as 0/1."""
    flat = records.withColumns({
        "alarm": F.col("alarm").cast("int"),
        "warnings": F.to_json("warnings"),
        "inputs": F.to_json("inputs"),
        "day": utc_day("ts"),
    })
    return _append(flat, lambda df: df.write.mode("append").partitionBy("day").parquet(path))


def _append(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and return the rows written, counted on their way."""
    try:
        seen = Observation()
        write(df.observe(seen, F.count("*").alias("rows")))
        return seen.get.get("rows", 0)
    except Exception as e:  # noqa: BLE001 - a full log store must not stop scoring
        log.error("log records could not be written: %s", e)
        return 0


def read_json(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).json(path)


def features_from_log(records: DataFrame, latest: int | None = None) -> DataFrame:
    """Input columns and score of logged rows, from JSON text or struct inputs."""
    if latest is not None:
        records = latest_records(records, latest)
    if isinstance(records.schema["inputs"].dataType, T.StringType):
        records = records.withColumn("inputs", F.from_json("inputs", INPUT_SCHEMA))
    return records.where("inputs is not null").select("inputs.*", "probability")


def latest_records(records: DataFrame, n: int = 10) -> DataFrame:
    """The newest n records; a top-n per task, not a full sort."""
    order = [F.desc("ts")] + [F.desc(c) for c in ("id", "request_id", "row_no") if c in records.columns]
    return records.orderBy(*order).limit(n)


def daily_stats(records: DataFrame) -> DataFrame:
    """Rows, alarm rate, mean score and mean latency per UTC day, newest first."""
    return records.groupBy(utc_day("ts").alias("day")).agg(*stat_columns()).orderBy(F.desc("day"))


def stat_columns() -> list[Column]:
    return [
        F.count("*").alias("requests"),
        F.round(F.avg(F.col("alarm").cast("int")), 6).alias("alarm_rate"),
        F.round(F.avg("probability"), 6).alias("mean_probability"),
        F.round(F.avg("latency_ms"), 6).alias("mean_latency_ms"),
    ]


def counters(records: DataFrame) -> DataFrame:
    """Service counters over the log; warnings count messages, not rows.

    Rows are first reduced per request with map-side combining, so a request with very many rows
    is no heavier than any other.
    """
    per_request = records.groupBy("request_id").agg(
        F.max(F.col("failed").cast("int")).alias("failed"),
        F.count("*").alias("rows"),
        F.sum(F.col("alarm").cast("long")).alias("alarms"),
        F.sum(F.size("warnings").cast("long")).alias("warnings"),
        F.sum(F.col("inputs").isNotNull().cast("long")).alias("logged"),
        F.sum("latency_ms").alias("latency"),
    )
    return per_request.agg(
        F.count("*").alias("requests"),
        F.sum(F.col("failed").cast("long")).alias("requests_failed"),
        F.sum("rows").alias("predictions"),
        F.sum("alarms").alias("alarms"),
        F.sum("warnings").alias("warnings"),
        F.sum("logged").alias("logged"),
        (F.sum("rows") - F.sum("logged")).alias("log_failures"),
        F.round(F.sum("latency") / 1000, 3).alias("latency_seconds"),
    )


def batches(records: DataFrame, max_items: int = C.MAX_BATCH_ITEMS) -> DataFrame:
    """Rows of a request packed into batches of at most ``max_items`` items, in row order.

    A request is cut by row number, so no batch grows with the request.
    """
    item = F.struct("row_no", "probability", "alarm")
    return (
        records.groupBy("request_id", F.floor(F.col("row_no") / max_items).cast("int").alias("batch_no"))
        .agg(
            F.array_sort(F.collect_list(item)).alias("items"),
            F.round(F.sum("latency_ms"), 3).alias("latency_ms"),
        )
    )


def explode_batches(packed: DataFrame, max_items: int = C.MAX_BATCH_ITEMS) -> DataFrame:
    """One log row per batch item, all with the request's id and an equal share of its latency."""
    share = F.round(F.col("latency_ms") / F.size("items"), 6).alias("latency_ms")
    return packed.select(
        "request_id", "batch_no", share, F.posexplode("items").alias("pos", "item")
    ).select(
        "request_id", "batch_no",
        (F.col("batch_no") * max_items + F.col("pos")).alias("row_no"),
        "item.probability", "item.alarm", "latency_ms",
    )


def batch_predictions(df: DataFrame, threshold: float = C.THRESHOLD, model: str = C.MODEL_NAME) -> DataFrame:
    """Scored rows as answers: score, decision, threshold, model and row number per request."""
    return df.select(
        "request_id", "row_no",
        F.round(C.PROBABILITY, 6).alias("probability"),
        (F.col(C.PROBABILITY) >= threshold).alias("alarm"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(model).alias("model"),
    )


def batch_summary(answers: DataFrame) -> DataFrame:
    return answers.groupBy("request_id").agg(
        F.count("*").alias("rows"),
        F.sum(F.col("alarm").cast("long")).alias("alarms"),
        F.max("probability").alias("max_probability"),
    )
