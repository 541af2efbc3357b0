"""Structured Streaming: scoring with quarantine, daily statistics, and drift per micro-batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskframe import config as C
from riskframe.functions.times import utc_day
from riskframe.operators.contract import quarantine
from riskframe.operators.drift import DriftCheck
from riskframe.session import stage
from riskframe.sources import versions


def json_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def score_stream(
    points: DataFrame, score: Callable[[DataFrame], DataFrame], threshold: float = C.THRESHOLD
) -> DataFrame:
    """Validate and score a stream of operating points; rejected rows keep a null score."""
    scored = score(quarantine(points))
    p = F.when(F.col("accepted"), F.col(C.PROBABILITY))
    return scored.withColumn(C.PROBABILITY, p).withColumn("alarm", p >= threshold)


def append_stream(stream: DataFrame, path: str, checkpoint: str, by: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table, taking all data available now."""
    writer = stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    if by:
        writer = writer.partitionBy(by)
    return writer.trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeated records (request and row) arriving within the watermark."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["request_id", "row_no"])


def daily_stats_stream(records: DataFrame, delay: str = "1 day") -> DataFrame:
    """Sums per one-day tumbling window; the watermark bounds the state."""
    return (
        records.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("w"))
        .agg(
            F.count("*").alias("requests"),
            F.sum(F.col("alarm").cast("long")).alias("alarms"),
            F.sum("probability").alias("probability_sum"),
            F.sum("latency_ms").alias("latency_sum"),
        )
        .select(utc_day("w.start").alias("day"), "requests", "alarms", "probability_sum", "latency_sum")
    )


def update_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge the changed windows of every micro-batch into a versioned table of all windows.

    Each micro-batch commits one snapshot that names it, so a repeated one finds itself and is skipped: results
    are exact after a restart, and readers see one snapshot however many micro-batches there were.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = stage(batch, "changed-windows")  # read twice below; its state must run once

        def merged(now: DataFrame | None, version: versions.Version | None) -> DataFrame | None:
            if version is not None and version.meta["batch"] >= batch_id:
                return None
            new = batch if now is None else now.join(F.broadcast(batch.select("day")), "day", "left_anti").unionByName(batch)
            return new.coalesce(1)  # one row per window

        versions.update(spark, path, merged, {"batch": batch_id})

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_daily_stats(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every window as a static table: the newest snapshot."""
    n = F.col("requests")
    return versions.read(spark, path).select(
        "day", "requests",
        F.round(F.col("alarms") / n, 6).alias("alarm_rate"),
        F.round(F.col("probability_sum") / n, 6).alias("mean_probability"),
        F.round(F.col("latency_sum") / n, 6).alias("mean_latency_ms"),
    )


def drift_stream(
    stream: DataFrame, ref: DataFrame, path: str, checkpoint: str, min_rows: int = C.MIN_ROWS
) -> StreamingQuery:
    """A drift verdict per micro-batch against a static reference, which is stored once."""
    ref = stage(ref, "drift-reference")

    def check(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # several passes follow, and nothing of the batch is left behind
        try:
            DriftCheck(ref, batch).verdict(min_rows).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query; raises if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
