"""The analytic views over the given tables, built as lazy column projections."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config as C
from riskframe.functions.features import add_engineered, rounded
from riskframe.functions.ordering import numbered_rows
from riskframe.functions.times import from_utc_wall
from riskframe.session import stage

DAY_ZERO = "1995-01-01"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SMALL_INPUT_BYTES = 256 * 1024 * 1024


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small input over all cores; larger inputs keep their file splits.

    A small file is often a single row group, which one task reads and computes alone. Beyond the
    limit the splits already outnumber the cores, and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, *keys) if cores > 1 and size <= SMALL_INPUT_BYTES else df


def operating_points(spark: SparkSession, folder: str) -> DataFrame:
    """Machine operating points (key, type, five measures) from ``lineitem``, one row per row."""
    day = f"datediff(cast(l_shipdate as date), date '{DAY_ZERO}')"
    key = (
        "md5(concat_ws('|', cast(l_orderkey as string), cast(l_partkey as string),"
        " cast(l_suppkey as string), cast(l_linenumber as string),"
        f" cast(cast({rounded('l_extendedprice*100', 0)} as bigint) as string), cast({day} as string)))"
    )
    return spread_small(read_table(spark, folder, "lineitem"), "l_partkey", "l_suppkey").selectExpr(
        f"{key} as state_id",
        "l_partkey",
        "l_linenumber",
        "case l_returnflag when 'N' then 'L' when 'R' then 'M' else 'H' end as type",
        f"{rounded('295+l_discount*100', 1)} as air_temperature_k",
        f"{rounded('303+l_discount*100+l_tax*50', 1)} as process_temperature_k",
        "cast(floor(1150+l_extendedprice/60) as int) as rotational_speed_rpm",
        "3+l_quantity*1.5 as torque_nm",
        f"{day} % 254 as tool_wear_min",
    )


def machine_states(spark: SparkSession, folder: str) -> DataFrame:
    """Operating points with derived features, cause flags and the failure label."""
    base = operating_points(spark, folder)
    featured = add_engineered(base).withColumn(
        "temp_difference_k", F.expr(rounded("temp_difference_k", 1))
    )
    # cause flags: fixture rules, one condition per cause
    flagged = featured.withColumns({
        "twf": F.expr(
            "case when tool_wear_min between 200 and 240 and l_linenumber=1"
            " and l_partkey%5=0 then 1 else 0 end"
        ),
        "hdf": F.expr(
            "case when temp_difference_k<8.6 and rotational_speed_rpm<1380 then 1 else 0 end"
        ),
        "pwf": F.expr("case when power_w<600 or power_w>17500 then 1 else 0 end"),
        "osf": F.expr(
            "case when wear_torque_min_nm > case type when 'L' then 15500"
            " when 'M' then 16500 else 17500 end then 1 else 0 end"
        ),
        "rnf": F.expr("case when l_partkey%997=1 then 1 else 0 end"),
    })
    return flagged.withColumn(
        C.TARGET, F.when(F.expr("twf+hdf+pwf+osf > 0"), 1).otherwise(0)
    )


def fixed_score(
    temp_difference: str = "temp_difference_k",
    wear_torque: str = "wear_torque_min_nm",
    power: str = "power_w",
    parts: tuple[str, ...] = ("heat", "overload", "power"),
):
    """A fixed logistic scorer as a column; ``parts`` selects the terms it knows about."""
    terms = {
        "heat": f"0.9*case when {temp_difference}<8.6 then 1 else 0 end",
        "overload": f"0.00035*greatest({wear_torque}-13000,0)",
        "power": f"0.0006*greatest({power}-15500,0)-0.002*greatest(900-{power},0)",
    }
    body = "".join(f"-{terms[p]}" for p in parts)
    return F.expr(rounded(f"1/(1+exp(4{body}))", 6))


def scored_states(spark: SparkSession, folder: str) -> DataFrame:
    return machine_states(spark, folder).withColumn(C.PROBABILITY, fixed_score())


def stored_states(spark: SparkSession, folder: str, *cols: str) -> DataFrame:
    """Selected columns of the scored states, written once and read back.

    For operators that pass over the table several times: keys, labels and scores are computed
    once, and the later passes read narrow columns with filters pushed to the scan.
    """
    wanted = dict.fromkeys([C.KEY, *cols])
    return stage(scored_states(spark, folder).select(*wanted), "states")


def prediction_log(spark: SparkSession, folder: str, numbered: bool = False) -> DataFrame:
    """The scoring log from ``events``, one record per row.

    With ``numbered``, the rows of a request are numbered from 0 in ``row_no``.
    """
    day = F.to_date("ts")
    events = read_table(spark, folder, "events").withColumn(
        "request_id", F.concat_ws("-", F.col("user_id").cast("string"), day.cast("string"))
    )
    if numbered:
        events = numbered_rows(events, ["request_id"], "event_id", "row_no")
    p = F.round(F.least(F.col("value") / 500.0, F.lit(1.0)), 6)
    return events.select(
        F.col("event_id").alias("id"),
        from_utc_wall(F.col("ts").cast("timestamp")).alias("ts"),
        "request_id",
        *([F.col("row_no").cast("int").alias("row_no")] if numbered else []),
        p.alias("probability"),
        (p >= C.THRESHOLD).alias("alarm"),
        F.lit(C.THRESHOLD).alias("threshold"),
        F.round("value", 3).alias("latency_ms"),
        (F.col("event_type") == "error").alias("failed"),
        F.from_json("props", T.StructType([T.StructField("k", T.IntegerType())]))["k"].alias("k"),
        F.col("props").alias("inputs"),
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their quality labels (``doc_id`` is unique in both tables)."""
    labels = read_table(spark, folder, "labels")
    documents = read_table(spark, folder, "documents").select(
        "doc_id", "lang", "source", "n_chars"
    )
    return documents.join(labels, "doc_id")
