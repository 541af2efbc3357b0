"""Session helpers: a local session for tests, and the shared folder for written intermediates."""

import atexit
import functools
import shutil
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_WRITTEN: list[str] = []


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the operators assume (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # without the Python call site of every expression, plans with hundreds of them build much faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    base = tempfile.mkdtemp(prefix="riskframe-")
    atexit.register(shutil.rmtree, base, True)
    return base


def by_value(module: str) -> None:
    """Ship the module's functions to workers by value: they need not have this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder that all executors share.

    Where that is unset, a session that runs in one process gets a temporary folder for its lifetime;
    on a cluster it must be set, as executors do not see one another's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete what ``work_path`` has handed out so far; results that still read it are lost."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a table that no Python worker has to read."""
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    table = pa.table([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)], schema.names)
    return spark.createDataFrame(table, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a (small) intermediate once and read it back.

    Used where several results are derived from one summary: the source is scanned once, the
    lineage is cut, and a lost executor costs nothing because the data lies in shared storage.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
