"""Session defaults, size limits and the shared scratch folder.

A place in the library that broadcasts either compares a counted size with the limits below and has a
distributed path beyond them, or sends a table whose size is bounded by construction: one row per
partition, or per class where classes have been counted.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest lookup table that is sent to every executor, by rows and by estimated bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20


def session(app: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings the library expects."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Return the folder all executors can write to, from ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process may do without the setting;
    it uses a folder below its warehouse.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tabloom-scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Return a fresh path below the shared folder; the files are removed when the session's JVM ends."""
    own = f"{shared_folder(spark)}/tabloom-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "stored", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it from there afterwards.

    Cuts the lineage: a lost executor costs a read of the files, not a new computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_small(df: DataFrame) -> bool:
    """Whether Spark estimates the table to fill less than one file split per core."""
    spark = df.sparkSession
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size < spark.sparkContext.defaultParallelism * split


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a small table out by ``keys``; others stay as they are.

    A small file is often read by one task, however costly its rows are. Give a table that is read or
    filtered, not one that was just joined or aggregated, since the estimate is best there.
    """
    return df.repartition(*keys) if _is_small(df) else df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Store a small table with a file per core, for steps that read it often or multiply its rows; like :func:`spread`."""
    return store(df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys), "dealt") if _is_small(df) else df


def row_bytes(df: DataFrame) -> Column:
    """Estimated size of a row: 16 bytes per column, and the length of texts, bytes and nested values."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(value), F.lit(0))
    return size


def fits_broadcast(rows: int, size: int | None) -> bool:
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def local_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """Turn a few driver-side rows into a DataFrame whose exact size the optimizer knows."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
