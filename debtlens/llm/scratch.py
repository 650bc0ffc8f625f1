"""Tables written once in the shared folder of the cluster, to fix rows and cut lineage.

The folder is the one named by ``spark.checkpoint.dir``. Every executor and the driver see it,
so a lost executor costs only the tasks that it ran: nothing is kept on one machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH = 1000


def folder(spark: SparkSession) -> str:
    """The shared folder; a temporary one only for a session without a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    held = context.getCheckpointDir()
    if held is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="debtlens-"))
        held = context.getCheckpointDir()
    return held.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows move to and from Python workers in batches of ``BATCH`` at most while this holds.

    Rows here carry whole texts: Spark's default of 10,000 is some 30 MB on either side.
    """
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(BATCH, int(before)) if int(before) > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def begin_small_batches(spark: SparkSession) -> None:
    """As :func:`small_batches`, for a result that the caller writes, until :func:`end_small_batches`."""
    if not hasattr(spark, "_usual_batch"):
        spark._usual_batch = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(BATCH))


def end_small_batches(spark: SparkSession) -> None:
    """The session has its own size of batches again."""
    if hasattr(spark, "_usual_batch"):
        spark.conf.set(BATCH_ROWS, spark._usual_batch)
        del spark._usual_batch


def place(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet and read back."""
    spark = df.sparkSession
    path = place(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
    """The same rows, written in buckets of ``key``: joins and groups by it need no shuffle.

    Rows go to their buckets in the task that holds them, so writing shuffles nothing either.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets, key).option("path", place(spark, name)).format("parquet")
    with small_batches(spark):
        writer.saveAsTable(table)
    rows = spark.table(table)
    # The files stay and are known from here on; the catalog needs no entry for them.
    spark.sql(f"DROP TABLE {table}")
    return rows


def tidy(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files, broadcasts and plans that finished jobs left behind.

    Its cleaner acts on what the driver's garbage collector found unused, by itself every half
    hour; many small jobs in a row fill the driver's memory sooner.
    """
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
