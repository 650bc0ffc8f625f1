"""Relations written once, so that everything that reads them sees the same rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and executors share.

    A session on one machine that names none gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="debtlens-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def fixed(df: DataFrame, name: str) -> DataFrame:
    """The rows that ``df`` has now: written as Parquet in the shared folder and read back.

    For relations that a plan reads in several places and that may change in between, or that
    are expensive to compute. Files are left to the folder's own clean-up.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
