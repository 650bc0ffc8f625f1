"""Session settings the reports are planned for. None of them changes a result.

Joins stay sort-merge joins where Spark does not broadcast: a report chains about ten of them
in one stage, and that many hash tables at once would not fit a task, while sorts spill.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Partitions that shuffles start with, before Spark merges small ones by their measured size: a
#: reduced fact of a few TB then has partitions of a few hundred MB.
PARTITIONS = 20_000
#: The size that Spark merges small partitions to, and splits hot ones by.
ADVISORY = "128m"


def settings(partitions: int = PARTITIONS, advisory: str = ADVISORY) -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        # Small shuffles start with as many and are merged by their measured size.
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory,
        # Splits hot keys where both sides of a join are plain shuffles; salting covers the rest.
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def configure(
    builder: SparkSession.Builder, partitions: int = PARTITIONS, advisory: str = ADVISORY
) -> SparkSession.Builder:
    """Set ``partitions`` to a few times the cores for small data, else leave the default."""
    for key, value in settings(partitions, advisory).items():
        builder = builder.config(key, value)
    return builder
