"""Row multiplicity: the size of a join's fan-out, and its rows, without running the join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens.functions.scalars import as_column, nvl


def multiplicity(*matches: Column | str) -> Column:
    """Rows that one left row becomes after left joins with these match counts (0 or NULL: 1)."""
    product = F.lit(1).cast("bigint")
    for n in matches:
        product = product * F.greatest(nvl(as_column(n), 0), F.lit(1))
    return product


def repeat_rows(df: DataFrame, times: str, chunk: int = 100_000) -> DataFrame:
    """Each row of ``df`` repeated ``times`` times (a positive count column, dropped).

    Expands in two steps so that neither array grows with the whole count: a row first
    becomes one row per ``chunk`` copies, those are spread over the cluster, and each then
    yields its copies.
    """
    columns = [F.col(f"`{c}`") for c in df.columns if c != times]
    chunks = df.select(
        *columns,
        F.col(times),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / chunk))).alias("_chunk"),
    )
    copies = F.least(F.lit(chunk).cast("bigint"), F.col(times) - F.col("_chunk") * chunk)
    return (
        chunks.repartition(*columns, F.col("_chunk"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .select(*columns)
    )
