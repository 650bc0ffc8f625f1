"""One row per key, and whole-partition totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debtlens.functions.aggregates import count_where
from debtlens.functions.scalars import as_column
from debtlens.operators.skew import frequent_keys, split_left_join


def pick_one(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """The first row of each key by ``order``, then ``tiebreak`` (a bare name sorts ascending).

    Write NULL placement into every ``order`` entry; engines disagree on the default. The
    tie-break is required so that the survivor does not depend on how rows were
    partitioned.

    ``row_number() = 1`` is the form Spark recognises: it keeps one row per key in each
    map task (WindowGroupLimit) before the shuffle, so duplicates of a hot key are gone
    before they would meet in one task.
    """
    if not tiebreak:
        raise ValueError("pick_one needs tie-break columns; without them the survivor is arbitrary")
    ties = [c if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in tiebreak]
    ranked = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def one_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per non-NULL key, for relations that should hold only one and might not.

    Among duplicates the smallest values win, NULLs last.
    """
    return pick_one(df.where(F.col(key).isNotNull()).select(key, *columns), [key], tiebreak=columns)


def distinct_keys(df: DataFrame, key: str, predicate: Column | None = None) -> DataFrame:
    """The distinct non-NULL keys among the rows that satisfy the predicate."""
    rows = df if predicate is None else df.where(predicate)
    return rows.select(key).where(F.col(key).isNotNull()).distinct()


def total_over(df: DataFrame, key: str, total: Column, name: str) -> DataFrame:
    """``df`` with ``total`` aggregated over all rows of each key, on every row.

    The value of an unordered window aggregate, NULL keys forming one group. A window would
    gather the rows of a key in one task; here totals combine on the map side, and rows of frequent
    keys get theirs by broadcast, without a shuffle, equal rows or not. The same aggregate says
    which keys are frequent.
    """
    totals = df.groupBy(F.col(key).alias("_total_key")).agg(total.alias(name), F.count(F.lit(1)).alias("_rows"))
    hot = frequent_keys(totals, "_total_key", rows="_rows")
    return split_left_join(df, totals.drop("_rows"), key, "_total_key", hot).drop("_total_key")


def count_over(df: DataFrame, key: str, predicate: Column, name: str) -> DataFrame:
    """``df`` with the number of rows of the same key that satisfy the predicate."""
    return total_over(df, key, count_where(as_column(predicate)), name)
