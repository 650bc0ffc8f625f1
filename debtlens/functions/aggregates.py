"""Aggregate expressions.

All of them combine on the map side, so a key that holds a large share of the rows
reaches its reduce task as one partial result per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from debtlens.functions.scalars import as_column, nvl


def count_where(predicate: Column) -> Column:
    """Number of rows for which the predicate is true (not NULL)."""
    return F.count_if(predicate)


def sum_where(c: Column | str, predicate: Column) -> Column:
    """Sum over the rows that satisfy the predicate, NULL terms read as 0; NULL when none does."""
    return F.sum(F.when(predicate, nvl(c, 0)))


def neg_total(c: Column | str) -> Column:
    """Magnitude of the sum of the negative amounts; other amounts count as 0."""
    return F.abs(F.sum(F.when(nvl(c, 0) < 0, as_column(c)).otherwise(F.lit(0))))


def preferred_version(version: Column | str, wanted: int = 2, default: int = 1) -> Column:
    """``wanted`` if any row of the group has that version, else ``default``."""
    return F.when(F.bool_or(as_column(version) == wanted), F.lit(wanted)).otherwise(F.lit(default))


def latest_by(
    value: Column | str,
    order: Sequence[Column | str],
    tiebreak: Sequence[Column | str],
    where: Column | None = None,
) -> Column:
    """``value`` of the row that is last by ``order`` then ``tiebreak``, NULL ranking highest.

    The same row as ``first_value(value)`` over ``order by ... desc nulls first``. A plain
    ``max_by`` would skip a row whose order value is NULL; here each order value travels
    with its own is-null mark inside a struct, which is never NULL unless ``where`` rejects
    the row.
    """
    if not tiebreak:
        raise ValueError("latest_by needs tie-break columns; without them the survivor is arbitrary")
    ranked = [as_column(c) for c in (*order, *tiebreak)]
    rank = F.struct(*(part for c in ranked for part in (c.isNull(), c)))
    return F.max_by(as_column(value), rank if where is None else F.when(where, rank))
