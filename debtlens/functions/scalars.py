"""Scalar expressions and predicates.

Money is decimal throughout. Input amounts are ``decimal(18,2)``; sums and report
outputs are ``decimal(28,2)``, so that the type of a result does not depend on how many
terms it adds.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return as_column(c).cast(MONEY)


def total(c: Column | str) -> Column:
    return as_column(c).cast(TOTAL)


def nvl(c: Column | str, value: Column | str | int) -> Column:
    """``c``, or ``value`` where it is NULL. A plain ``value`` is a literal, not a column."""
    return F.coalesce(as_column(c), value if isinstance(value, Column) else F.lit(value))


def add0(*terms: Column | str) -> Column:
    """Sum of the terms, a NULL term counting as 0."""
    return reduce(add, (nvl(t, 0) for t in terms))


def constant(value: object, name: str) -> Column:
    """A constant column that always carries a name (engines name bare literals differently)."""
    return F.lit(value).alias(name)


def any_of(*predicates: Column) -> Column:
    return reduce(or_, predicates)


def all_of(*predicates: Column) -> Column:
    return reduce(and_, predicates)


def like_any(c: Column | str, patterns: Iterable[str]) -> Column:
    """SQL LIKE against any of the patterns; ``_`` and ``%`` are wildcards."""
    return any_of(*(as_column(c).like(p) for p in patterns))


def unlike(c: Column | str, pattern: str) -> Column:
    """NOT LIKE that is true for a NULL text."""
    return ~nvl(c, "").like(pattern)


def differs(c: Column | str, value: str, default: str) -> Column:
    """``c <> value`` with NULL read as ``default``."""
    return nvl(c, default) != F.lit(value)


def before(c: Column | str, as_of: datetime.date | datetime.datetime) -> Column:
    """Strictly before the start of the ``as_of`` day, which itself does not qualify.

    The bound is cast to the zoneless timestamp of the ledger columns, so it is a plain
    constant and reaches the file scan as a filter.
    """
    start = datetime.datetime(as_of.year, as_of.month, as_of.day)
    return as_column(c) < F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")


def decode(c: Column | str, labels: Mapping[str, str], default: Column | str) -> Column:
    """Code to label; an unknown code and a NULL code both give the default (text or a column)."""
    code, branches = as_column(c), list(labels.items())
    if not branches:
        return default if isinstance(default, Column) else F.lit(default)
    case = reduce(lambda case, b: case.when(code == b[0], F.lit(b[1])), branches[1:], F.when(code == branches[0][0], F.lit(branches[0][1])))
    return case.otherwise(default)


def missing_flag(c: Column | str, blank: str | None = "") -> Column:
    """``X`` where the joined key is NULL. ``blank=None`` gives NULL instead of ``''``."""
    return F.when(as_column(c).isNull(), F.lit("X")).otherwise(F.lit(blank).cast("string"))
