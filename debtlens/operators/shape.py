"""Naming and selecting whole relations."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Display names, applied last. Names may hold spaces, parentheses and any script."""
    unknown = set(labels) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.withColumnsRenamed(dict(labels))


def snapshot(df: DataFrame, as_of: datetime.date | datetime.datetime, date_col: str = "snapshot_date") -> DataFrame:
    """One day of a dated relation; prunes partitions when stored by ``date_col``."""
    kind = "timestamp_ntz" if isinstance(as_of, datetime.datetime) else "date"
    return df.where(F.col(date_col) == F.lit(str(as_of)).cast(kind))
