"""Records that exist in several versions per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens.functions.aggregates import preferred_version, sum_where


def split_by_version(
    df: DataFrame,
    key: str,
    version: str,
    columns: Sequence[str],
    versions: Sequence[int] = (1, 2),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with ``<column>_v<version>`` for each version, in one aggregation.

    Replaces a self-join per version. A version's columns travel together as one struct,
    so should a (key, version) pair be duplicated, its values still come from one row and
    always the same one. A version that a key lacks gives NULLs. ``extra`` adds
    aggregates over all versions to the same pass.
    """
    records = [
        F.max(F.when(F.col(version) == v, F.struct(*columns))).alias(f"_v{v}") for v in versions
    ]
    extra = dict(extra or {})
    grouped = df.groupBy(key).agg(*records, *(c.alias(n) for n, c in extra.items()))
    return grouped.select(
        key,
        *extra,
        *(F.col(f"_v{v}")[c].alias(f"{c}_v{v}") for v in versions for c in columns),
    )


def prefer_version(
    df: DataFrame,
    key: str,
    version: str,
    wanted: int = 2,
    default: int = 1,
    name: str = "pick_version",
) -> DataFrame:
    """Per key: ``wanted`` if any of its rows has that version, else ``default``."""
    return df.groupBy(key).agg(preferred_version(version, wanted, default).alias(name))


def picked_version_sums(
    df: DataFrame,
    key: str,
    version: str,
    amounts: Mapping[str, Column | str],
    where: Column,
    wanted: int = 2,
    default: int = 1,
) -> DataFrame:
    """Per key: null-safe sums over the rows that satisfy ``where`` and have the preferred version.

    The version is chosen from all rows of the key, before ``where``. Summing both
    candidate versions and choosing afterwards takes one pass, where joining the choice
    back to the rows would take two scans. Keys without a row to sum are absent.
    """
    candidates = [
        sum_where(amount, where & (F.col(version) == v)).alias(f"_{name}_{v}")
        for name, amount in amounts.items()
        for v in (wanted, default)
    ]
    matched = F.bool_or(where & (F.col(version) == wanted)), F.bool_or(where & (F.col(version) == default))
    is_wanted = F.col("_pick") == wanted
    return (
        df.groupBy(key)
        .agg(
            preferred_version(version, wanted, default).alias("_pick"),
            matched[0].alias("_has_wanted"),
            matched[1].alias("_has_default"),
            *candidates,
        )
        .where(F.when(is_wanted, F.col("_has_wanted")).otherwise(F.col("_has_default")))
        .select(
            key,
            *(
                F.when(is_wanted, F.col(f"_{name}_{wanted}"))
                .otherwise(F.col(f"_{name}_{default}"))
                .alias(name)
                for name in amounts
            ),
        )
    )
