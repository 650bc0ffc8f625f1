"""Joins. All are equi-joins; Spark chooses broadcast or shuffle from the sizes it sees."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens.operators.skew import frequent_keys, salted_left_join


def in_scope(df: DataFrame, scope: DataFrame, key: str, scope_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``scope``; multiplicity of ``df`` is kept."""
    keys = scope.select(F.col(scope_key or key).alias("_scope_key"))
    return df.join(keys, df[key] == keys["_scope_key"], "left_semi")


def exists_any(df: DataFrame, scope: DataFrame, scope_key: str) -> DataFrame:
    """All rows of ``df`` if ``scope`` holds any non-NULL key, else none.

    What a scope filter does when its condition compares the list's key with itself. Kept
    to document that behaviour; reports use a semi-join.
    """
    return df.where(scope.where(F.col(scope_key).isNotNull()).exists())


def left_join_where(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, condition: Column
) -> DataFrame:
    """Left join to the right rows that satisfy the condition; every left row is kept."""
    return left.join(right.where(condition), on, "left")


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    An outer join cannot split the rows of a key on its optional side over tasks. An inner
    join can, under adaptive execution, so matched and unmatched rows are made separately.
    Whether a row is matched is looked up among the distinct right keys, its frequent keys
    spread over salts; rows with a NULL key match nothing and are not shuffled for it.
    """
    found = right.where(F.col(key).isNotNull()).select(F.col(key).alias("_found")).distinct()
    keyed = left.where(F.col(key).isNotNull())
    marked = salted_left_join(keyed, found, key, "_found", frequent_keys(keyed, key))
    unmatched = marked.where(F.col("_found").isNull()).drop("_found")
    parts = [left.join(right, key), unmatched, left.where(F.col(key).isNull())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    columns: Sequence[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus ``columns`` of the matching ``dim`` row (at most one per ``dim_key``).

    Give ``hot``, the :func:`frequent_keys` of ``df``, when ``df`` is large and some keys may
    hold much of it: placeholder persons, one dominant bank, NULL.
    """
    side = dim.where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_dim_key"), *columns)
    if hot is None:
        joined = df.join(side, df[key] == side["_dim_key"], "left")
    else:
        joined = salted_left_join(df, side, key, "_dim_key", hot)
    return joined.drop("_dim_key")


Hop = tuple[DataFrame, str, str, Sequence[str]]


def chain_left(
    base: DataFrame, hops: Iterable[Hop], hot: Mapping[str, DataFrame | None] | None = None
) -> DataFrame:
    """Successive lookups ``(dim, key, dim_key, columns)``, each able to use the previous ones.

    Where a hop finds nothing, the hops that depend on it find nothing either. ``hot`` maps
    a key to its frequent values, if any.
    """
    for dim, key, dim_key, columns in hops:
        base = lookup(base, dim, key, dim_key, columns, (hot or {}).get(key))
    return base


def assemble(base: DataFrame, parts: Iterable[DataFrame], key: str = "acc_no") -> DataFrame:
    """``base`` left-joined to each part on the shared key.

    Parts must hold at most one row per key, so that the report has the rows of its base.
    All joins share one key: the base is shuffled once and each reduced part arrives
    already partitioned by it.
    """
    for part in parts:
        clash = (set(base.columns) & set(part.columns)) - {key}
        if clash:
            raise ValueError(f"column in more than one part: {sorted(clash)}")
        base = base.join(part, key, "left")
    return base
