"""Joining to a side with one row per key when a few keys hold much of the other side.

Adaptive execution splits an oversized join partition only where both sides are plain
shuffles. Here the one-row-per-key side is itself the result of an aggregation or a window
over its shuffle, so the split has to be written out: rows of frequent keys are spread over
salts, and the matching row is copied once per salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.functions.scalars import nvl
from debtlens.operators.measuring import HOT_KEYS, Found, Measure, measure


def frequent_keys(
    df: DataFrame, key: str | Sequence[str], one_in: int = HOT_KEYS, rows: str | None = None
) -> DataFrame | None | dict[str, DataFrame | None]:
    """The values of a key, NULL included, that hold over ``1/one_in`` of the rows.

    Each comes with the number of salts that cuts its rows into pieces of about that share,
    fewer than ``2 * one_in`` pieces in all. None if there is no such value, so that a join
    without hot keys is planned without salts. ``rows`` names a column that says how many rows
    each row of ``df`` stands for, if ``df`` is an aggregate with one row per value.

    A sketch finds candidates of all keys asked for in one pass, which are counted exactly (see
    :func:`debtlens.operators.measuring.measure`); no value is shuffled that isn't a candidate. The
    result is fetched: fewer than ``one_in`` values of a key by arithmetic. Both sides of a join then
    see the same salts, also if the table grows in between. For a sequence of keys the answer is
    a dict by key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if rows is None:
        answer = salts_of(df, measure({"": (df, keys)}, one_in)[""], keys, one_in)
    else:
        answer = {k: _salts(df, k, *_largest(df, k, rows, one_in), one_in) for k in keys}
    return answer[key] if isinstance(key, str) else answer


def salts_of(df: DataFrame, measured: Measure, keys: Sequence[str], one_in: int = HOT_KEYS) -> dict[str, DataFrame | None]:
    """What :func:`frequent_keys` answers, from a measurement made before."""
    return {k: _salts(df, k, measured.frequent[k], measured.rows, one_in) for k in keys}


def _largest(df: DataFrame, key: str, rows: str, one_in: int) -> tuple[Found, int]:
    """The frequent values of an aggregate's key with their rows, and all rows."""
    total = df.agg(F.sum(rows)).first()[0] or 0
    found = df.where(F.col(rows) * one_in > F.lit(total)).select(F.col(key).cast("string"), rows).collect()
    return [(r[0], r[1]) for r in found], total


def _salts(df: DataFrame, key: str, found: Found, total: int, one_in: int) -> DataFrame | None:
    if not found:
        return None
    hot = [(v, -(-n * one_in // total)) for v, n in found]
    local = df.sparkSession.createDataFrame(hot, "_hot_key string, _salts int")
    return local.withColumn("_hot_key", F.col("_hot_key").cast(dict(df.dtypes)[key]))


def salted_left_join(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, hot: DataFrame | None
) -> DataFrame:
    """``df`` left-joined to ``dim`` (one row per ``dim_key``) on equal keys, NULL equal to NULL.

    ``hot`` comes from :func:`frequent_keys` of ``df``; without hot keys this is a plain join.
    A row's salt is a hash of the row, so a task that is run again sends it to the same place.
    Equal rows share a salt; where a key's rows may all be equal, use :func:`split_left_join`.
    """
    same_key = F.col(key).eqNullSafe(F.col(dim_key))
    if hot is None:
        return df.join(dim, same_key, "left")
    marks = F.broadcast(hot)
    salts = nvl("_salts", 1)

    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    rows = df.join(marks, F.col(key).eqNullSafe(F.col("_hot_key")), "left").withColumn(
        "_salt", F.pmod(row_hash, salts).cast("int")
    )
    copies = (
        dim.join(marks, F.col(dim_key).eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_hot_key", "_salts")
    )
    matches = same_key & (F.col("_salt") == F.col("_dim_salt"))
    return rows.drop("_hot_key", "_salts").join(copies, matches, "left").drop("_salt", "_dim_salt")


def split_left_join(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, hot: DataFrame | None
) -> DataFrame:
    """As :func:`salted_left_join`, for a ``df`` that is cheap to read twice.

    Rows of frequent keys meet their ``dim`` rows, fewer than ``HOT_KEYS`` by arithmetic, by broadcast:
    they stay in the tasks that read them, however many of them are equal. The others, none with
    more rows than a task can take, are joined plainly.
    """
    same_key = F.col(key).eqNullSafe(F.col(dim_key))
    if hot is None:
        return df.join(dim, same_key, "left")
    marks = F.broadcast(hot)
    few = dim.join(marks, F.col(dim_key).eqNullSafe(F.col("_hot_key")), "left_semi")
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    stay = df.join(marks, is_hot, "left_semi").join(F.broadcast(few), same_key, "left")
    rest = df.join(marks, is_hot, "left_anti").join(dim, same_key, "left")
    return stay.unionByName(rest)
