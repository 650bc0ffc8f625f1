"""Joins to a side with one row per key when few keys hold most rows of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has over one in this many of the rows, so fewer keys than this are hot.
SHARE = 1000


def join_counted(rows: DataFrame, side: DataFrame, key: str, count: str, spread: str) -> DataFrame:
    """``rows`` joined to ``side`` (one row per key, ``count`` of them in ``rows``) on ``key``.

    Rows of a hot key are cut into pieces by the hash of their column ``spread``, and the key's
    row of ``side`` is copied once per piece, under ``2 * SHARE`` copies in all.
    """
    total, most = side.agg(F.sum(count), F.max(count)).first()
    if not most or most <= SHARE or most * SHARE <= total:
        return rows.join(side, key)
    hot = side.where(F.col(count) * SHARE > F.lit(total)).where(F.col(count) > SHARE)
    # Fewer than SHARE rows by arithmetic, fetched once so that both sides see the same pieces.
    found = [(r[0], int(r[1])) for r in hot.select(key, F.ceil(F.col(count) * SHARE / F.lit(total))).collect()]
    if not found:
        return rows.join(side, key)
    kind = rows.schema[key].dataType.simpleString()
    marks = F.broadcast(rows.sparkSession.createDataFrame(found, f"{key} {kind}, _pieces int"))
    cut = rows.join(marks, key, "left").withColumn(
        "_piece", F.pmod(F.xxhash64(spread), F.coalesce("_pieces", F.lit(1))).cast("int")
    )
    copies = side.join(marks, key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    )
    return cut.drop("_pieces").join(copies.drop("_pieces"), [key, "_piece"]).drop("_piece")
