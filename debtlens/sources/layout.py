"""A ledger stored for its reports: in buckets of the key that every report joins on.

Written once, such a ledger spares every later report the shuffle of its facts: reductions per
account and the joins between them work bucket by bucket, where the rows already are. The one shuffle
is paid by the writer, which deals rows to buckets before writing, so that each task writes one
file of one bucket, sorted by the key.

A bucket is read by one task, so a key that holds many buckets' worth of rows would make one task
of a report as large as itself. ``write_ledger`` looks for such keys (one sketch per relation) and
stores a relation that has any as plain files: in ranges of the key, but the rows of such keys as they
are read, however many of them are equal. Reports then shuffle it, after combining its rows on
the map side, and no task gets more than its share.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from debtlens.operators import measure, salts_of
from debtlens.operators.measuring import HOT_KEYS
from debtlens.sources.ledger import Ledger
from debtlens.sources.relations import RELATIONS

#: A key is too large for a bucket if it alone holds as many rows as this many buckets on average.
MOST_BUCKETS = 8
#: Rows of the largest relation in a bucket, where the writer chooses the number of buckets: few enough
#: that a task sorts its buckets of all relations in memory.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 8
#: Relations with one part per day, pruned by a report to the day it asks for.
DAILY = {"mv_ktb_day": "snapshot_date"}


@dataclass(frozen=True)
class Stored:
    """How a relation was stored: its buckets, 0 for plain files, and the keys that forbade buckets."""

    buckets: int
    hot: tuple[str | None, ...] = ()


def buckets_for(rows: int, most_buckets: int = MOST_BUCKETS) -> int:
    """Buckets for a ledger whose largest relation has so many rows: as many as the rows ask for, up to
    where a key too large for a bucket could hold less than the least share that is measured."""
    return min(max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)), HOT_KEYS * most_buckets)


def write_ledger(
    ledger: Ledger,
    namespace: str,
    buckets: int | None,
    location: str | None = None,
    names: Iterable[str] = tuple(RELATIONS),
    daily: bool = True,
    most_buckets: int = MOST_BUCKETS,
) -> dict[str, Stored]:
    """Write relations of ``ledger`` as tables of the catalog's ``namespace``, replacing those there.

    ``buckets`` should make a bucket of the largest fact a few hundred MB, and None chooses by its rows;
    all relations get the same number, as only equal numbers join without a shuffle. ``location`` is a
    folder for the files, else they are the catalog's own. ``daily`` keeps daily relations in parts by day. Reports
    read the result by ``Ledger.at(spark, namespace)``. The ledger must not be the one replaced.
    """
    names = list(names)
    frames = {n: ledger[n] for n in names}
    spark = next(iter(frames.values())).sparkSession
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    # One measuring job for all, of the keys alone; few buckets can hold any key.
    keys = {n: (frames[n].select(RELATIONS[n].key), [RELATIONS[n].key]) for n in names}
    sizes = {}
    if buckets is None:
        sizes = measure(keys)
        buckets = buckets_for(max(s.rows for s in sizes.values()), most_buckets)
    one_in = max(2, buckets // most_buckets)
    if buckets <= most_buckets:
        sizes = {}
    elif not sizes:
        sizes = measure(keys, one_in)
    out = {}
    for name, df in frames.items():
        key = RELATIONS[name].key
        size = sizes[name].over(one_in) if name in sizes else None
        hot = salts_of(df, size, [key], one_in)[key] if size else None
        values = tuple(v for v, _ in size.frequent[key]) if hot else ()
        path, day = location and f"{location}/{name}", DAILY.get(name) if daily else None
        if hot is None:
            # Bucket numbers are the shuffle's own hash: dealt so, every task holds one bucket.
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            _save(writer, "overwrite", f"{namespace}.{name}", path, day)
        else:
            is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
            stay, rest = (df.join(F.broadcast(hot), is_hot, how) for how in ("left_semi", "left_anti"))
            ranges = rest.repartitionByRange(buckets, key).sortWithinPartitions(key)
            _save(ranges.write, "overwrite", f"{namespace}.{name}", path, day)
            _save(stay.write, "append", f"{namespace}.{name}", path, day)
        out[name] = Stored(0 if hot else buckets, values)
    return out


def _save(writer: DataFrameWriter, mode: str, table: str, path: str | None, day: str | None) -> None:
    writer = writer.format("parquet").mode(mode)
    if day:
        writer = writer.partitionBy(day)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
