"""The driver list: which entities a report is about.

Reports reduce every fact to one row per key and then left-join it to the list. Filtering
by key and reducing per key commute, so there are equivalent orders, and which one is
cheap depends on the length of the list and on how much of the facts it names:

* a short list is broadcast and drops foreign fact rows inside the scan tasks, before any
  shuffle;
* of a list of a few million keys a Bloom filter is broadcast and drops nearly all foreign rows
  in the scan tasks; the join to the list, which comes after the reduction, drops the rest;
* a longer list is not broadcast in any form. Facts are reduced first (partial results per map
  task, so a hot key is never gathered raw), and the list meets them in a co-partitioned join.

``Scope.of`` measures the list once to choose. Every broadcast the package asks for is bounded
by such a measurement or by a limit; the remaining joins leave the choice to Spark's own size
check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.operators.bloom import filterable, key_filter, may_hold, words_for
from debtlens.operators.measuring import Measure, measure

# Bounds of a broadcast: far below what an executor holds, and far above a usual list.
MAX_BROADCAST_KEYS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A filter's words take about an eighth of the room of the keys it is built from.
FILTER_FACTOR = 8
# Names in a filter; more become a relation.
MAX_LITERALS = 1000


def fits(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_KEYS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    measured: Measure | None = None,
) -> bool:
    """Whether ``df`` is short enough to broadcast, by its rows and text bytes."""
    size = measured or measure({"": (df, ())})[""]
    return size.rows <= max_rows and size.text_bytes <= max_bytes


def named(df: DataFrame, accounts: Sequence[str], key: str = "acc_no") -> DataFrame:
    """The rows of named keys: a filter that reaches the scan, or for many names a semi-join.

    A plan repeats a filter's values in every scan, so over ``MAX_LITERALS`` names become a
    relation, which is broadcast: the caller held them all in memory anyway.
    """
    if len(accounts) <= MAX_LITERALS:
        return df.where(F.col(key).isin(list(accounts)))
    names = df.sparkSession.createDataFrame([(a,) for a in accounts], f"_named {dict(df.dtypes)[key]}")
    return df.join(F.broadcast(names), F.col(key) == F.col("_named"), "left_semi")


def driver_list(
    df: DataFrame, columns: Sequence[str], accounts: Sequence[str] | None = None, key: str = "acc_no"
) -> DataFrame:
    """The list's columns, optionally narrowed to named keys."""
    return (df if accounts is None else named(df, accounts, key)).select(*columns)


@dataclass(frozen=True)
class Scope:
    """A driver list, the key in use, whether the list is short enough to broadcast, and else the
    words of a Bloom filter of its keys, 0 for none."""

    rows: DataFrame
    key: str
    small: bool
    words: int = 0

    @classmethod
    def of(
        cls,
        rows: DataFrame,
        key: str = "acc_no",
        max_keys: int = MAX_BROADCAST_KEYS,
        covers_most: bool = False,
        max_filter_keys: int | None = None,
        measured: Measure | None = None,
    ) -> Scope:
        """Measures the list, unless ``measured`` is given. ``covers_most`` is the caller's hint that the
        list names most keys of the facts: a filter would drop little then, so the list is planned
        as a long one, unmeasured. A list of up to ``max_filter_keys`` rows, by default
        ``FILTER_FACTOR`` times ``max_keys``, gets a Bloom filter if it is too long to broadcast."""
        if covers_most:
            return cls(rows, key, False)
        size = measured or measure({"": (rows, ())})[""]
        if fits(rows, max_keys, measured=size):
            return cls(rows, key, True)
        most = FILTER_FACTOR * max_keys if max_filter_keys is None else max_filter_keys
        return cls(rows, key, False, words_for(size.rows) if size.rows <= most else 0)

    def by(self, key: str) -> Scope:
        """The same list through another of its key columns."""
        return Scope(self.rows, key, self.small, self.words)

    @cached_property
    def _filter(self) -> DataFrame:
        return key_filter(self.rows, self.key, self.words)

    def restrict(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """Rows of ``df`` whose key is in the list."""
        keys = self.rows.select(F.col(self.key).alias("_scope_key")).where("_scope_key IS NOT NULL")
        keys = F.broadcast(keys) if self.small else keys
        return df.join(keys, df[key or self.key] == keys["_scope_key"], "left_semi")

    def prefilter(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """``restrict`` when that saves a shuffle; else what the filter lets pass, or at least no NULL key.

        For inputs that are reduced per key and then joined to the list, where the join
        discards foreign keys anyway. A NULL key can never match, and it must not become
        the one overfull shuffle partition.
        """
        key = key or self.key
        if self.small:
            return self.restrict(df, key)
        known = df.where(F.col(key).isNotNull())
        kind = dict(df.dtypes)[key]
        if self.words and kind == dict(self.rows.dtypes)[self.key] and filterable(kind):
            return may_hold(known, key, self._filter, self.words)
        return known

    def reduce(
        self, df: DataFrame, reducer: Callable[[DataFrame], DataFrame], key: str | None = None
    ) -> DataFrame:
        """``reducer`` (a per-key reduction) over exactly the listed keys, in the cheaper order."""
        if self.small:
            return reducer(self.restrict(df, key))
        return self.restrict(reducer(self.prefilter(df, key)), key)
