"""What has to be known of relations before a plan is chosen, measured in one job.

Rows, text bytes and frequent keys of any number of relations come from one action: each relation
is aggregated to one row, in which ``approx_top_k`` sketches every key asked for. A sketch has a fixed
size, is filled on the map side and merged, so nothing is shuffled but one sketch per task. A value
that it can't rule out as frequent is a candidate; candidates are then counted exactly, by a second
action that looks at rows of candidates only and is left out where there are none.

The sketch tracks ``TRACKED`` times as many values as can be frequent. Its counts are never too low and
too high by at most 0.27 / one_in of the rows, so that every frequent value is among its first
``2 * one_in``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.functions.scalars import add0, any_of

# A key is frequent if it holds over 1/HOT_KEYS of the rows. Fewer than HOT_KEYS keys can, so
# they are safe to broadcast, and a single task can take the rows of any other key.
HOT_KEYS = 1000
TRACKED = 10

Found = list[tuple[object, int]]


@dataclass(frozen=True)
class Measure:
    """Of one relation: its rows, the bytes of its texts, and by key the values that hold over
    ``1/one_in`` of the rows (NULL included, as text) with their rows."""

    rows: int
    text_bytes: int
    frequent: dict[str, Found]

    def over(self, one_in: int) -> Measure:
        """The same, with the values that hold over ``1/one_in`` of the rows, a larger share than measured."""
        kept = {k: [(v, n) for v, n in found if n * one_in > self.rows] for k, found in self.frequent.items()}
        return replace(self, frequent=kept)


def _summary(name: str, df: DataFrame, keys: Sequence[str], one_in: int) -> DataFrame:
    texts = [c for c, kind in df.dtypes if kind == "string"]
    size = F.sum(add0(F.lit(0), *(F.octet_length(f"`{c}`") for c in texts)))
    sketches = [
        F.expr(f"approx_top_k(CAST(`{k}` AS STRING), {2 * one_in}, {TRACKED * one_in})") for k in keys
    ]
    none = F.array().cast("array<array<struct<item:string,count:bigint>>>")
    held = F.array(*sketches).cast("array<array<struct<item:string,count:bigint>>>") if keys else none
    return df.agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.coalesce(size, F.lit(0)).cast("bigint").alias("bytes"), held.alias("held")
    )


def _recount(name: str, df: DataFrame, keys: Sequence[str], candidates: dict[str, list]) -> DataFrame:
    """Exact counts of the candidates of all keys, in one pass."""
    each = []
    for k in keys:
        value = F.col(f"`{k}`").cast("string")
        known = [v for v in candidates[k] if v is not None]  # few, by the sketch's arithmetic
        wanted = [value.isin(known)] * bool(known) + [value.isNull()] * (None in candidates[k])
        if wanted:
            one = F.struct(F.lit(k).alias("key"), value.alias("value"))
            each.append(F.when(F.coalesce(any_of(*wanted), F.lit(False)), one))
    values = df.select(F.explode(F.array_compact(F.array(*each))).alias("_at"))
    counts = values.groupBy("_at.key", "_at.value").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.lit(name).alias("name"), "key", "value", "n")


def measure(relations: Mapping[str, tuple[DataFrame, Sequence[str]]], one_in: int = HOT_KEYS) -> dict[str, Measure]:
    """A :class:`Measure` of each relation, given by name with the keys to look for frequent values of."""
    union = lambda a, b: a.unionByName(b)
    summaries = reduce(union, (_summary(n, df, keys, one_in) for n, (df, keys) in relations.items()))
    found = {r["name"]: r for r in summaries.collect()}
    candidates = {
        n: {k: [x["item"] for x in held if x["count"] * one_in > found[n]["rows"]] for k, held in zip(keys, found[n]["held"])}
        for n, (_, keys) in relations.items()
    }
    exact: dict[str, dict[str, Found]] = {n: {k: [] for k in keys} for n, (_, keys) in relations.items()}
    recounts = [
        _recount(n, df, keys, candidates[n]) for n, (df, keys) in relations.items() if any(candidates[n].values())
    ]
    if recounts:
        for r in reduce(union, recounts).collect():
            if r["n"] * one_in > found[r["name"]]["rows"]:
                exact[r["name"]][r["key"]].append((r["value"], r["n"]))
    return {n: Measure(found[n]["rows"], found[n]["bytes"], exact[n]) for n in relations}
