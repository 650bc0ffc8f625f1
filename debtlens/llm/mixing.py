"""Mixing sources to target weights by temperature.

A source with share p of the tokens gets weight p**a / sum of all p**a. At a = 1 weights are the
shares, at a = 0 all sources weigh the same. ``a`` is found by bisection: the smallest exponent
whose repetition limit holds, or the one whose weights have the target entropy (both fall or
rise with ``a`` alone). The limit is the number of times that the most repeated source is read
when the budget is the least that reads every source whole.

The weights are realised exactly in whole documents: a source of T tokens and weight w owes
``w * budget`` of them. Its documents are dealt by hash to blocks of about ``BLOCK``; an epoch is
a seeded permutation of its blocks, and within each block of its documents. Whole epochs are read
whole; the last one is cut at the first document that reaches what is owed. So with the default
budget no document is left out, and no source is read more than one document over its quota.

Blocks and places are drawn from what a row holds, so the same rows give the same readings however
they are stored and split. Equal rows share their draws and can't be told apart in the result; the
last epoch takes as many of them as fit, counted as one unit with its copies.

Weights and quotas are columns of a table with one row per source; the driver gets four sums of it
and, for a target entropy, a few more per step of the search. With few sources it is broadcast, else
joined with the sources that hold many rows cut in pieces.

All prefix sums run over blocks first, a small table (a source's blocks meet in one task, one row for
some ``BLOCK`` documents), and over units only in the block where a source's quota ends. Tokens are words here, runs of characters other than space and 0x09-0x0D,
and one for the end of the document.

Defined results. A null source is a source of its own. Null, empty and blank texts are one token,
the end. Rows are told apart by a row number stored with them, so null and repeated ids and equal
rows are mixed like any others. An empty table gives an empty result. All columns of the input
are carried in one struct.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debtlens.llm.hot import join_counted
from debtlens.llm.scratch import stored

SPACE = r"[\x20\x09-\x0D]+"
#: Documents in a block, on average.
BLOCK = 4096
#: The most repeated source is read this often, at most.
REPEATS = 1.5
STEPS = 60
#: The table of sources is broadcast up to this many.
FEW_SOURCES = 100_000
#: Exponents tried at once in the search for an entropy.
TRIED = 64


# --- weights ----------------------------------------------------------------------------


def weights(shares: dict, exponent: float) -> dict:
    """Normalised powers of the shares."""
    most = max(shares.values())
    powers = {s: (p / most) ** exponent for s, p in shares.items()}
    total = math.fsum(powers.values())
    return {s: x / total for s, x in powers.items()}


def entropy(of: dict) -> float:
    return -math.fsum(w * math.log(w) for w in of.values() if w > 0)


def repeats(shares: dict, exponent: float) -> float:
    """How often the most repeated source is read when the least repeated is read once."""
    of = weights(shares, exponent)
    ratios = [of[s] / p for s, p in shares.items()]
    return max(ratios) / min(ratios)


def bisect(low: float, high: float, passes) -> float:
    """The least exponent in the range that passes, given that larger ones do."""
    if passes(low):
        return low
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if passes(middle) else (middle, high)
    return high


def exponent_for(shares: dict, most_repeats: float | None = None, target_entropy: float | None = None) -> float:
    if target_entropy is not None:
        # Entropy falls from log(sources) at 0 to that of the shares at 1.
        return bisect(0.0, 1.0, lambda a: entropy(weights(shares, a)) <= target_entropy)
    return bisect(0.0, 1.0, lambda a: repeats(shares, a) <= (most_repeats or 1.0) * (1 + 1e-12))


@dataclass(frozen=True)
class Plan:
    exponent: float
    weights: dict
    #: Tokens owed by every source.
    quotas: dict


def plan(
    totals: dict, most_repeats: float | None = REPEATS, target_entropy: float | None = None, budget: int | None = None
) -> Plan:
    """Weights and quotas for the tokens of every source."""
    every = math.fsum(totals.values())
    shares = {s: n / every for s, n in totals.items()}
    exponent = exponent_for(shares, most_repeats, target_entropy)
    of = weights(shares, exponent)
    if budget is None:
        quotas_for = max(totals[s] / of[s] for s in totals)
        # The source that sets the budget is read exactly once.
        quotas = {s: max(totals[s], round(of[s] * quotas_for)) for s in totals}
    else:
        quotas = {s: round(of[s] * budget) for s in totals}
    return Plan(exponent, of, quotas)


def planned(
    totals: DataFrame, most_repeats: float | None = REPEATS, target_entropy: float | None = None, budget: int | None = None
) -> DataFrame:
    """``totals`` (with one row per source and its ``total``) with the weights and quotas of :func:`plan`."""
    found = totals.agg(F.min("total"), F.max("total"), F.sum(F.col("total").cast("decimal(38,0)"))).first()
    if found[0] is None:
        return totals.withColumn("weight", F.lit(0.0)).withColumn("quota", F.lit(0).cast("long"))
    low, high, every = int(found[0]), int(found[1]), int(found[2])
    if target_entropy is not None:
        exponent = _exponent_for_entropy(totals, high, target_entropy)
    else:
        # The ratio of weight to share falls with the share: least and most repeated are the ends.
        exponent = exponent_for({"low": low / every, "high": high / every} if low < high else {"high": 1.0}, most_repeats)
    power = F.pow(F.col("total") / F.lit(float(high)), F.lit(exponent))
    of = power / F.lit(_exact_sum(totals, [power])[0])
    if budget is None:
        # The largest source is repeated least: read exactly once, it sets the budget.
        quota = F.greatest(F.col("total"), F.rint(power * F.lit(float(high))).cast("long"))
    else:
        quota = F.rint(of * F.lit(float(budget))).cast("long")
    return totals.withColumn("weight", of).withColumn("quota", quota)


def _exact_sum(totals: DataFrame, columns: list) -> list[float]:
    """Sums of numbers of at most 64, the same in whatever order the rows come."""
    exact = [F.sum((c * F.lit(2.0**56)).cast("decimal(20,0)")) for c in columns]
    return [int(x) / 2.0**56 for x in totals.agg(*(x.alias(f"s{i}") for i, x in enumerate(exact))).first()]


def _exponent_for_entropy(totals: DataFrame, high: int, target: float) -> float:
    """The least exponent whose weights have the entropy or less, as :func:`exponent_for`."""
    share = F.col("total") / F.lit(float(high))

    def entropies(exponents: list[float]) -> list[float]:
        powers = [F.pow(share, F.lit(a)) for a in exponents]
        sums = _exact_sum(totals, powers + [-p * F.log(share) for p in powers])
        n = len(exponents)
        # Of weights p**a / z: log(z) - a * sum(p**a * log(p)) / z.
        return [math.log(z) + a * held / z for a, z, held in zip(exponents, sums[:n], sums[n:])]

    at, end = 0.0, 1.0
    if entropies([at])[0] <= target:
        return at
    while True:
        tried = [at + (end - at) * k / TRIED for k in range(1, TRIED)]
        tried = [a for a in tried if at < a < end]
        if not tried:
            return end
        passes = [h <= target for h in entropies(tried)]
        first = passes.index(True) if True in passes else len(tried)
        at, end = ([at] + tried)[first], (tried + [end])[first]


# --- the schedule -----------------------------------------------------------------------


def counted(docs: DataFrame, text: str = "text", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """key, source, tokens and a hash of every row of ``docs``, and the columns ``carry`` as struct ``row``."""
    words = F.size(F.array_remove(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), SPACE), ""))
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry or docs.columns)).alias("row"),
        F.monotonically_increasing_id().alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"),
        (words + 1).cast("long").alias("tokens"),
        F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind)).alias("content"),
    )


def _with_source(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """``rows`` with the columns of their source; ``sources`` has one row each, with the number ``n`` of its rows."""
    if few:
        return rows.join(F.broadcast(sources), rows.source.eqNullSafe(sources.source)).drop(sources.source)
    # Null is a source like others, so it needs a name.
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    side = sources.select(named.alias("named"), *(c for c in sources.columns if c != "source"))
    return join_counted(rows.withColumn("named", named), side, "named", "n", "key").drop("named")


def schedule(rows: DataFrame, sources: DataFrame, few: bool, seed: int = 0) -> DataFrame:
    """key, source, tokens, weight, epoch, place_block and place for every reading of a row of ``rows``.

    ``rows`` has key, source, tokens and content; ``sources`` has source, total, n, weight and quota.
    Readings of one source come in order of epoch, place_block and place.
    """
    per = stored(
        sources.select(
            "source", "n", "weight",
            F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"),
            F.expr("quota div total").alias("whole"),
            F.expr("quota % total").alias("part"),
        ),
        "mixing_plan",
    )
    dealt = _with_source(rows, per, few)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("content", F.lit(seed)), F.col("blocks")))
    columns = ["key", "source", "tokens", "weight", "content", "block", "epoch"]

    # Whole epochs: every document once in each.
    full = dealt.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))

    # The last epoch: blocks in their permuted order, until the quota ends inside one of them.
    blocks = dealt.groupBy("source", "block", "whole", "part").agg(
        F.sum("tokens").alias("held"), F.count(F.lit(1)).alias("many")
    )
    order = [_draw("block", "whole", seed), "block"]
    before = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    # Null is a source like others, so a block needs a name; copies may make one block large.
    named = F.concat("block", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    blocks = stored(blocks.where("before < part").select(named.alias("named"), "many", "before", "held"), "mixing_blocks")
    last = join_counted(dealt.withColumn("named", named), blocks, "named", "many", "key").withColumn("epoch", F.col("whole"))
    inside = last.where("before + held <= part")
    cut = last.where("before + held > part").select(*columns, "named", "part", "before")
    every = full.select(*columns).unionByName(inside.select(*columns)).unionByName(_cut(cut, seed).select(*columns))
    return every.select(
        "key", "source", "tokens", "weight", "epoch",
        _draw("block", "epoch", seed).alias("place_block"),
        _draw("content", "epoch", seed).alias("place"),
    )


def _cut(rows: DataFrame, seed: int) -> DataFrame:
    """The rows that are read of the blocks where quotas end, at most one block per source."""
    unit = F.concat_ws("/", "content", "tokens", "named")
    rows = stored(rows.withColumn("unit", unit), "mixing_cut")
    units = rows.groupBy("unit", "named", "content", "tokens", "epoch", "part", "before").agg(F.count(F.lit(1)).alias("copies"))
    order = [_draw("content", "epoch", seed), "content", "tokens"]
    ahead = Window.partitionBy("named").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("ahead", F.col("before") + F.coalesce(F.sum(F.col("tokens") * F.col("copies")).over(ahead), F.lit(0)))
    # The document that reaches the quota is read as a whole.
    taken = F.least("copies", F.expr("(part - ahead + tokens - 1) div tokens"))
    units = stored(units.where("ahead < part").select("unit", "copies", taken.alias("taken")), "mixing_units")
    found = join_counted(rows, units, "unit", "copies", "key")
    # At most one unit per source is cut. Its copies are numbered by the task that numbered them: first
    # how many each task has, then within each.
    part = found.where("taken < copies").withColumn("task", F.shiftright("key", 33))
    held = part.groupBy("unit", "task").agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("unit").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("unit", "task", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))
    number = F.row_number().over(Window.partitionBy("unit", "task").orderBy("key")) + F.col("earlier")
    part = part.join(held, ["unit", "task"]).withColumn("number", number).where("number <= taken")
    return found.where("taken = copies").unionByName(part.select(*found.columns))


def _draw(name: str, epoch: str, seed: int):
    """Where a block or a document stands in an epoch's permutation."""
    return F.xxhash64(F.lit(name), F.col(name).cast("long"), F.col(epoch).cast("long"), F.lit(seed))


def mixed(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    most_repeats: float | None = REPEATS,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: int = 0,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every reading, in columns of :func:`schedule`, weight, and the struct ``row`` that is read."""
    # Written once: rows are told apart by their number, which a second read might change.
    rows = stored(counted(docs, text, source, carry), "mixing_rows")
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n"))
    totals = stored(totals, "mixing_sources")
    few = totals.count() <= FEW_SOURCES
    sources = planned(totals, most_repeats, target_entropy, budget)
    readings = schedule(rows.select("key", "source", "tokens", "content"), sources, few, seed)
    return readings.join(rows.select("key", "row"), "key")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, weight, epoch, place_block and place of every reading."""
    return mixed(docs, carry=["doc_id"]).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), "weight",
        F.col("epoch").cast("int").alias("epoch"), "place_block", "place",
    )


def rebalanced(docs: DataFrame) -> DataFrame:
    """Every reading as a row with the columns of ``docs``."""
    return mixed(docs).select("row.*")
