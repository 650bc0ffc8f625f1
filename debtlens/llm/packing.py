"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents become pieces of at most ``CAPACITY`` tokens; full pieces are sequences of their own.
The others are dealt by hash to cells of about ``CELL`` pieces, each a packing problem of its
own with the mix of lengths of the whole. A cell has ``ISLANDS`` populations, evolved in
separate tasks:

- an individual is a list of bins; the first is best-fit decreasing, others start perturbed;
- crossover injects whole well-filled bins of one parent into the other, removes the bins that
  hold duplicates of the injected pieces, and best-fits the displaced pieces, longest first;
- mutation empties some ill-filled bins and best-fits their pieces;
- after every epoch each island's elite migrates to the next island of its cell.

The best individual of a cell stands, but for its ill-filled bins: their pieces are dealt to
fewer cells and packed again, until one cell is left. All draws are seeded by cell, island and
epoch, so a task that is run again does the same.

Defined results. Null and empty texts are one token, the end id. Rows are told apart by a row
number stored with them, so null and repeated ids and equal rows are packed like any others.
An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm import tokens as T
from debtlens.llm import words as W
from debtlens.llm.scratch import stored
from debtlens.llm.ship import ship

CAPACITY = 2048
END = 0
CELL = 4096
ISLANDS, POPULATION, CHILDREN, EPOCHS = 2, 4, 5, 2
#: A bin is well filled from this share of the capacity on.
WELL = 0.995

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- pieces -----------------------------------------------------------------------------


def _cut(capacity: int, end: int, name: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids_of_docs = batch.column("text"), batch.column("doc_id")
            for a, b in W.slices(texts):
                ids, first = T.ended(texts.slice(a, b - a), end, name)
                sizes = np.diff(first)
                counts = -(-sizes // capacity)
                doc = np.repeat(np.arange(b - a), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                held = memoryview(ids).cast("B")
                at = (first[doc] + start) * 4
                sums = [zlib.crc32(held[x : x + n]) for x, n in zip(at.tolist(), (length * 4).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of_docs.slice(a, b - a).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        W.trim()

    return cut


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str = T.WORD_BPE) -> DataFrame:
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_cut(capacity, end, tokenizer), PIECES)


# --- packing of one cell ----------------------------------------------------------------


def best_fit(order: list[int], lengths: list[int], bins: list[list[int]], free: list[int], capacity: int) -> None:
    """Put each item into the bin that it leaves with the least room, or into a new one."""
    slots: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has r tokens of room
    for b, room in enumerate(free):
        if room:
            slots.setdefault(room, []).append(b)
            rooms |= 1 << room
    for item in order:
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            held = slots[room]
            b = held.pop()
            if not held:
                rooms ^= 1 << room
            bins[b].append(item)
        else:
            b, room = len(bins), capacity
            bins.append([item])
            free.append(0)
        room -= length
        free[b] = room
        if room:
            slots.setdefault(room, []).append(b)
            rooms |= 1 << room


def fitness(free: list[int], capacity: int) -> float:
    """Few bins first, then full ones among them."""
    return sum((1 - room / capacity) ** 2 for room in free) / max(1, len(free)) - len(free)


class Packer:
    """A population of packings of the same items."""

    def __init__(self, lengths: list[int], capacity: int, seed: int):
        self.lengths, self.capacity, self.random = lengths, capacity, random.Random(seed)
        self.well = int(WELL * capacity)
        self.decreasing = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))

    def start(self, first: bool) -> tuple[list[list[int]], list[int]]:
        noise = 0.0 if first else 0.15
        order = self.decreasing
        if noise:
            key = [n * (1 + noise * self.random.random()) for n in self.lengths]
            order = sorted(order, key=lambda i: -key[i])
        return self.filled(order, [], [])

    def filled(self, order, bins, free):
        best_fit(order, self.lengths, bins, free, self.capacity)
        return bins, free

    def room(self, bins: list[list[int]]) -> list[int]:
        return [self.capacity - sum(map(self.lengths.__getitem__, b)) for b in bins]

    def cross(self, one, other):
        """Half the well-filled bins of ``other`` whole, the rest as in ``one``."""
        bins, free = other
        well = [b for b, room in enumerate(free) if self.capacity - room >= self.well]
        injected = [bins[b] for b in self.random.sample(well, (len(well) + 1) // 2)]
        inside = {i for b in injected for i in b}
        kept, room, displaced = [list(b) for b in injected], self.room(injected), []
        for b, left in zip(*one):
            if inside.isdisjoint(b):
                kept.append(list(b))
                room.append(left)
            else:
                displaced += [i for i in b if i not in inside]
        displaced.sort(key=lambda i: (-self.lengths[i], i))
        return self.filled(displaced, kept, room)

    def mutated(self, bins, free):
        """The worst bins and as many others dissolved and best-fitted."""
        n = max(2, len(bins) // 50)
        worst = sorted(range(len(bins)), key=lambda b: -free[b])[:n]
        gone = {*worst, *self.random.sample(range(len(bins)), min(n, len(bins)))}
        items = sorted((i for b in gone for i in bins[b]), key=lambda i: (-self.lengths[i], i))
        left = [b for b in range(len(bins)) if b not in gone]
        return self.filled(items, [list(bins[b]) for b in left], [free[b] for b in left])

    def evolve(self, population: list, children: int) -> list:
        score = lambda x: fitness(x[1], self.capacity)
        least = -(-sum(self.lengths) // self.capacity)
        population = sorted(population, key=score, reverse=True)
        for _ in range(children):
            if len(population[0][0]) <= least:
                break  # no packing has fewer bins
            one, other = self.random.sample(population, 2) if len(population) > 1 else population * 2
            child = self.mutated(*self.cross(one, other))
            population = sorted([*population, child], key=score, reverse=True)[:POPULATION]
        return population


def _arrays(bins: list[list[int]], n: int) -> list[int]:
    of = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            of[i] = b
    return of


def _bins(of: list[int]) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(max(of, default=-1) + 1)]
    for i, b in enumerate(of):
        bins[b].append(i)
    return bins


ISLAND = "cell long, island int, items array<long>, lengths array<int>, population array<array<int>>"


def _epoch(capacity: int, epoch: int):
    """One epoch of every island: rows in, rows with evolved populations out, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                order = sorted(range(len(row["items"])), key=row["items"].__getitem__)
                if not row["population"]:  # fixes the order of the items, which a shuffle doesn't
                    row["items"] = [row["items"][i] for i in order]
                    row["lengths"] = [row["lengths"][i] for i in order]
                packer = Packer(row["lengths"], capacity, hash((row["cell"], row["island"], epoch)))
                population = [(b, packer.room(b)) for b in map(_bins, row["population"] or [])]
                if not population:
                    population = [packer.start(first=row["island"] == 0 and k == 0) for k in range(POPULATION)]
                population = packer.evolve(population, CHILDREN)
                row["population"] = [_arrays(bins, len(row["items"])) for bins, _ in population]
                yield pa.RecordBatch.from_pylist([row], ISLAND_ARROW)

    return run


ISLAND_ARROW = pa.schema(
    [("cell", pa.int64()), ("island", pa.int32()), ("items", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int32())), ("population", pa.list_(pa.list_(pa.int32())))]
)
PLACED = "item long, sequence_id long, offset long, room int"


def _place(capacity: int):
    """The best individual's bins: each is named by its least item and laid out in item order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                best = np.array(row["best"], np.int64)
                items, lengths = np.array(row["items"], np.int64), np.array(row["lengths"], np.int64)
                order = np.lexsort((items, best))
                new = np.concatenate([[True], np.diff(best[order]) != 0])
                group = np.cumsum(new) - 1
                before = np.cumsum(lengths[order]) - lengths[order]
                sizes = np.bincount(group, lengths[order]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(items[order]),
                        pa.array(items[order][new][group]),
                        pa.array(before - before[new][group]),
                        pa.array((capacity - sizes[group]).astype(np.int32)),
                    ],
                    names=["item", "sequence_id", "offset", "room"],
                )

    return run


# --- packing of all cells ---------------------------------------------------------------


def _packed(items: DataFrame, cells: int, capacity: int, level: int) -> DataFrame:
    """Placements of ``items`` (item, length), packed within ``cells`` cells."""
    dealt = items.withColumn("cell", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(cells)))
    cell = dealt.groupBy("cell").agg(F.collect_list(F.struct("item", F.col("length").cast("int").alias("length"))).alias("all"))
    islands = cell.select(
        "cell",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("all.item").alias("items"),
        F.col("all.length").alias("lengths"),
        F.lit(None).cast("array<array<int>>").alias("population"),
    )
    for epoch in range(EPOCHS):
        # Every island has a task's share of its own: islands are dealt out by their key.
        islands = islands.repartition("cell", "island").mapInArrow(_epoch(capacity, epoch), ISLAND)
        islands = stored(islands, "packing_islands")
        if epoch + 1 < EPOCHS:
            migrants = islands.select(
                "cell",
                F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                F.slice("population", 1, 1).alias("elite"),
            )
            islands = islands.join(migrants, ["cell", "island"]).withColumn(
                "population", F.concat(F.slice("population", 1, POPULATION - 1), "elite")
            ).drop("elite")
    number = F.array_max(F.col("population")[0])
    best = islands.groupBy("cell").agg(F.min(F.struct(number.alias("bins"), "island")).alias("best"))
    chosen = islands.join(best.select("cell", F.col("best.island").alias("island")), ["cell", "island"])
    chosen = chosen.select("items", "lengths", F.col("population")[0].alias("best"))
    return stored(chosen.mapInArrow(_place(capacity), PLACED), "packing_placed")


def pack(items: DataFrame, capacity: int = CAPACITY, cell: int = CELL) -> DataFrame:
    """item, sequence_id, offset for ``items`` (item long and unique, length 1 to capacity)."""
    full = items.where(F.col("length") == capacity).select(
        "item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest, done, level = items.where(F.col("length") < capacity), full, 0
    n = rest.count()
    while n:
        cells = -(-n // cell)
        placed = _packed(rest, cells, capacity, level)
        ill = F.col("room") > capacity - int(WELL * capacity)
        if cells == 1:
            return done.union(placed.select("item", "sequence_id", "offset"))
        done = done.union(placed.where(~ill).select("item", "sequence_id", "offset"))
        rest = stored(rest.join(placed.where(ill).select("item"), "item", "left_semi"), "packing_rest")
        before, n, level = n, rest.count(), level + 1
        if n > before // 2:  # lengths that don't fill bins: once more in the same way gains nothing
            last = placed.where(ill)
            return done.union(last.select("item", "sequence_id", "offset"))
    return done


def packed(docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str = T.WORD_BPE) -> DataFrame:
    """Every piece of ``docs`` with its sequence and its offset there."""
    rows = stored(pieces(docs, capacity, end, tokenizer).withColumn("item", F.monotonically_increasing_id()), "packing_pieces")
    return rows.join(pack(rows.select("item", "length"), capacity), "item").drop("item")
