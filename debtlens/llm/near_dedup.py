"""Near-duplicate documents by one-permutation MinHash with optimal densification.

1. Each text becomes its set of distinct word shingles, hashed to 64 bits. One permutation (the
   hash itself) deals the shingles to bins, bands times rows of them (see :func:`shape`); a bin
   keeps its least hash. Empty bins copy a full one, found by a fixed random probe sequence per
   bin (optimal densification), so that bins still agree with the probability that is the sets'
   similarity.
2. Texts with equal sets are one node from here on, named by 64 bits of the set's hash. Nodes
   sharing a band share a bucket. The nodes of one ``doc_id`` are linked from the start.
3. Every bucket links its nodes by a star round the node that is most like the others (see
   :func:`debtlens.llm.graph.linked`); every edge is confirmed on the full shingle sets.
4. Buckets that hold several components after that are settled exactly: their nodes meet again
   in buckets of shared rare shingles, in further stars, until no two components of a bucket
   have nodes that could be linked and were not tested.

Texts are linked at a similarity of ``percent`` or more. At 85 there are 32 bands of 6 rows, at 80
there are 38 of 5: a pair at the limit is missed with probability (1 - 0.85^6)^32 or (1 - 0.8^5)^38,
under 3 in 10 million; every other step is exact. Pairs whose set sizes already rule the
similarity out are not tested.

Defined results. Null, empty and blank texts have no shingles and are linked with nothing; texts
of fewer words than a shingle have one, their whole sequence. Rows that share a ``doc_id`` are
one document with several texts: all carry the same component, blank ones too, and stay or go
together. A component has the least ``doc_id`` of its texts. A row without ``doc_id`` has no
name to link: its component is null and it is kept. Empty tables give empty results. Columns
beyond id and text are not read by :func:`report` and carried in one struct by the others.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm import words as W
from debtlens.llm.graph import components as linked_by
from debtlens.llm.graph import linked
from debtlens.llm.hot import join_counted
from debtlens.llm.scratch import stored, tidy
from debtlens.llm.ship import ship

WIDTH = 5
#: Unless the caller says otherwise: 100 * intersection >= PERCENT * union
PERCENT = 85
#: A pair at the limit is missed with this probability, at most.
MISSED = 3e-7

_ODD = np.uint64(0xC2B2AE3D27D4EB4F)


def shape(percent: int) -> tuple[int, int]:
    """Bands and rows that find pairs of a similarity: about a third of a pair's bands agree."""
    share = min(percent, 99) / 100
    rows = max(1, round(math.log(0.35) / math.log(share)))
    return math.ceil(math.log(MISSED) / math.log1p(-(share**rows))), rows


BINS = math.prod(shape(PERCENT))


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per sorted, non-empty set."""
    every = bins
    edges = (np.arange(every, dtype=object) * (1 << 64) // every).astype(np.uint64)
    out = np.empty((len(sets), every), np.uint64)
    full = np.empty((len(sets), every), bool)
    for i, s in enumerate(sets):
        at = np.searchsorted(s, edges)
        full[i] = np.append(at[1:], len(s)) > at
        out[i] = s[np.minimum(at, len(s) - 1)]
    rows, bins = np.nonzero(~full)
    attempt = 0
    while len(rows):
        probe = W.mix(bins.astype(np.uint64) * _ODD + np.uint64(attempt)) % np.uint64(every)
        hit = full[rows, probe.astype(np.int64)]
        out[rows[hit], bins[hit]] = out[rows[hit], probe[hit].astype(np.int64)]
        rows, bins, attempt = rows[~hit], bins[~hit], attempt + 1
    return out


def buckets(signature: np.ndarray, count: int, rows: int) -> np.ndarray:
    """The bucket of each of ``count`` bands, for rows of signatures."""
    bands = signature.reshape(len(signature), count, rows)
    h = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(rows):
        h = W.mix(h * _ODD + bands[:, :, k])
    return h.view(np.int64)


def _sets(texts: pa.Array) -> list[np.ndarray]:
    data, offsets = W.buffers(texts)
    starts, ends, first = W.find(data, offsets)
    named = W.hashes(data, starts, ends, W.LOWER)
    return [W.shingles(named[a:b], WIDTH) for a, b in zip(first[:-1], first[1:])]


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """doc_id, number of shingles, name of the set, buckets; the last two null for empty sets."""
    count, rows = shape(percent)
    for batch in batches:
        texts = batch.column("text")
        for a, b in W.slices(texts):
            sets = _sets(texts.slice(a, b - a))
            some = [s for s in sets if len(s)]
            bands = iter(buckets(signatures(some, count * rows), count, rows).tolist() if some else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "name", "buckets"],
            )
    W.trim()


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and shingle set of every text that has one."""
    for batch in batches:
        texts = batch.column("text")
        for a, b in W.slices(texts):
            sets = _sets(texts.slice(a, b - a))
            some = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int.from_bytes(_key(s)[:8], "big", signed=True) for s in some], pa.int64()),
                    pa.array([s.view(np.int64) for s in some], pa.list_(pa.int64())),
                ],
                names=["node", "shingles"],
            )
    W.trim()


#: The first 64 bits of a set's name.
_NODE = "cast(conv(hex(substring(name, 1, 8)), 16, -10) as long)"


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``, linked at ``percent``."""
    ship(docs.sparkSession)
    plain = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    sketches = stored(
        plain.mapInArrow(partial(_sketch, percent=percent), "doc_id long, n_shingles long, name binary, buckets array<long>"), "near_sketches"
    )
    named = sketches.where("name IS NOT NULL AND doc_id IS NOT NULL").withColumn("node", F.expr(_NODE))
    nodes = stored(
        named.groupBy("name", "node").agg(
            F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")
        ),
        "near_nodes",
    )
    exploded = stored(nodes.select(F.explode("buckets").alias("bucket"), "node", F.col("n").cast("int").alias("n")), "near_members")
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    members = stored(exploded.join(shared, "bucket"), "near_shared")
    # Hubs come first: a node in large buckets is like most of its group.
    ranks = members.groupBy("node").agg((-F.sum("many")).alias("rank"))
    members = members.drop("many").join(ranks, "node")
    # The text of a node is one of its smallest document's; only such documents are read again.
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc_id")).distinct()
    sets = stored(
        plain.join(wanted, "doc_id", "left_semi").mapInArrow(_full, "node long, shingles array<long>").dropDuplicates(["node"]),
        "near_sets",
    )
    tidy(docs.sparkSession)

    def confirmed(edges: DataFrame) -> DataFrame:
        """Edges whose full sets are similar enough; the small set moves to the hub's."""
        left, right = (
            sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in ("a", "b")
        )
        both = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - both
        return edges.join(right, "b").join(left, "a").where(100 * both >= percent * union).select("a", "b")

    near = f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"
    labels, rest = linked(members, near, confirmed, _of_one_document(named.select("doc_id", "node")), rounds=1)
    near = f"{100 + percent} * least(n - place_at, hub_n - hub_place_at) >= {percent} * (n + hub_n)"
    labels, _ = linked(_by_rare_shingles(sets, rest, percent), near, confirmed, labels)
    own = nodes.select("name", "node", "first")
    if labels is None:
        of_name = own.select("name", F.col("first").alias("component_id"))
    else:
        least = labels.join(own, "node").groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
        labels = join_counted(labels, stored(least, "near_least"), "component", "nodes", "node").select("node", "component_id")
        of_name = own.join(labels, "node", "left").select("name", F.coalesce("component_id", "first").alias("component_id"))
    # Many copies share a name, so their rows are counted before they are joined.
    return _named(sketches, of_name).select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _of_one_document(named: DataFrame) -> DataFrame | None:
    """Labels of the nodes of documents with several sets, None if there are none; ``named`` has doc_id and node."""
    ids = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("most"), F.count(F.lit(1)).alias("many"))
    ids = stored(ids.where("a < most").select("doc_id", "a", "many"), "near_documents")
    if ids.isEmpty():
        return None
    return stored(linked_by(join_counted(named, ids, "doc_id", "many", "node").select("a", F.col("node").alias("b"))), "labels")


def _by_rare_shingles(sets: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """The nodes of buckets that stars have not settled, in buckets of their rare shingles.

    With all sets in one order, rare shingles first, two sets that are similar enough share a
    shingle whose places in both leave room for the overlap they need. A row is left out if its
    place leaves too little room even for the smallest set of its bucket. What the copies of a
    passage have in common is frequent, so unlike copies don't meet again here.
    """
    nodes = rest.groupBy("node").agg(F.first("rank").alias("rank"))
    each = sets.join(nodes, "node").select("node", "rank", F.size("shingles").alias("n"), F.explode("shingles").alias("bucket"))
    each = stored(each, "near_rest")
    often = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("many"))
    # A shingle of one set links nothing, but takes its place in the order.
    ordered = each.join(often, "bucket").groupBy("node").agg(
        F.first("rank").alias("rank"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("many", "bucket"))).alias("all")
    )
    heads = F.slice("all", 1, F.floor((100 - percent) * F.col("n") / 100).cast("int") + 1)
    rows = ordered.select("node", "rank", "n", F.posexplode(heads).alias("place_at", "s"))
    rows = rows.where("s.many > 1").select("node", "rank", "n", "place_at", F.col("s.bucket").alias("bucket"))
    rows = stored(rows, "near_heads")
    least = rows.groupBy("bucket").agg(F.min("n").alias("least"))
    room = F.expr(f"{100 + percent} * (n - place_at) >= {percent} * (n + least)")
    return rows.join(least, "bucket").where(room).drop("least")


def _named(sketches: DataFrame, of_name: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; blank texts have their document's."""
    rows = sketches.select("doc_id", "n_shingles", "name")
    some = rows.where("name IS NOT NULL AND doc_id IS NOT NULL")
    side = stored(
        some.groupBy("name").agg(F.count(F.lit(1)).alias("many")).join(of_name, "name"), "near_named"
    )
    found = join_counted(some, side, "name", "many", "doc_id").select("doc_id", "n_shingles", "component_id")
    lone = rows.where("name IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles")
    blank = stored(lone.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("many")), "near_blank")
    nameless = lone.where("doc_id IS NULL").withColumn("component_id", F.lit(None).cast("long"))
    if blank.isEmpty():
        return found.unionByName(nameless)
    of_id = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    of_id = stored(blank.join(of_id, "doc_id", "left"), "near_blank")
    blanks = join_counted(lone.where("doc_id IS NOT NULL").withColumn("at", F.monotonically_increasing_id()), of_id, "doc_id", "many", "at")
    return found.unionByName(blanks.select("doc_id", "n_shingles", "component_id")).unionByName(nameless)


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one per group, with its columns."""
    found = components(docs, doc_id, text, percent)
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "near_gone")
    whole = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return whole.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")
