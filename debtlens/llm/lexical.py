"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

1. Index. Every document goes into a block of at most ``DOCS`` documents, in the task that reads
   it; a block holds each term's list of documents and occurrences. Nothing is shuffled.
2. Pair lists. For a set of queries, each block gets the score parts of the queries' terms, and
   for the ``PAIRED`` terms with the longest lists (over all blocks) the intersections of any
   two: which documents hold both, as a bitmap, and their joint maximum impact.
3. Search, block by block. A term's maximum impact bounds what it adds; of two paired terms no
   document gets more than the larger of both maxima and the joint maximum. Disjoint pairs are
   chosen greedily by what they save, and terms are ordered by their maxima: the bound of the
   first k terms is the sum of their maxima less the savings of pairs among them. Documents with
   only terms whose bound is below the threshold are never looked at. Those whose last term in the
   order is a paired one come from intersections instead of its whole list if they need one
   of its partners to reach the threshold. Scores are then completed from the last term to the
   first, and documents leave as soon as score and remaining bound fall short.
4. The best of every block meet in one ranking per query.

The threshold of a query starts as the last of the best scores of a part of the blocks (one in
``SEEDS``), which are scores of documents of the table: this and the choice of pairs decide run time only.

Queries pass in sets of at most ``SET_BYTES`` of text, so that what tasks get does not grow with
the number of queries. Terms are compared as 64-bit hashes.

Defined results. Null and empty texts have no terms; such documents count nowhere, such queries
find nothing. Every row is a document or a query of its own, so repeated and null ids are ranked
like others, null doc_ids after all others of an equal score. A query with fewer documents above 0
returns them all; an empty table on either side gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from debtlens.llm import runs
from debtlens.llm import words as W
from debtlens.llm.scratch import BATCH_ROWS, stored
from debtlens.llm.ship import ship

#: Documents and bytes of text in a block: places fit 16 bits, a block some tens of MB.
DOCS, BLOCK_BYTES = 8192, 1 << 25
#: Terms with pair lists.
PAIRED = 64
#: Text of the queries that are searched together.
SET_BYTES = 1 << 22
SEEDS = 16
TOP = 10
#: Blocks that a Python worker holds at once.
ROWS = 4

INDEX = "ids array<bigint>, lengths binary, terms binary, starts binary, docs binary, tfs binary, n_docs long, n_terms long"
LISTS = "ids array<bigint>, terms binary, starts binary, docs binary, parts binary, paired binary, joint binary, bitmaps binary"
FOUND = "item int, doc_id long, score long"


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every term, and where each text's terms start (one more for the end)."""
    data, offsets = W.buffers(texts)
    starts, ends, first = runs.found(runs.TERM[data], offsets)
    return W.hashes(data, starts, ends, W.LOWER), first


class _Block:
    def __init__(self):
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.docs = self.bytes = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        hashes, first = term_hashes(texts)
        lengths = np.diff(first)
        doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        cuts = np.flatnonzero(new)
        tfs = np.diff(cuts, append=len(doc)).astype(np.int32)
        self.parts.append((hashes[cuts], (doc[cuts] + self.docs).astype(np.uint16), tfs))
        self.ids.append(ids)
        self.lengths.append(lengths.astype(np.int32))
        self.docs += len(texts)
        self.bytes += len(W.buffers(texts)[0])

    def row(self) -> pa.RecordBatch:
        hashes, docs, tfs = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(hashes, kind="stable")
        terms, starts = np.unique(hashes[order], return_index=True)
        lengths = np.concatenate(self.lengths)
        ids = pa.concat_arrays([x.cast(pa.int64()) for x in self.ids])
        row = [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *(
                pa.array([x.tobytes()], pa.binary())
                for x in (lengths, terms, np.append(starts, len(order)).astype(np.int32), docs[order], tfs[order])
            ),
            pa.array([int((lengths > 0).sum())]),
            pa.array([int(lengths.sum(dtype=np.int64))]),
        ]
        return pa.RecordBatch.from_arrays(row, names=["ids", "lengths", "terms", "starts", "docs", "tfs", "n_docs", "n_terms"])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block()
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for a, b in W.slices(texts):
            for low in range(a, b, DOCS):
                high = min(b, low + DOCS)
                if block.docs and (block.docs + high - low > DOCS or block.bytes > BLOCK_BYTES):
                    yield block.row()
                    block = _Block()
                block.add(ids.slice(low, high - low), texts.slice(low, high - low))
    if block.docs:
        yield block.row()
    W.trim()


def _held(row: dict, **kinds) -> list[np.ndarray]:
    return [np.frombuffer(row[name], kind) for name, kind in kinds.items()]


def _kept(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, with few rows in a batch: each is a whole block."""
    spark = df.sparkSession
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(ROWS))
    try:
        return stored(df, name)
    finally:
        spark.conf.set(BATCH_ROWS, before)


def index(docs: DataFrame) -> DataFrame:
    """A row per block of documents (doc_id, text)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(rows.mapInArrow(_indexed, INDEX), "lexical_index")


@dataclass(frozen=True)
class Queries:
    """A set of queries: sorted distinct terms, their weights, each query's places among them, and
    the places of terms with pair lists."""

    terms: np.ndarray
    weights: np.ndarray
    items: list[np.ndarray]
    paired: np.ndarray


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() if name == "ids" else batch.column(name)[k].as_buffer() if pa.types.is_binary(batch.column(name).type) else None for name in batch.schema.names}


def _places(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``terms`` of those ``wanted`` that it holds, and which of ``wanted`` they are."""
    if not len(terms):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    has = np.flatnonzero(terms[at] == wanted)
    return at[has], has


def _counter(wanted: np.ndarray) -> Callable:
    """(place in ``wanted``, documents of a block that hold the term)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            terms, starts = _held(row, terms=np.uint64, starts=np.int32)
            at, has = _places(terms, wanted)
            yield pa.RecordBatch.from_arrays([pa.array(has), pa.array((starts[at + 1] - starts[at]).astype(np.int64))], names=["term", "df"])

    return counted


def prepared(blocks: DataFrame, texts: list[str | None], paired: int = PAIRED) -> tuple[Queries, int, int]:
    """The queries with their weights, the number of documents with a term and of all terms."""
    hashes, first = term_hashes(pa.array(texts, pa.large_string()))
    terms, back = np.unique(hashes, return_inverse=True)
    items = [np.unique(back[a:b]) for a, b in zip(first, first[1:])]
    n, total = (int(x or 0) for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    lists = blocks.select("terms", "starts").mapInArrow(_counter(terms), "term long, df long")
    # One row per term of the set at most.
    df = np.zeros(len(terms), np.int64)
    for term, count in lists.groupBy("term").agg(F.sum("df")).collect():
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    longest = np.sort(np.argsort(-df, kind="stable")[:paired])
    return Queries(terms, weights, items, longest[(df[longest] > 1) & (weights[longest] > 0)]), n, total


def _lister(queries: Queries, n: int, total: int) -> Callable:
    """Each block's lists of the queries' terms, with score parts, and its pair lists."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths, terms, starts, docs, tfs = _held(
                row, lengths=np.int32, terms=np.uint64, starts=np.int32, docs=np.uint16, tfs=np.int32
            )
            at, has = _places(terms, queries.terms)
            low, size = starts[at].astype(np.int64), np.diff(starts)[at].astype(np.int64)
            ends = np.cumsum(size)
            pick = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)
            own, tf = docs[pick], tfs[pick].astype(np.int64)
            m = 10 + (90 * lengths.astype(np.int64) * n) // max(total, 1)
            parts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[own])
            cuts = np.concatenate([[0], ends]).astype(np.int64)
            paired, joint, bitmaps = _pair_lists(queries, has, cuts, own, parts, len(lengths))
            arrays = (has.astype(np.int32), cuts, own, parts.astype(np.int32), paired.astype(np.int32), joint, bitmaps)
            ids = pa.ListArray.from_arrays(pa.array([0, len(row["ids"])], pa.int32()), pa.array(row["ids"], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([x.tobytes()], pa.binary()) for x in arrays)],
                names=["ids", "terms", "starts", "docs", "parts", "paired", "joint", "bitmaps"],
            )
        W.trim()

    return listed


def _pair_lists(queries: Queries, has, cuts, docs, parts, size: int):
    """The paired terms that the block holds, and of any two the joint maximum and the bitmap."""
    at, _ = _places(has, queries.paired)
    k = len(at)
    joint = np.zeros((k, k), np.int64)
    impacts = np.zeros((k, size), np.int64)
    for i, x in enumerate(at):
        impacts[i, docs[cuts[x] : cuts[x + 1]]] = queries.weights[has[x]] * parts[cuts[x] : cuts[x + 1]]
    held = np.packbits(impacts > 0, axis=1)
    bitmaps = held[:, None, :] & held[None, :, :]
    for i in range(k):
        both = (impacts[i] > 0) & (impacts[i + 1 :] > 0)
        joint[i, i + 1 :] = joint[i + 1 :, i] = np.where(both, impacts[i] + impacts[i + 1 :], 0).max(axis=1, initial=0)
    return has[at], joint, bitmaps


class Lists:
    """One block's lists, and the search in them."""

    def __init__(self, row: dict, weights: np.ndarray):
        self.ids = row["ids"]
        self.terms, self.starts, self.docs, self.parts, paired, joint, bitmaps = _held(
            row, terms=np.int32, starts=np.int64, docs=np.uint16, parts=np.int32, paired=np.int32, joint=np.int64, bitmaps=np.uint8
        )
        k = len(paired)
        self.pair = {int(t): i for i, t in enumerate(paired)}
        self.joint, self.bitmaps = joint.reshape(k, k), bitmaps.reshape(k, k, -1) if k else bitmaps
        self.weights = weights
        most = np.maximum.reduceat(self.parts, self.starts[:-1]) if len(self.terms) else self.parts
        self.most = weights[self.terms] * most.astype(np.int64)
        # Equal scores are ranked by id, ids that are null last.
        known = [(i is None, i or 0) for i in self.ids]
        self.order = np.empty(len(known), np.int64)
        self.order[sorted(range(len(known)), key=known.__getitem__)] = np.arange(len(known))
        self.looked_at = 0

    def _list(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.starts[at], self.starts[at + 1]
        return self.docs[low:high], self.weights[self.terms[at]] * self.parts[low:high].astype(np.int64)

    def _saved(self, terms: list[int], most: list[int]) -> list[int]:
        """By place in the order: what the pair that ends there takes off the sum of maxima."""
        held = [(p, self.pair[t]) for p, t in enumerate(terms) if t in self.pair]
        pairs = []
        for x, (p, i) in enumerate(held):
            for q, j in held[x + 1 :]:
                least = min(most[p], most[q], most[p] + most[q] - int(self.joint[i, j]))
                if least > 0:
                    pairs.append((-least, p, q))
        saved, used = [0] * len(terms), set()
        for least, p, q in sorted(pairs):
            if p not in used and q not in used:
                used |= {p, q}
                saved[q] = -least
        return saved

    def best(self, item: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the block's best documents for a query's terms, of ``least`` or more."""
        at, _ = _places(self.terms, item)
        at = at[self.most[at] > 0]
        at = at[np.argsort(self.most[at], kind="stable")]
        most, terms = self.most[at].tolist(), self.terms[at].tolist()
        saved = self._saved(terms, most)
        bound = [0]  # of the first k terms
        for m, s in zip(most, saved):
            bound.append(bound[-1] + m - s)
        least = max(least, 1)
        skipped = int(np.searchsorted(bound, least)) - 1  # the last k with bound[k] < least
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if skipped >= len(at):
            return none
        looked = np.zeros(len(self.ids), bool)
        for p in range(skipped, len(at)):
            needed = self._partners(p, terms, most, least)
            if needed is None:
                looked[self._list(at[p])[0]] = True
            else:
                i = self.pair[terms[p]]
                union = np.bitwise_or.reduce(self.bitmaps[i, needed], axis=0)
                looked |= np.unpackbits(union, count=len(looked)).view(bool)
        docs = np.flatnonzero(looked)
        self.looked_at += len(docs)
        scores = np.zeros(len(docs), np.int64)
        for p in range(len(at) - 1, -1, -1):
            own, impacts = self._list(at[p])
            if len(docs) * 16 < len(own):
                place = np.minimum(np.searchsorted(own, docs), len(own) - 1)
                scores += np.where(own[place] == docs, impacts[place], 0)
            else:
                dense = np.zeros(len(self.ids), np.int64)
                dense[own] = impacts
                scores += dense[docs]
            if p <= skipped or p % 8 == 0:
                if p == skipped and len(scores) >= top:
                    least = max(least, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
                stays = scores + bound[p] >= least
                docs, scores = docs[stays], scores[stays]
                if not len(docs):
                    return none
        first = np.lexsort((self.order[docs], -scores))[:top]
        return docs[first], scores[first]

    def _partners(self, p: int, terms: list[int], most: list[int], least: int) -> list[int] | None:
        """Pair numbers of earlier terms one of which a document needs to reach ``least`` if the term
        at ``p`` is its last; None if it may do without, so that its whole list is read."""
        if terms[p] not in self.pair:
            return None
        rest, needed = sum(most[: p + 1]), []
        for q in range(p - 1, -1, -1):
            if rest < least:
                break
            if terms[q] in self.pair:
                rest -= most[q]
                needed.append(self.pair[terms[q]])
        return needed if rest < least and needed else None


def _searcher(queries: Queries, least: np.ndarray, top: int) -> Callable:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Lists(row, queries.weights)
            items, docs, scores = [], [], []
            for i, item in enumerate(queries.items):
                found, score = block.best(item, int(least[i]), top)
                items.append(np.full(len(found), i, np.int32))
                docs.append(found)
                scores.append(score)
            ids = pa.array(block.ids, pa.int64()).take(pa.array(np.concatenate(docs)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(items)), ids, pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"]
            )
        W.trim()

    return searched


def _sets(items: DataFrame, most: int) -> Iterator[list]:
    """Rows of ``items`` (item_id, text) in sets of about ``most`` characters, one after another."""
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append(row)
        size += len(row[1] or "") + 16
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(blocks: DataFrame, texts: list[str | None], top: int = TOP, paired: int = PAIRED) -> DataFrame:
    """(item, rank, doc_id, score): for each text, by its place, the best documents of an index."""
    queries, n, total = prepared(blocks, texts, paired)
    lists = _kept(blocks.mapInArrow(_lister(queries, n, total), LISTS), "lexical_lists")
    least = np.zeros(len(texts), np.int64)
    part = lists.where(F.pmod(F.xxhash64("ids"), F.lit(SEEDS)) == 0)
    seeds = _kept(part.mapInArrow(_searcher(queries, least, top), FOUND), "lexical_seeds")
    # At most one row per query.
    for item, score in _ranked(seeds, top).where(F.col("rank") == top).select("item", "score").collect():
        least[item] = score
    found = _kept(lists.mapInArrow(_searcher(queries, least, top), FOUND), "lexical_found")
    return _ranked(found, top).select("item", "rank", "doc_id", "score")


def report(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the best ``top`` documents of every item."""
    spark: SparkSession = docs.sparkSession
    blocks = index(docs)
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    out = None
    for held in _sets(items.select("item_id", "text"), SET_BYTES):
        found = search(blocks, [row[1] for row in held], top)
        names = spark.createDataFrame([(i, row[0]) for i, row in enumerate(held)], f"item int, item_id {kind}")
        # A row per query of the set.
        one = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = one if out is None else out.union(one)
    return spark.createDataFrame([], schema) if out is None else out
