"""Token ids as canonical length-limited Huffman codes in independent blocks.

Writing (:func:`write`):

1. texts are tokenised where they are read, and their ids written there; every task leaves the
   counts of its ids as one more row, so nothing is read again to count them;
2. package-merge on the sums of these gives the code lengths that are best among those of at most
   ``LIMIT`` bits; a canonical code needs nothing but these lengths;
3. each document is coded on its own, with the bit offset of every ``STEP``-th id, and only codes
   are shuffled: to tasks by ranges of ``doc_id``, sorted there, and put together to blocks of
   whole documents with about ``BLOCK`` ids. A document's code begins at a byte.

Format: a folder with two Parquet tables. ``codes``: id, bits. ``blocks``: part and block (their
order is that of the documents), start (ids before the block), doc_ids, sizes (ids per document),
offsets (bits of the block before each ``STEP`` ids of each document, unsigned 64-bit
little-endian), payload (codes, most significant bit first).

Reading (:func:`read`) decodes all steps of some blocks side by side: one table lookup on the next
``LIMIT`` bits gives each step's next id and the length of its code.

Defined results. Null and empty texts are one id, the end id. Documents are in ascending order
of ``doc_id``, null first; rows with equal ``doc_id`` in order of their sizes and check sums,
rows equal in those being equal. All rows of one ``doc_id`` go to one part: ids name documents, and a
table in which one id has a share of all rows is not what this format is for. An empty table
is two empty tables. Only id and text are read. Ids are held in 16 bits, so a tokenizer with more
is refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debtlens.llm import tokens as T
from debtlens.llm import words as W
from debtlens.llm.scratch import partitions, place, small_batches, stored
from debtlens.llm.ship import ship

END = 1
#: Ids in a block: its row stays far below the sizes that a JVM's heap keeps apart.
BLOCK = 1 << 15
#: Blocks that are decoded side by side.
TOGETHER = 32
STEP = 128
LIMIT = 18

# --- the code ---------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each symbol's code, 0 for symbols that don't occur: package-merge.

    Each of ``limit`` levels merges the symbols with pairs of the level below; the cheapest
    2n - 2 entries of the top level say, level by level, how many of the rarest symbols get
    one bit more.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit codes of {limit} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.float64)
    levels, merged = [], weights
    symbol = np.ones(n, bool)
    levels.append(symbol)
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        every = np.concatenate([weights, pairs])
        rank = np.argsort(every, kind="stable")
        merged = every[rank]
        levels.append(rank < n)
    take = 2 * n - 2
    ranked = np.zeros(n, np.int64)
    for symbol in reversed(levels):
        leaves = int(symbol[:take].sum())
        ranked[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = ranked
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: shorter ones first, equally long ones in order of their ids."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        bits = lengths[order].astype(np.int64)
        # Counted in units of the longest code, each code starts where the one before ends.
        widths = 1 << (int(bits[-1]) - bits)
        codes[order] = (np.cumsum(widths) - widths) >> (int(bits[-1]) - bits)
    return codes


def lookup(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """For every ``limit`` next bits: id * 32 + bits of its code."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    bits = lengths[order].astype(np.int64)
    table = np.repeat(order * 32 + bits, 1 << (limit - bits))
    return np.concatenate([table, np.full((1 << limit) - len(table), 1)]).astype(np.uint32)


def pack(ids: np.ndarray, first: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """The codes of some documents, whose ids start at ``first`` (one more for the end).

    Bit offsets of every ``STEP``-th id within its document, where each document's offsets start
    and where its bytes start, and the bytes.
    """
    sizes = np.diff(first)
    bits = lengths[ids].astype(np.int64)
    before = np.concatenate([[0], np.cumsum(bits)])
    held = np.concatenate([[0], np.cumsum(-(-(before[first[1:]] - before[first[:-1]]) // 8))])
    at = before[:-1] + np.repeat(8 * held[:-1] - before[first[:-1]], sizes)
    word, shift = at >> 5, (at & 31).astype(np.uint64)
    wide = codes[ids].astype(np.uint64) << (np.uint64(64) - bits.astype(np.uint64) - shift)
    out = np.zeros(int(held[-1]) // 4 + 2, np.uint64)
    # Codes share no bits, so those that begin in one 32-bit word are added up.
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[heads]] += np.add.reduceat(wide >> np.uint64(32), heads)
    out[word[heads] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), heads)
    steps = np.concatenate([[0], np.cumsum(-(-sizes // STEP))])
    own = np.repeat(np.arange(len(sizes)), np.diff(steps))
    offsets = at[first[own] + STEP * (np.arange(steps[-1]) - steps[own])] - 8 * held[own]
    return offsets, steps, held, out.astype(">u4").tobytes()


def unpack(sizes: np.ndarray, offsets: np.ndarray, payload: bytes, table: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The ids of documents of so many ids, one after another; ``offsets`` are bits of ``payload``.

    All steps advance together, one id at a time; those with fewer ids fall out.
    """
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    windows = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    steps = -(-sizes // STEP)
    counts = np.full(len(offsets), STEP)
    counts[np.cumsum(steps) - 1] = sizes - STEP * (steps - 1)
    order = np.argsort(-counts, kind="stable")
    at = offsets[order].astype(np.int64)
    active = np.searchsorted(-counts[order], -np.arange(STEP), "left")  # lanes with more than k ids
    out = np.empty((len(offsets), STEP), np.uint16)
    drop = np.uint32(32 - limit)
    for k in range(int(counts.max(initial=0))):
        at = at[: active[k]]
        found = table[(windows[at >> 3] << (at & 7).astype(np.uint32)) >> drop]
        out[order[: active[k]], k] = found >> np.uint32(5)
        at = at + (found & np.uint32(31))
    return out[np.arange(STEP) < counts[:, None]]


# --- writing ----------------------------------------------------------------------------

TOKENS = "part int, doc_id long, n long, check long, ids binary"
#: The part of a row that holds a task's counts.
COUNTS = -1


def _tokenise(bounds: list[int], end: int, name: str):
    """The ids of every document, and at the end one row with the counts of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        names = ["part", "doc_id", "n", "check", "ids"]
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.slices(texts):
                doc_ids = batch.column("doc_id").slice(a, b - a)
                ids, first = T.ended(texts.slice(a, b - a), end, name)
                counts += np.bincount(ids, minlength=1 << 16)
                held = ids.astype("<u2").tobytes()
                docs = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((2 * first).astype(np.int32)), pa.py_buffer(held)])
                part = np.searchsorted(bounds, doc_ids.fill_null(-(1 << 63)).to_numpy(), "right")
                view = memoryview(held)
                check = [zlib.crc32(view[2 * x : 2 * y]) for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
                columns = [pa.array(part.astype(np.int32)), doc_ids, pa.array(np.diff(first).astype(np.int64)), pa.array(check, pa.int64()), docs]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        used = np.flatnonzero(counts)
        row = [COUNTS, None, len(used), None, np.concatenate([used, counts[used]]).astype("<i8").tobytes()]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)], names=names)
        W.trim()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of some tasks, added up."""
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for row in batch.column("ids"):
            used, n = np.frombuffer(row.as_buffer(), "<i8").reshape(2, -1)
            counts[used] += n
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["id", "n"])


CODED = "part int, doc_id long, n long, check long, offsets binary, payload binary"


def _code(lengths: bytes):
    """The code of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(lengths, np.uint8)
        codes = canonical(bits)
        for batch in batches:
            for a, b in W.slices(batch.column("ids")):
                rows = batch.slice(a, b - a)
                data, first = W.buffers(rows.column("ids"))
                offsets, steps, held, payload = pack(np.frombuffer(data, "<u2"), first // 2, codes, bits)
                at = offsets.astype("<u4")
                docs = [
                    pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(bytes_of)])
                    for ends, bytes_of in ((4 * steps, at.tobytes()), (held, payload))
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("part", "doc_id", "n", "check")), *docs],
                    names=["part", "doc_id", "n", "check", "offsets", "payload"],
                )
        W.trim()

    return run


BLOCKS = "part int, block long, start long, doc_ids array<long>, sizes array<long>, offsets binary, payload binary"
_BLOCKS = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("sizes", pa.list_(pa.int64())), ("offsets", pa.binary()), ("payload", pa.binary())]
)


def _blocks(size: int, before: dict[int, int]):
    """Sorted documents of one part put together to blocks; ``before`` has the ids before each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start = None, 0, 0
        docs: list[int | None] = []
        sizes: list[int] = []
        offsets: list[np.ndarray] = []
        payload: list[bytes] = []
        ids = held = 0  # of the block so far

        def block() -> pa.RecordBatch:
            row = {"part": part, "block": number, "start": start, "doc_ids": docs, "sizes": sizes}
            row |= {"offsets": np.concatenate(offsets).astype("<u8").tobytes(), "payload": b"".join(payload)}
            return pa.RecordBatch.from_pylist([row], _BLOCKS)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "offsets", "payload"))
            for own, doc_id, n, at, code in zip(*columns):
                if docs and (own != part or ids + n > size):
                    yield block()
                    number, start = number + 1, start + ids
                    docs, sizes, offsets, payload, ids, held = [], [], [], [], 0, 0
                if own != part:
                    part, number, start = own, 0, before[own]
                docs.append(doc_id)
                sizes.append(n)
                offsets.append(np.frombuffer(at, "<u4").astype(np.int64) + 8 * held)
                payload.append(code)
                ids, held = ids + n, held + len(code)
        if docs:
            yield block()
        W.trim()

    return run


def write(docs: DataFrame, path: str, end: int = END, tokenizer: str = T.WORD_BPE) -> None:
    """Tokenise ``docs`` (doc_id, text) and write their ids below ``path``."""
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shares = [k / parts for k in range(1, parts)]
    bounds = sorted({int(x) for x in texts.select("doc_id").approxQuantile("doc_id", shares, 0.1 / parts)}) if shares else []
    tokens = stored(texts.mapInArrow(_tokenise(bounds, end, tokenizer), TOKENS), "huffman_ids")
    rows = tokens.where(F.col("part") != COUNTS)
    # At most 65536 ids, and one total for each of the parts.
    counts = np.zeros(1 << 16, np.int64)
    counted = tokens.where(F.col("part") == COUNTS).select("ids").mapInArrow(_count, "id int, n long")
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    before, total = {}, 0
    for part, n in sorted(tuple(r) for r in rows.groupBy("part").agg(F.sum("n")).collect()):
        before[part], total = total, total + n
    with small_batches(spark):
        coded = rows.mapInArrow(_code(lengths.tobytes()), CODED)
        ordered = coded.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "n", "check", "payload")
        blocks = ordered.mapInArrow(_blocks(BLOCK, before), BLOCKS)
        blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    used = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(used, "id int, bits int").coalesce(1).write.parquet(f"{path}/codes")


# --- reading ----------------------------------------------------------------------------


def _decode(lengths: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(low, TOGETHER)
                payloads = rows.column("payload").to_pylist()
                ends = np.cumsum([0, *map(len, payloads)])
                offsets = [np.frombuffer(x.as_buffer(), "<u8").astype(np.int64) for x in rows.column("offsets")]
                sizes = rows.column("sizes").flatten().to_numpy()
                ids = unpack(sizes, np.concatenate([x + 8 * e for x, e in zip(offsets, ends)]), b"".join(payloads), table)
                first = np.concatenate([[0], np.cumsum(sizes)])
                docs = rows.column("sizes").value_lengths().to_numpy()
                head = np.cumsum(docs) - docs  # each block's first document
                start = first[:-1] + np.repeat(rows.column("start").to_numpy() - first[head], docs)
                held = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(4 * first.astype(np.int64)), pa.py_buffer(ids.astype("<u4").tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_ids").flatten(), pa.array(start), pa.array(sizes), held.cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (unsigned 32-bit little-endian) of every document written."""
    ship(spark)
    lengths = np.zeros(1 << 16, np.uint8)
    for row in spark.read.parquet(f"{path}/codes").collect():  # at most 65536 rows
        lengths[row["id"]] = row["bits"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInArrow(_decode(lengths.tobytes()), "doc_id long, start long, n_tokens long, ids binary")


def report(docs: DataFrame, end: int = END, tokenizer: str = T.WORD_BPE) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files."""
    spark = docs.sparkSession
    path = place(spark, "huffman")
    write(docs, path, end, tokenizer)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
