"""Exact deduplication by an exchange of Golomb-coded fingerprints.

A sender is a block of rows fixed by a bucketed copy of the input (one block per read task, a
bucket holds whole blocks, so nothing but messages moves between senders and owners):

1. each sender sorts the distinct fingerprints of its block, deals them to owners by range and
   sends every owner one Golomb-Rice coded list of differences;
2. each owner decodes its lists and returns to each sender a bitmap: which of its fingerprints
   another sender holds too;
3. each sender turns the bitmaps, and what repeats inside its block, into marks on its rows;
4. only marked rows move: they are grouped by their whole normalised text, which compares bytes.

A fingerprint is the head of the SHA-256 of the normalised text. Texts that share only a
fingerprint are marked, moved and told apart in step 4, so its length changes traffic alone.

Defined results. Null text counts as empty, and all empty texts are one group. Only A-Z are
lower-cased. Of equal texts the largest ``doc_id`` stays, a null one being the smallest; of
rows equal in both, one stays. An empty table gives an empty result. Columns beyond the id and
the text are carried inside one struct, so their names can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm.hot import join_counted
from debtlens.llm.scratch import bucketed, partitions, stored
from debtlens.llm.ship import ship

#: Bits of a fingerprint. With 2**36 texts one in 2**12 is marked without having a copy.
BITS = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- Golomb-Rice lists ------------------------------------------------------------------


def encode(values: np.ndarray, spread: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct numbers below ``spread`` as (k, unary quotients, k-bit remainders)."""
    if not len(values):
        return 0, b"", b""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    # 0.69 of the mean step is the best divisor for geometric steps; Rice codes round it to 2**k.
    k = max(0, int(0.69 * spread / len(values)).bit_length() - 1)
    quotients = (steps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(values), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    places = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rests = ((steps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(rests).tobytes()


def decode(n: int, k: int, unary: bytes, rests: bytes) -> np.ndarray:
    if not n:
        return np.empty(0, np.uint64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    steps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(rests, np.uint8), count=n * k).reshape(n, k)
        places = np.arange(k - 1, -1, -1, dtype=np.uint64)
        steps |= (bits.astype(np.uint64) << places).sum(axis=1, dtype=np.uint64)
    return np.cumsum(steps, dtype=np.uint64)


# --- the two ends of the exchange -------------------------------------------------------


def _prints(table: pa.Table, bits: int) -> np.ndarray:
    digests = table["sha"].combine_chunks().cast(pa.binary(32))
    words = np.frombuffer(digests.buffers()[1], ">u8").reshape(-1, 4)
    heads = words[digests.offset : digests.offset + len(digests), 0]
    return heads.astype(np.uint64) >> np.uint64(64 - bits)


def _owners(prints: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """Owner of each fingerprint: equal ranges of the fingerprint space, by its top 32 bits."""
    top = prints >> np.uint64(bits - 32) if bits > 32 else prints << np.uint64(32 - bits)
    return ((top * np.uint64(owners)) >> np.uint64(32)).astype(np.int64)


def _send(bits: int, owners: int):
    def send(table: pa.Table) -> pa.Table:
        prints = np.unique(_prints(table, bits))
        cuts = np.searchsorted(_owners(prints, owners, bits), np.arange(owners + 1))
        rows = []
        for owner in np.flatnonzero(np.diff(cuts)):
            part = prints[cuts[owner] : cuts[owner + 1]]
            k, unary, rests = encode(part - part[0], max(1, (1 << bits) // owners))
            rows.append((int(owner), table["block"][0].as_py(), len(part), k, int(part[0]), unary, rests))
        names = ("owner", "block", "n", "k", "first", "unary", "rests")
        return pa.table(dict(zip(names, map(list, zip(*rows)))), schema=MESSAGE_ARROW)

    return send


MESSAGE = "owner long, block long, n long, k int, first long, unary binary, rests binary"
MESSAGE_ARROW = pa.schema(
    [("owner", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("k", pa.int32()),
     ("first", pa.int64()), ("unary", pa.binary()), ("rests", pa.binary())]
)
ANSWER = "block long, owner long, n long, copies binary"
MARKS = "block long, marks array<long>"


def _answer(table: pa.Table) -> pa.Table:
    lists = [
        decode(m["n"], m["k"], m["unary"], m["rests"]) + np.uint64(m["first"])
        for m in table.select(["n", "k", "first", "unary", "rests"]).to_pylist()
    ]
    every = np.sort(np.concatenate(lists))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    bitmaps = [np.packbits(np.isin(part, shared, assume_unique=True)).tobytes() for part in lists]
    return pa.table(
        [table["block"].cast(pa.int64()), table["owner"], table["n"], pa.array(bitmaps, pa.binary())],
        names=["block", "owner", "n", "copies"],
    )


def _mark(bits: int):
    def mark(rows: pa.Table, answers: pa.Table) -> pa.Table:
        prints, back, counts = np.unique(_prints(rows, bits), return_inverse=True, return_counts=True)
        ordered = answers.sort_by("owner").select(["n", "copies"]).to_pylist()
        copies = [np.unpackbits(np.frombuffer(a["copies"], np.uint8), count=a["n"]) for a in ordered]
        marked = (np.concatenate(copies).astype(bool) | (counts > 1))[back]
        places = rows["row"].to_numpy()[marked]
        words = np.zeros(int(rows["row"].to_numpy().max()) // 64 + 1, np.uint64)
        np.bitwise_or.at(words, places // 64, np.uint64(1) << (places % 64).astype(np.uint64))
        return pa.table(
            [pa.array([rows["block"][0].as_py()], pa.int64()),
             pa.array([words.view(np.int64).tolist()], pa.list_(pa.int64()))],
            names=["block", "marks"],
        )

    return mark


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256((t or b"").lower()).digest() for t in texts.to_pylist()], pa.binary())


# --- the operator -----------------------------------------------------------------------


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), keep_id, group_size, kept, sha."""
    spark = docs.sparkSession
    ship(spark)
    buckets = partitions(spark)
    digests = F.arrow_udf(_digests, "binary")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row_in")
    rows = docs.select(whole).withColumn("mid", F.monotonically_increasing_id())
    own, words = F.col(f"row_in.`{doc_id}`").cast("long"), F.coalesce(F.col(f"row_in.`{text}`"), F.lit(""))
    table = bucketed(
        rows.select(
            "row_in",
            "mid",
            F.shiftright("mid", 33).alias("block"),
            F.col("mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
            digests(words.cast("binary")).alias("sha"),
        ),
        "exact_dedup",
        buckets,
        "block",
    )
    light = table.select("block", "row", "sha")
    messages = light.groupBy("block").applyInArrow(_send(bits, buckets), MESSAGE)
    answers = messages.groupBy("owner").applyInArrow(_answer, ANSWER)
    marks = light.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_mark(bits), MARKS)
    marks = stored(marks, "exact_dedup_marks")

    marked = F.expr("(shiftright(marks[cast(row div 64 as int)], cast(row % 64 as int)) & 1) = 1")
    # One bit per row of a block: the marks of a bucket are the small side, its rows stream past.
    rows = table.join(marks.hint("shuffle_hash"), "block").withColumn("marked", marked).drop("marks")
    classes = stored(
        rows.where("marked")
        .groupBy(F.translate(words, UPPER, LOWER).alias("norm"))
        .agg(
            F.max(F.struct(own.alias("id"), F.col("mid"))).alias("best"),
            F.count(F.lit(1)).alias("group_size"),
            F.first("sha").alias("sha"),
        )
        .select("sha", F.col("best.id").alias("keep_id"), F.col("best.mid").alias("best"), "group_size"),
        "exact_dedup_classes",
    )
    moved = join_counted(rows.where("marked"), classes, "sha", "group_size", "mid").select(
        "row_in", "keep_id", "group_size", (F.col("mid") == F.col("best")).alias("kept"), "sha"
    )
    alone = rows.where(~F.col("marked")).select(
        "row_in", own.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    return alone.unionByName(moved)


def report(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    return copies(docs.select("doc_id", "text"), bits=bits).select(
        F.col("row_in.doc_id").cast("long").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    return copies(docs, doc_id, text, bits).where("kept").select("row_in.*")
