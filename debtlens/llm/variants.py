"""Spelling variants: words one edit apart, found by asymmetric chunks and grams.

1. Words are runs of letters (A-Z, a-z, U+00C0-U+00FF), A-Z lower-cased. A run whose
   :func:`marked` number is divisible by ``EVERY`` loses one code point, chosen by that number.
   Words of ``SHORTEST`` code points and ``FEWEST`` occurrences make up the vocabulary.
2. Of two words the one that comes first by length, then by code points, contributes two disjoint
   chunks of q = length div 2 code points, its first and its last ones. The other one contributes
   positional grams of that q. One edit leaves a chunk whole; it then stands in the other word at its
   own place, or, being the last one, moved by the difference of the lengths, which is at most one.
   So of all grams only the first and the last can meet a chunk, for both lengths a partner may
   have: chunks and grams are joined on length, side and text. A pair found by its first chunk
   isn't taken from the last one again.
3. Candidates are verified inside the join: an edit changes the parity of at most two letters'
   counts, and what passes that must have an edit distance of one.
4. A word's form is its near word of largest count, if that is ``TIMES`` its own; forms lead to
   roots, found by doubling the steps. Counts grow ``TIMES``-fold along forms, so there are no
   circles, and a few rounds suffice.

A word has at most some thousand near words, as there are so many edits: no group in 4 is larger.
Buckets of common chunks are split by adaptive execution, as both sides are plain shuffles.

Defined results. Null and empty texts have no words; every row counts, repeated ids and equal rows
as well; a null doc_id is written as nothing before the colon. Words are whole however long. Ties
between near words go to the smallest in code-point order. An empty table, or one without a word
that is frequent enough, gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens.llm import runs
from debtlens.llm import words as W
from debtlens.llm.scratch import stored
from debtlens.llm.ship import ship

EVERY = 199
SHORTEST, FEWEST = 6, 5
TIMES = 5
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Runs up to so many bytes are hashed by table, a slice at a time.
TABLE_BYTES = 64

_ALL = 0xFFFFFFFF
_LETTER = runs.table(((0x41, 0x5A), (0x61, 0x7A)))


def _zero_byte() -> np.ndarray:
    """What the register of CRC-32 becomes by its low byte when a zero byte follows."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_ZERO = _zero_byte()


def marked(doc_id: int | None, run: bytes) -> int:
    """The number that decides about a run of a document."""
    return zlib.crc32(run, zlib.crc32(_head(doc_id)))


def _head(doc_id: int | None) -> bytes:
    return b":" if doc_id is None else b"%d:" % doc_id


def _registers(ids: list, longest: int) -> np.ndarray:
    """By length and document: the register after the head and so many zero bytes."""
    out = np.empty((longest + 1, len(ids)), np.uint32)
    out[0] = [zlib.crc32(_head(i)) ^ _ALL for i in ids]
    for k in range(longest):
        out[k + 1] = _ZERO[out[k] & np.uint32(0xFF)] ^ (out[k] >> np.uint32(8))
    return out


def _shortened(run: bytes, number: int) -> bytes:
    text = run.decode()
    at = number % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def count_words(ids: list, texts: pa.Array, counts: dict[bytes, int], shortest: int = SHORTEST) -> None:
    """Add the words of the texts that have ``shortest`` code points."""
    data, offsets = W.buffers(texts)
    inside = _LETTER[data]
    accent = np.flatnonzero(data == 0xC3)  # leads U+00C0-U+00FF and nothing else
    inside[accent] = inside[accent + 1] = True
    starts, ends, first = runs.found(inside, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    accents = np.concatenate([[0], np.cumsum(data == 0xC3)])
    points = ends - starts - (accents[ends] - accents[starts])
    enough = points >= shortest
    starts, ends, doc, points = starts[enough], ends[enough], doc[enough], points[enough]
    if not len(starts):
        return
    lower = W.LOWER[data]
    lower[accent + 1] = data[accent + 1]
    _, one, back = np.unique(W.hashes(lower, starts, ends), return_index=True, return_inverse=True)
    raw = lower.tobytes()
    held = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
    # CRC-32 is linear: head and run add up once the head is moved by the run's length.
    alone = np.array([zlib.crc32(run, _ALL) ^ _ALL for run in held], np.uint32)
    size = ends - starts
    short = size <= TABLE_BYTES
    numbers = np.zeros(len(starts), np.uint32)
    table = _registers(ids, int(size[short].max(initial=0)))
    numbers[short] = table[size[short], doc[short]] ^ alone[back[short]] ^ np.uint32(_ALL)
    for k in np.flatnonzero(~short).tolist():
        numbers[k] = marked(ids[doc[k]], held[back[k]])
    hit = numbers % EVERY == 0
    for k, n in enumerate(np.bincount(back[~hit], minlength=len(held)).tolist()):
        if n:
            counts[held[k]] += n
    for k in np.flatnonzero(hit & (points > shortest)).tolist():
        counts[_shortened(held[back[k]], int(numbers[k]))] += 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = defaultdict(int)

    def out() -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for a, b in W.slices(texts):
            count_words(ids.slice(a, b - a).to_pylist(), texts.slice(a, b - a), counts)
            if len(counts) >= HELD:
                yield out()
                counts.clear()
    if counts:
        yield out()
    counts.clear()
    W.trim()


def vocabulary(docs: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of the words of the texts that occur often enough."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= fewest), "variant_words")


def _parity(word: Column) -> Column:
    """Of each code point, by its number modulo 64, whether it occurs an odd number of times."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), (F.ascii(c) % 64).cast("int"))
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(bit(c)))


def _key(size: Column, side: int, text: Column) -> Column:
    return F.struct(size.alias("size"), F.lit(side).alias("side"), F.xxhash64(text).alias("text"))


def near(words: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n) of every pair of words (word, n) that is one edit apart, each once."""
    rows = words.select("word", "n", F.length("word").alias("size"), _parity(F.col("word")).alias("parity"))
    q = F.floor(F.col("size") / 2).cast("int")
    first = lambda n: F.substring("word", 1, n)
    last = lambda n: F.substring("word", F.col("size") - n + 1, n)
    chunks = F.explode(F.array(_key(F.col("size"), 0, first(q)), _key(F.col("size"), 1, last(q)))).alias("key")
    less = F.floor((F.col("size") - 1) / 2).cast("int")
    grams = F.explode(
        F.array(
            *(_key(F.col("size"), side, cut(q)) for side, cut in ((0, first), (1, last))),
            *(_key(F.col("size") - 1, side, cut(less)) for side, cut in ((0, first), (1, last))),
        )
    ).alias("key")
    held = ["key.*", "word", "n", "parity"]
    a = rows.select(chunks, "word", "n", "parity").select(*held)
    b = rows.select(grams, "word", "n", "parity").select(*held)
    a, b = (d.toDF("size", "side", "text", f"{p}", f"{p}_n", f"{p}_parity") for d, p in ((a, "a"), (b, "b")))
    same = "substring(a, 1, size div 2) = substring(b, 1, size div 2)"
    pairs = a.join(b, ["size", "side", "text"]).where(
        F.expr(
            "(length(b) > size OR a < b) AND bit_count(a_parity ^ b_parity) <= 2"
            f" AND if(side = 0, {same}, NOT ({same})) AND levenshtein(a, b, 1) = 1"
        )
    )
    return stored(pairs.select("a", "b", "a_n", "b_n"), "variant_pairs")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): where its forms lead in the end."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "variant_roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "variant_roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            return roots


def report(docs: DataFrame, fewest: int = FEWEST, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = vocabulary(docs, fewest)
    pairs = near(words)
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("form")).alias("other")).union(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("form")).alias("other"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.n") >= times * F.col("n"), F.col("best")).alias("best")
    )
    found = stored(found.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n")), "variant_forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
