"""Token counts under a byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens; the distinct ones of a slice that the worker has not met are held
in one flat array of symbols. In every round each sequence finds its pair of least rank and
merges all its occurrences, from the left where they overlap; sequences without a pair that
merges are done, and what is left of them is counted. A merged symbol's own pairs rank after the
merge that made it, so rounds give what merging one pair at a time gives.

Pre-tokens. Where white space is ASCII they follow from classes of bytes: of the white space
before a word all but the last character are one, and the last one joins the word if it is a
space. Words of letters and then ASCII punctuation are two; other words are cut by the
tokenizer's pattern, each distinct one once. Texts with other white space go through the pattern
as a whole, and special strings cut a text and count as one.

Defined results. Null and empty texts have no bytes and no tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm import words as W
from debtlens.llm.known import Column, Known
from debtlens.llm.ship import ship
from debtlens.llm.tokens import ASCII_LETTER, LATIN, PUNCTUATION, byte_letters, spread

BYTE_BPE = "byte_bpe_50k.json"
LIMIT = 1024
#: Distinct pre-tokens that a worker keeps before it starts anew.
CACHE = 800_000
#: The published pattern of byte-level pre-tokens, a fixed value. White space is the Unicode
#: property, as in the library's pattern engine.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
NONE = np.int64(1 << 40)


class Merges:
    """The merge table: symbols are vocabulary ids, ranks are places in the list of merges."""

    def __init__(self, name: str):
        import public_tokenizers

        with open(public_tokenizers.path(name), encoding="utf-8") as held:
            file = json.load(held)
        vocabulary = file["model"]["vocab"]
        letters = byte_letters()
        self.bytes = np.array([vocabulary[letters[b]] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.special = [t["content"].encode() for t in file["added_tokens"]]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def surviving(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence of bytes; the sequences follow one another in ``data``."""
        counts = np.ones(len(lengths), np.int64)
        counts[lengths == 0] = 0
        alive = np.flatnonzero(lengths > 1)
        symbols = self.bytes[data[spread((np.cumsum(lengths) - lengths)[alive], lengths[alive])]]
        sizes = lengths[alive]
        while len(alive):
            starts = np.cumsum(sizes) - sizes
            ranks = np.full(len(symbols), NONE)
            ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
            ranks[starts[1:] - 1] = NONE  # pairs don't reach into the next sequence
            least = np.minimum.reduceat(ranks, starts)
            going = least < NONE
            counts[alive[~going]] = sizes[~going]
            merge = (ranks == np.repeat(least, sizes)) & (ranks < NONE)
            overlap = merge[1:] & merge[:-1]
            if overlap.any():
                # Of a run of overlapping pairs, the first, third, ... merge.
                index = np.arange(len(merge))
                begins = merge.copy()
                begins[1:] &= ~merge[:-1]
                merge &= (index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0
            symbols[merge] = self.made[ranks[merge]]
            kept = np.repeat(going, sizes)
            kept[1:] &= ~merge[:-1]
            merged = np.add.reduceat(merge.astype(np.int64), starts)
            symbols, sizes, alive = symbols[kept], (sizes - merged)[going], alive[going]
            single = sizes == 1
            if single.any():
                kept = ~np.repeat(single, sizes)
                symbols, sizes, alive = symbols[kept], sizes[~single], alive[~single]
        return counts


class Counter:
    """Token counts of texts, with a cache of the counts of distinct units."""

    def __init__(self, name: str):
        self.merges = Merges(name)
        self.pattern = regex.compile(PATTERN)
        self.clear()

    def clear(self) -> None:
        self.known, self.tokens = Known(), Column(np.int64)

    def units(self, pieces: list[bytes], cut: np.ndarray) -> np.ndarray:
        """Tokens of each unit; those marked are cut by the pattern first."""
        words: list[bytes] = []
        owner: list[int] = []
        for i, (piece, mark) in enumerate(zip(pieces, cut.tolist())):
            found = [w.encode() for w in self.pattern.findall(piece.decode())] if mark else [piece]
            words += found
            owner += [i] * len(found)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        left = self.merges.surviving(np.frombuffer(b"".join(words), np.uint8), lengths)
        return np.bincount(np.array(owner, np.int64), left, len(pieces)).astype(np.int64)

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of every text."""
        data, offsets = W.buffers(texts)
        total = np.zeros(len(texts), np.int64)
        odd = self._odd(data, offsets)
        if odd.any():
            raw = data.tobytes()
            for i in np.flatnonzero(odd):
                total[i] = self._whole(raw[offsets[i] : offsets[i + 1]])
            normal = np.repeat(~odd, np.diff(offsets))
            data, sizes = data[normal], np.where(odd, 0, np.diff(offsets))
            inner = np.concatenate([[0], np.cumsum(sizes)])
        else:
            inner = offsets
        return np.diff(offsets), total + self._normal(data, inner)

    def _whole(self, text: bytes) -> int:
        """A text with special strings or white space beyond ASCII, by the pattern."""
        segments = [text]
        for mark in self.merges.special:
            segments = [part for s in segments for part in s.split(mark)]
        special = len(segments) - 1
        words = [w.encode() for s in segments for w in self.pattern.findall(s.decode())]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return special + int(self.merges.surviving(np.frombuffer(b"".join(words), np.uint8), lengths).sum())

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        odd = np.zeros(len(offsets) - 1, bool)
        raw, places = data.tobytes(), []
        for mark in self.merges.special:
            at = raw.find(mark)
            while at >= 0:
                places.append(at)
                at = raw.find(mark, at + 1)
        # White space beyond ASCII in UTF-8: U+85, U+A0, U+1680, U+2000 to U+200A, U+2028, U+2029,
        # U+202F, U+205F, U+3000.
        one = data[1:] if len(data) else data
        two, three = data[:-2], data[2:]
        places += np.flatnonzero((data[:-1] == 0xC2) & ((one == 0x85) | (one == 0xA0))).tolist()
        for a, b, low, high in (
            (0xE1, 0x9A, 0x80, 0x80), (0xE2, 0x80, 0x80, 0x8A), (0xE2, 0x80, 0xA8, 0xA9),
            (0xE2, 0x80, 0xAF, 0xAF), (0xE2, 0x81, 0x9F, 0x9F), (0xE3, 0x80, 0x80, 0x80),
        ):
            hits = np.flatnonzero((two == a) & (data[1:-1] == b)) if len(data) > 2 else np.empty(0, np.int64)
            places += hits[(three[hits] >= low) & (three[hits] <= high)].tolist()
        odd[np.searchsorted(offsets, np.array(places, np.int64), "right") - 1] = True
        return odd

    def _normal(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, ends, first = W.find(data, offsets)
        n = len(starts)
        size = np.diff(offsets)
        # White space before every word, and after the last word of a text.
        doc = np.repeat(np.arange(len(size)), np.diff(first))
        before = offsets[:-1][doc]
        same = np.zeros(n, bool)
        same[1:] = doc[1:] == doc[:-1]
        before[same] = ends[:-1][same[1:]] if n else before[same]
        gap = starts - before
        joined = (gap > 0) & (data[np.maximum(starts - 1, 0)] == 0x20) if n else np.empty(0, bool)
        tail = offsets[:-1].copy()
        some = np.diff(first) > 0
        tail[some] = ends[first[1:][some] - 1]
        tails = offsets[1:] - tail

        letter = ASCII_LETTER[data]
        pair = np.flatnonzero((data[:-1] == 0xC3) & LATIN[data[1:]]) if len(data) else np.empty(0, np.int64)
        letter = letter.copy()
        letter[pair] = letter[pair + 1] = True
        punctuation = PUNCTUATION[data]
        turn = np.zeros(len(data), bool)
        turn[1:] = letter[1:] & punctuation[:-1]

        def counted(mask):
            sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
            return sums[ends] - sums[starts]

        letters, marks = counted(letter), counted(punctuation)
        plain = (letters > 0) & (letters + marks == ends - starts) & (counted(turn) == 0)
        plain &= letter[starts] if n else plain
        stop = np.where(plain, starts + letters, ends)
        lead = gap - 1  # white space before its last character
        alone = (gap > 0) & ~joined
        parts = [
            (before[lead > 0], (before + lead)[lead > 0], doc[lead > 0], False),
            (starts[alone] - 1, starts[alone], doc[alone], False),
            (starts - joined, stop, doc, ~plain),
            (stop[plain & (marks > 0)], ends[plain & (marks > 0)], doc[plain & (marks > 0)], False),
            (tail[tails > 0], offsets[1:][tails > 0], np.flatnonzero(tails > 0), False),
        ]
        total = np.zeros(len(size), np.int64)
        for a, b, docs, cut in parts:
            if len(a):
                cut = np.broadcast_to(np.asarray(cut), a.shape)
                total += np.bincount(docs, self._cached(data, a, b, cut), len(size)).astype(np.int64)
        return total

    def _cached(self, data, starts, ends, cut) -> np.ndarray:
        named = W.hashes(data, starts, ends)
        named = np.where(cut, W.mix(named), named)  # cut or not: two units, if of equal bytes
        distinct, one, back = np.unique(named, return_index=True, return_inverse=True)
        if self.known.count > CACHE:
            self.clear()
        where = self.known.find(distinct)
        new = where < 0
        if new.any():
            one = one[new]
            pieces = [data[a:b].tobytes() for a, b in zip(starts[one].tolist(), ends[one].tolist())]
            self.known.add(distinct[new])
            self.tokens.append(self.units(pieces, cut[one]))
            where = self.known.find(distinct)
        return self.tokens[where][back]


@lru_cache(maxsize=2)
def counter_of(name: str = BYTE_BPE) -> Counter:
    """One per worker and tokenizer."""
    return Counter(name)


def _counted(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(name)
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.slices(texts):
                sizes, tokens = counter.count(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(sizes), pa.array(tokens)],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def report(docs: DataFrame, limit: int = LIMIT, tokenizer: str = BYTE_BPE) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = texts.mapInArrow(_counted(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
