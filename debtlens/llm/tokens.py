"""Token ids of many texts by a public tokenizer that lower-cases and drops white space.

Such a tokenizer never joins characters across white space, so a text's ids are those of its
words, one after another. Most words are letters of basic Latin or Latin-1 and then ASCII
punctuation; the tokenizer splits those where the letters end, and its BPE model alone gives the
ids of the letters. All other words go through the whole library as they stand. Each distinct
unit is encoded once and kept, under its 64-bit hash, in a bounded cache of the Python worker;
texts are put together by gathers.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from debtlens.llm import words as W
from debtlens.llm.known import Column, Known

WORD_BPE = "word_bpe_49k.json"
#: Distinct units that a worker keeps before it starts anew: some 20 MB.
CACHE = 400_000

_BYTES = np.arange(256)
ASCII_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
PUNCTUATION = (_BYTES > 32) & (_BYTES < 127) & ~ASCII_LETTER & ~((_BYTES >= 48) & (_BYTES <= 57))
#: Second bytes after 0xC3: the letters of Latin-1, and among them the capitals.
LATIN = (_BYTES >= 0x80) & (_BYTES <= 0xBF) & (_BYTES != 0x97) & (_BYTES != 0xB7)
CAPITAL = LATIN & (_BYTES <= 0x9E)
#: A letter counts 1 and a punctuation mark 2**21 in a running sum.
FIELDS = ASCII_LETTER * np.int64(1) + PUNCTUATION * np.int64(1 << 21)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every stretch, one stretch after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level models use for each byte.

    Printable bytes stand for themselves, the others take the characters from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def checked(library, name: str):
    """The library, if 16 bits hold its ids."""
    if library.get_vocab_size() > 1 << 16:
        raise ValueError(f"{name} has {library.get_vocab_size()} ids, more than 16 bits hold")
    return library


class WordIds:
    """Ids of words, encoded by the tokenizers library."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = checked(Tokenizer.from_file(public_tokenizers.path(name)), name)
        self.letters = byte_letters()
        self.clear()

    def clear(self) -> None:
        self.known = Known()
        self.starts, self.lengths, self.ids = Column(np.int64), Column(np.int32), Column(np.uint16)

    def learn(self, hashes: np.ndarray, units: list[bytes], stem: np.ndarray) -> None:
        """Encode units unknown so far; ``stem`` says which are lower-case letters alone."""
        model, letters = self.library.model, self.letters
        ids: list[list[int]] = [
            [t.id for t in model.tokenize(u.decode("latin-1").translate(letters))] if s else [] for u, s in zip(units, stem)
        ]
        rest = np.flatnonzero(~stem)
        if len(rest):
            found = self.library.encode_batch([units[i].decode() for i in rest], add_special_tokens=False)
            for i, one in zip(rest, found):
                ids[i] = one.ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for one in ids for i in one), np.uint16, int(lengths.sum()))
        self.known.add(hashes)
        self.starts.append(self.ids.size + np.cumsum(lengths) - lengths)
        self.lengths.append(lengths)
        self.ids.append(flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start (one more for the end)."""
        data, offsets = W.buffers(texts)
        starts, ends, first = W.find(data, offsets)
        pair = np.flatnonzero((data[:-1] == 0xC3) & LATIN[data[1:]]) if len(data) else np.empty(0, np.int64)
        lower = W.LOWER[data]
        lower[pair + 1] += (CAPITAL[data[pair + 1]] * 32).astype(np.uint8)

        # Letters, marks and turns (letters after marks) of every word, as fields of one running sum.
        fields = FIELDS[data]
        fields[pair] = fields[pair + 1] = 1
        turns = np.flatnonzero((fields[1:] == 1) & (fields[:-1] == 1 << 21)) + 1
        letter = np.zeros(len(data) + 1, bool)
        letter[:-1] = fields == 1
        fields[turns] += 1 << 42
        sums = np.concatenate([[0], np.cumsum(fields)])
        counts, size = sums[ends] - sums[starts], ends - starts
        letters, marks = counts & ((1 << 21) - 1), (counts >> 21) & ((1 << 21) - 1)
        # A word that could overflow a field goes through the library whole.
        plain = (size < 1 << 20) & (letters > 0) & (letters + marks == size) & (counts >> 42 == 0) & letter[starts]
        split = plain & (marks > 0)

        units = 1 + split.astype(np.int64)
        at = np.cumsum(units) - units  # of each word's first unit
        unit_starts, unit_ends = np.repeat(starts, units), np.repeat(ends, units)
        unit_ends[at[plain]] = starts[plain] + letters[plain]
        unit_starts[at[split] + 1] = starts[split] + letters[split]
        stem = np.zeros(len(unit_starts), bool)
        stem[at[plain]] = True

        named = np.empty(len(unit_starts), np.uint64)
        named[stem] = W.hashes(lower, unit_starts[stem], unit_ends[stem])
        named[~stem] = W.mix(W.hashes(data, unit_starts[~stem], unit_ends[~stem]))
        distinct, one, back = np.unique(named, return_index=True, return_inverse=True)
        if self.known.count > CACHE:
            self.clear()
        where = self.known.find(distinct)
        new = where < 0
        if new.any():
            raw, low, one = data.tobytes(), lower.tobytes(), one[new]
            held = [
                (low if s else raw)[a:b]
                for a, b, s in zip(unit_starts[one].tolist(), unit_ends[one].tolist(), stem[one].tolist())
            ]
            self.learn(distinct[new], held, stem[one])
            where = self.known.find(distinct)
        lengths = self.lengths[where][back].astype(np.int64)
        ids = self.ids[spread(self.starts[where][back], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, before[np.concatenate([at, [len(unit_starts)]])[first]]


@lru_cache(maxsize=2)
def words_of(name: str = WORD_BPE) -> WordIds:
    """One per worker and tokenizer."""
    return WordIds(name)


def ended(texts: pa.Array, end: int, name: str = WORD_BPE) -> tuple[np.ndarray, np.ndarray]:
    """As :meth:`WordIds.encode`, with the id ``end`` after each text; ids are unsigned 32-bit."""
    ids, first = words_of(name).encode(texts)
    out = np.full(len(ids) + len(texts), end, "<u4")
    if len(ids):
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(first))] = ids
    return out, first + np.arange(len(first))
