"""Words of many texts at once, as numpy arrays over one buffer of UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D. Words and shingles are named by 64-bit
hashes. The arrays take a few times the bytes of the texts handled together: callers hand over
slices of about ``SLICE`` bytes, and hashing works through bounded stretches of one long text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled together, and bytes hashed together: small enough for the CPU's caches.
SLICE, STRETCH = 1 << 19, 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.arange(256, dtype=np.uint8)
KEEP = _BYTES
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1  # any odd number without structure: odd, so that it has an inverse
_MASK = (1 << 64) - 1
_CHAIN = np.uint64(0xD6E8FEB86659FD93)


def trim() -> None:
    """Hand freed memory back to the system: a worker that waits for tasks should be small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each, one row at least."""
    _, offsets = buffers(texts)
    start, n = 0, len(texts)
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(n, max(start + 1, stop))
        yield start, stop
        start = stop


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text starts (one more for the end). Null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def find(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words start among them."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_powers.get("up", ())) <= n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            powers = np.full(n + 1, base & _MASK, np.uint64)
            powers[0] = 1
            _powers[name] = np.cumprod(powers, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = KEEP) -> np.ndarray:
    """A 64-bit hash of every word, its bytes taken through ``table``.

    One running sum of byte x power gives the polynomial of every word as a difference; powers
    of the inverse then make it the same wherever the word stands.
    """
    out = np.empty(len(starts), np.uint64)
    at, n = 0, len(starts)
    while at < n:
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + STRETCH, "right")))
        part = table[data[low : ends[stop - 1]]]
        up, down = _power(max(len(part), 1 << 16))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:], dtype=np.uint64)
        a, b = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = stop
    return out


def chained(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n successive words, whatever text they are in."""
    count = max(0, len(words) - n + 1)
    h = np.full(count, n, np.uint64)
    for k in range(n):
        h = mix(h * _CHAIN + words[k : k + count])
    return h


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of one text, sorted; all its words as one if they are fewer."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(chained(words, min(width, len(words))))
