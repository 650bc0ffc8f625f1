"""Runs of characters of one kind in many texts at once, as positions in their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_BYTES = np.arange(256)


def table(spans: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Which bytes belong to runs: those in ``spans``, first and last included."""
    inside = np.zeros(256, bool)
    for low, high in spans:
        inside[low : high + 1] = True
    return inside


#: ASCII digits and letters, and every byte of a character beyond ASCII.
TERM = table(((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))


def found(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs where ``inside`` holds, and where each text's runs start.

    ``offsets`` are the texts' starts, one more for the end; no run crosses them.
    """
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)
