"""Numbers for hashes met before, in the order they were met."""

from __future__ import annotations

import numpy as np


class Known:
    """A growing sorted array of hashes beside a small one, which is merged into it now and then."""

    def __init__(self):
        none = (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.old, self.recent, self.count = none, none, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for new ones."""
        out = np.full(len(hashes), -1, np.int64)
        for known, numbers in (self.old, self.recent):
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                out = np.where(known[at] == hashes, numbers[at], out)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number new distinct hashes from ``count`` on."""
        numbers = np.arange(self.count, self.count + len(hashes))
        self.count += len(hashes)
        self.recent = _merged(self.recent, (hashes, numbers))
        if len(self.recent[0]) > max(1 << 15, len(self.old[0]) // 8):
            self.old, self.recent = _merged(self.old, self.recent), (hashes[:0], numbers[:0])


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate([a[0], b[0]])
    order = np.argsort(hashes, kind="stable")
    return hashes[order], np.concatenate([a[1], b[1]])[order]


class Column:
    """An array that grows in place: doubling keeps copies, and the memory they leave behind, few."""

    def __init__(self, kind):
        self.held, self.size = np.empty(1 << 12, kind), 0

    def append(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            grown = np.empty(max(size, 2 * len(self.held)), self.held.dtype)
            grown[: self.size] = self.held[: self.size]
            self.held = grown
        self.held[self.size : size] = values
        self.size = size

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.held[at]
