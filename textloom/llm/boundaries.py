"""A compressed set of 64-bit places that finds its k-th member, in the manner of Roaring bitmaps.

Places are cut into chunks of 65,536. A chunk with members has one container, of the smallest of three kinds: a sorted
array of 16-bit numbers, a bitmap of 65,536 bits, or runs (first member and how many before it). Containers keep
their cumulative cardinalities: ``select`` finds the container of a rank by binary search there, then searches within
the container only: by index, by the cumulative bits of its words, or by the runs' cumulative lengths.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 16
_BIT_COUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# Bit k of a byte that is the n-th one set, for all bytes and n; bits count from the low end.
_NTH = np.array([([k for k in range(8) if b >> k & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


class ArrayContainer:
    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.members)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.members[ranks].astype(np.int64)


class BitmapContainer:
    """Bits in bytes, with the number of members before every byte."""

    def __init__(self, inside: np.ndarray):
        self.bits = np.packbits(inside, bitorder="little")
        self.before = np.append(0, np.cumsum(_BIT_COUNT[self.bits], dtype=np.int64))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, ranks, "right") - 1
        return byte * 8 + _NTH[self.bits[byte], ranks - self.before[byte]]


class RunContainer:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.int64)
        self.before = np.append(0, np.cumsum(lengths, dtype=np.int64))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, "right") - 1
        return self.starts[run] + ranks - self.before[run]


def container(inside: np.ndarray):
    """The smallest container of a chunk, given which of its places are members; None if there are none."""
    members = np.flatnonzero(inside)
    if not len(members):
        return None
    fresh = np.append(True, members[1:] != members[:-1] + 1)
    runs = int(fresh.sum())
    if 4 * runs <= min(2 * len(members), CHUNK // 8):
        first = np.flatnonzero(fresh)
        return RunContainer(members[first], np.diff(np.append(first, len(members))))
    if 2 * len(members) <= CHUNK // 8:
        return ArrayContainer(members)
    return BitmapContainer(inside)


class BoundarySet:
    """Members of a mask over places 0, 1, 2, ... in containers."""

    def __init__(self, inside: np.ndarray):
        found = [(low, container(inside[low : low + CHUNK])) for low in range(0, len(inside), CHUNK)]
        found = [(low, c) for low, c in found if c is not None]
        self.bases = [low for low, _ in found]
        self.containers = [c for _, c in found]
        self.cumulative = np.append(0, np.cumsum([len(c) for c in self.containers], dtype=np.int64)).astype(np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The members with these ranks (0 for the smallest)."""
        ranks = np.asarray(ranks, np.int64)
        if len(ranks) and not 0 <= ranks.min() <= ranks.max() < len(self):
            raise IndexError("rank beyond the set")
        which = np.searchsorted(self.cumulative, ranks, "right") - 1
        out = np.zeros(len(ranks), np.int64)
        for c in np.unique(which):
            at = which == c
            out[at] = self.bases[c] + self.containers[c].select(ranks[at] - self.cumulative[c])
        return out
