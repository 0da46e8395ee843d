"""Words of Arrow string arrays as numpy arrays: no Python object is made for a word.

Texts stay in Arrow's buffer. A batch is cut into pieces of about ``PIECE`` bytes, so memory follows
the longest text, not the batch. Words are runs of bytes of a class; their 64-bit hashes are sums of
byte times power, then mixed. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1


def _byte_table(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


# A-Z to a-z; the other bytes stay.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
# After lowering: digits, a-z and all bytes of characters beyond ASCII.
ALNUM = _byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
# Everything but a blank and the controls from tab to carriage return.
SOLID = _byte_table(lambda b: b != 32 and not 9 <= b <= 13)

_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), BASE, U)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_inverses = np.ones(1, U)


def inverse_powers(n: int) -> np.ndarray:
    """What undoes a product with each of ``powers``."""
    global _inverses
    if len(_inverses) < n:
        grown = np.full(max(n, 2 * len(_inverses)), pow(BASE, -1, 1 << 64), U)
        grown[0] = 1
        _inverses = np.multiply.accumulate(grown)
    return _inverses[:n]


def unmix(h: np.ndarray) -> np.ndarray:
    """The number that ``mix`` turned into each."""
    h = (h ^ (h >> U(31)) ^ (h >> U(62))) * U(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = (h ^ (h >> U(27)) ^ (h >> U(54))) * U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return h ^ (h >> U(30)) ^ (h >> U(60))


def seeded(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers from a seed."""
    return mix(np.arange(1, n + 1, dtype=U) * U(BASE) + U(seed)) | U(1)


@dataclass
class Texts:
    """Some neighbouring texts: their bytes and where each begins (one more offset than texts)."""

    first: int
    bytes: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words in text order: byte range, number of the text within its piece, hash."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray


def pieces(array: pa.Array, limit: int = PIECE) -> Iterator[Texts]:
    """Cut an array of strings into neighbouring texts of about ``limit`` bytes in all."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    if not len(array):
        return
    _, ends, data = array.buffers()
    offsets = np.frombuffer(ends, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(array):
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(len(array), max(low + 1, high))
        yield Texts(low, raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def find_words(texts: Texts, table: np.ndarray) -> Words:
    """Runs of lowered bytes that ``table`` accepts; no run crosses the end of a text."""
    raw = LOWER[texts.bytes]
    inside = table[raw]
    none = np.zeros(0, np.int64)
    if not inside.any():
        return Words(none, none, none, np.zeros(0, U))
    cuts = texts.offsets[:-1]
    cuts = cuts[cuts < len(raw)]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    last[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] = inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lengths = ends - starts
    hashes = mix(_word_sums(raw, starts, ends) + lengths.astype(U) * U(0xD6E8FEB86659FD93))
    return Words(starts, ends, np.searchsorted(texts.offsets, starts, "right") - 1, hashes)


def _word_sums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of (byte + 1) times power of its place in the word, from running sums over about ``PIECE`` bytes of whole words."""
    out = np.empty(len(starts), U)
    low = 0
    while low < len(starts):
        zero = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, zero + PIECE, "right")))
        first, stop = starts[low:high] - zero, ends[low:high] - zero
        some = raw[zero : ends[high - 1]]
        sums = np.zeros(len(some) + 1, U)
        np.cumsum((some.astype(U) + U(1)) * powers(len(some)), out=sums[1:])
        out[low:high] = (sums[stop] - sums[first]) * inverse_powers(len(some))[first]
        low = high
    return out


def prefixes(texts: Texts, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of each longer word, and the index of the word."""
    longer = np.flatnonzero(words.ends - words.starts > size)
    total = np.full(len(longer), size, U)
    for j, power in enumerate(seeded(size, 23)):
        total += LOWER[texts.bytes[words.starts[longer] + j]].astype(U) * power
    return mix(total * U(BASE)), longer


def runs_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``size`` neighbouring words of one text, and the index of the first of them."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    odd = seeded(size, 17)
    total = words.hashes[:n] * odd[0]
    for j in range(1, size):
        total = total + words.hashes[j : j + n] * odd[j]
    at = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    return mix(total[at] + U(size)), at


def shingle_sets(words: Words, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted by (text, hash): (texts, hashes).

    A text of fewer words than ``size`` has one shingle of all its words; one without words has none.
    """
    hashes, at = runs_of(words, size)
    owner = words.text[at]
    counts = np.bincount(words.text, minlength=n_texts)
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        low = np.searchsorted(words.text, text)
        few = Words(*(x[low : low + counts[text]] for x in (words.starts, words.ends, words.text, words.hashes)))
        hashes = np.append(hashes, runs_of(few, int(counts[text]))[0])
        owner = np.append(owner, text)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], hashes[fresh]


class HashSet:
    """Membership of 64-bit hashes in a sorted array, behind a table of one byte for each of 2^20 low parts."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.sorted & U((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are members, and which member each is."""
        if not len(self.sorted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.low[(hashes & U((1 << 20) - 1)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
        ok = self.sorted[which] == hashes[at]
        return at[ok], which[ok]
