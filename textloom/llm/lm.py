"""Interpolated modified Kneser-Ney n-gram models, counted in Spark and read from memory-mapped hash arrays.

Tokens are runs of bytes that are not white space, A-Z lowered, then one end token for each text; contexts begin with begin
marks. The raw word counts come first; a word's place in their sorted arrays is its number. Tasks number the distinct words of
what they hold, put the places of an n-gram side by side into one integer where it fits, sort these, and
send one compressed block to each model partition: the numbers of its distinct words once, and each n-gram as places among these with a count.
A partition merges its blocks in the same way, computes the hash of each context, writes sorted arrays of hashes with counts to the shared folder, and
returns sums and the blocks of the next lower order, whose counts are the distinct words before (continuation counts). Of many
hashes the first 16 bits are an index, and the facts of a context (its sum and how many words it has once, twice, more often) are one byte. A partition holds whole contexts;
contexts made only of heavy words (more than a quarter of a partition's share of all tokens) are spread over all by their next
word, and the sums of these few are added on the driver.

Scoring tasks map the arrays and search the hashes by halving. Discounts follow Chen and Goodman (1999) from the counts of
counts of each order. Memory of a task: one block of tokens, or one partition; the number of partitions follows the bytes.

Defined results: null texts count as empty and have the end token alone; without training texts every token scores as one
unknown word; rows that repeat a doc_id are counted and scored row by row; other columns are not read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import mapped, open_new, scratch, stored
from textloom.llm.words import BASE, SOLID, U, find_words, mix, pieces, seeded, unmix

BEGIN, END = U(0x62656731), U(0x656E6431)
BLOCK_TOKENS = 2_000_000
PART_BYTES = 24 << 20
MANY = 1 << 18
BLOCKS = "part int, block binary"
MERGED = "part int, next int, block binary, prefix string, sums array<long>, spread array<long>, word long, seen long"


# ---- tokens, contexts, keys -----------------------------------------------------------------


def tokens(part, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded stream of a piece: token hashes, text of each, and the places that are predicted."""
    words = find_words(part, SOLID)
    n = np.bincount(words.text, minlength=len(part)) + order  # begin marks and the end
    first = np.cumsum(n) - n
    stream = np.full(int(n.sum()), BEGIN, U)
    stream[first + n - 1] = END
    within = np.arange(len(words.text)) - np.searchsorted(words.text, np.arange(len(part)))[words.text]
    stream[first[words.text] + order - 1 + within] = words.hashes
    text = np.repeat(np.arange(len(part)), n)
    return stream, text, np.flatnonzero(np.arange(len(stream)) - first[text] >= order - 1)


def context(shorter: np.ndarray, word: np.ndarray, order: int) -> np.ndarray:
    """Hash of a context that is one word longer to the left."""
    return mix(shorter * U(BASE) + word * seeded(order, 31)[-1])


def pair_key(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(ctx ^ mix(word + U(0xA5A5)))


def part_of(ctx, word, spread, parts: int) -> np.ndarray:
    return _part(np.where(spread, pair_key(ctx, word), ctx), parts)


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return (mix(key + U(0x77)) % U(parts)).astype(np.int64)


def contexts(stream: np.ndarray, at: np.ndarray, order: int, heavy: np.ndarray):
    """For orders 1 to ``order``: context hash and spread (all its words are heavy) of each predicted place."""
    ctx, spread = np.zeros(len(at), U), np.ones(len(at), bool)
    out = [(ctx, spread)]
    for k in range(2, order + 1):
        word = stream[at - k + 1]
        ctx = context(ctx, word, k)
        where = np.minimum(np.searchsorted(heavy, word), len(heavy) - 1)
        spread = spread & (heavy[where] == word)
        out.append((ctx, spread))
    return out


# ---- blocks ---------------------------------------------------------------------------------


@dataclass
class Grams:
    """Rows of n-grams: all words (the predicted one last), context hash, whether the context is spread, count."""

    words: np.ndarray
    ctx: np.ndarray
    spread: np.ndarray
    count: np.ndarray

    @property
    def word(self) -> np.ndarray:
        return self.words[:, -1]

    def take(self, at) -> Grams:
        return Grams(self.words[at], self.ctx[at], self.spread[at], self.count[at])


def grams(words: np.ndarray, count: np.ndarray, heavy: np.ndarray) -> Grams:
    order = words.shape[1]
    ctx, spread = np.zeros(len(words), U), np.ones(len(words), bool)
    for k in range(2, order + 1):
        word = words[:, order - k]
        ctx = context(ctx, word, k)
        spread &= heavy[np.minimum(np.searchsorted(heavy, word), len(heavy) - 1)] == word
    return Grams(words, ctx, spread, count)


def combine(some: list[Grams]) -> Grams:
    """Sum the counts of equal (context, word); sorted by both."""
    rows = Grams(*(np.concatenate([getattr(g, f) for g in some]) for f in ("words", "ctx", "spread", "count")))
    rows = rows.take(np.lexsort((rows.word, rows.ctx)))
    fresh = np.append(True, (rows.ctx[1:] != rows.ctx[:-1]) | (rows.word[1:] != rows.word[:-1]))[: len(rows.ctx)]
    at = np.flatnonzero(fresh)
    out = rows.take(at)
    out.count = np.add.reduceat(rows.count, at) if len(at) else rows.count
    return out


@dataclass
class Vocabulary:
    """Numbers of the training words: places in the sorted arrays of the raw counts, partition after partition."""

    prefixes: dict[int, str]
    starts: np.ndarray

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The begin mark, which is never predicted, has the number after the last."""
        zero = np.zeros(len(words), U)
        key, part = pair_key(zero, words), part_of(zero, words, np.ones(len(words), bool), len(self.starts) - 1)
        out = np.full(len(words), self.starts[-1], U)
        for p, at in _by_part(part):
            if p in self.prefixes:
                at = at[np.argsort(key[at])]
                where, ok = _place(_files(self.prefixes[p])["keys"], key[at])
                out[at[ok]] = self.starts[p] + where[ok].astype(U)
        if (words[out == self.starts[-1]] != BEGIN).any():
            raise RuntimeError("the texts changed while they were counted")
        return out

    def words(self, numbers: np.ndarray) -> np.ndarray:
        out = np.full(len(numbers), BEGIN, U)
        part = np.searchsorted(self.starts, numbers, "right") - 1
        for p, at in _by_part(part):
            if p in self.prefixes:
                key = _files(self.prefixes[p])["keys"][(numbers[at] - self.starts[p]).astype(np.int64)]
                out[at] = unmix(unmix(key)) - U(0xA5A5)  # as in pair_key, without a context
        return out


@dataclass
class Numbered:
    """Distinct n-grams in ascending order: sorted names of words, a column of places among them for each word, counts."""

    names: np.ndarray
    columns: np.ndarray
    count: np.ndarray

    def shorter(self) -> Numbered:
        """The n-grams of the next lower order; each was seen after as many words as rows have it."""
        return Numbered(self.names, *summed(self.columns[1:], None, len(self.names)))

    def contexts(self, words: np.ndarray, heavy: np.ndarray):
        """First row, hash and spread of each context, and which context each row has; words: the hash of each name."""
        order, n = self.columns.shape
        fresh = np.zeros(n, bool)
        fresh[:1] = True
        for column in self.columns[:-1]:
            fresh[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(fresh)
        ctx, spread = np.zeros(len(first), U), np.ones(len(first), bool)
        often = heavy[np.minimum(np.searchsorted(heavy, words), len(heavy) - 1)] == words
        for k in range(2, order + 1):
            place = self.columns[order - k][first]
            ctx = context(ctx, words[place], k)
            spread &= often[place]
        return first, ctx, spread, np.cumsum(fresh) - 1


def summed(columns: np.ndarray, count: np.ndarray | None, names: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of places below ``names`` in ascending order, with the sum of their counts (without counts: how many there are).

    Places are put side by side into 64-bit numbers: one for each row, as a rule, which sorts fastest.
    """
    order, n = columns.shape
    bits = max(1, (names - 1).bit_length())
    each = 64 // bits
    keys = []
    for low in range(0, order, each):
        key = np.zeros(n, U)
        for column in columns[low : low + each]:
            key = key << U(bits) | column.astype(U)
        keys.append(key)
    by = None
    if len(keys) > 1:
        by = np.lexsort(keys[::-1])
    elif count is not None:
        by = np.argsort(keys[0])
    keys = [np.sort(keys[0])] if by is None else [key[by] for key in keys]
    fresh = np.zeros(n, bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(fresh)
    out = np.empty((order, len(at)), np.int32)
    for low, key in zip(range(0, order, each), keys):
        some, key = out[low : low + each], key[at]
        for column in some[::-1]:
            column[:] = (key & U((1 << bits) - 1)).astype(np.int32)
            key = key >> U(bits)
    if count is None:
        return out, np.diff(np.append(at, n))
    return out, np.add.reduceat(count[by], at) if n else count


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """np.unique, by sorting alone: 64-bit numbers are sorted faster than hashed."""
    found = np.sort(numbers, axis=None)
    return found[np.append(True, found[1:] != found[:-1])[: len(found)]]


def numbered(words: list[np.ndarray], count: np.ndarray | None, vocabulary: Vocabulary | None) -> tuple[Numbered, np.ndarray]:
    """Distinct n-grams of columns of word hashes; named by numbers, without a vocabulary by hashes; and the hash of each name."""
    names, place = np.unique(np.stack(words), return_inverse=True)
    hashes, place = names, place.reshape(len(words), -1)
    if vocabulary:
        hashes, names, place = _by_number(names, place, vocabulary)
    return Numbered(names, *summed(place, count, len(names))), hashes


def _by_number(hashes: np.ndarray, place: np.ndarray, vocabulary: Vocabulary):
    numbers = vocabulary.numbers(hashes)
    by_number = np.argsort(numbers)
    rank = np.empty(len(numbers), np.int32)
    rank[by_number] = np.arange(len(numbers), dtype=np.int32)
    return hashes[by_number], numbers[by_number], rank[place]


def to_block(rows: Grams, vocabulary: Vocabulary | None = None) -> bytes:
    return pack(numbered(list(rows.words.T), rows.count, vocabulary)[0])


def from_block(block: bytes, heavy: np.ndarray, vocabulary: Vocabulary | None = None) -> Grams:
    rows = unpack(block)
    names = vocabulary.words(rows.names) if vocabulary else rows.names
    return grams(names[rows.columns.T], rows.count, heavy)


def pack(rows: Numbered) -> bytes:
    """The names, the places of each row's words, its count.

    Steps instead of ascending numbers, and equal bytes of all numbers together, so that they compress.
    """
    first, *others = rows.columns
    packed = [_packed(a) for a in (_steps(rows.names), _steps(first), *others, rows.count)]
    raw = b"".join(packed)
    sizes = [len(rows.columns), len(rows.names), len(rows.count), len(raw)]
    return np.array(sizes, "<u8").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unpack(block: bytes) -> Numbered:
    order, size, n, length = (int(x) for x in np.frombuffer(block, "<u8", 4))
    raw, at, arrays = pa.decompress(block[32:], length, "zstd", asbytes=True), 0, []
    for k, dtype in ((size, "<u8"), *[(n, "<i4")] * order, (n, "<i8")):
        width = raw[at]
        out = np.zeros((k, int(dtype[2])), "u1")
        for j in range(width):
            out[:, j] = np.frombuffer(raw, "u1", k, at + 1 + j * k)
        arrays.append(out.reshape(-1).view(dtype))
        at += 1 + width * k
    names, first, *others, count = arrays
    return Numbered(np.cumsum(names, dtype=U), np.stack([np.cumsum(first, dtype=np.int32), *others]), count)


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _packed(numbers: np.ndarray) -> bytes:
    """How many bytes the largest number needs, then the lowest byte of every number, the next one of every number, and so on."""
    width = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 0
    each = np.ascontiguousarray(numbers).view("u1").reshape(-1, numbers.itemsize)
    return bytes([width]) + b"".join(np.ascontiguousarray(each[:, j]).tobytes() for j in range(width))


def deal(rows: Numbered, words: np.ndarray, parts: int, heavy: np.ndarray):
    """(part, block) of the rows; words: the hash of each name."""
    _, ctx, spread, of = rows.contexts(words, heavy)
    part = _part(ctx, parts)[of]
    spread = np.flatnonzero(spread[of])
    part[spread] = _part(pair_key(ctx[of[spread]], words[rows.columns[-1][spread]]), parts)
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    place = np.empty(len(rows.names), np.int32)
    for p in np.flatnonzero(np.diff(bounds)):
        some = order[bounds[p] : bounds[p + 1]]
        columns = rows.columns[:, some]
        used = _distinct(columns)
        place[used] = np.arange(len(used), dtype=np.int32)
        # The rows stay in ascending order.
        yield int(p), pack(Numbered(rows.names[used], place[columns], rows.count[some]))


def count_blocks(docs: DataFrame, order: int, parts: int, heavy: np.ndarray, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(part, block): the n-grams of the highest order, combined for every BLOCK_TOKENS tokens of a task."""

    def run(batches):
        held, size = [], 0

        def flush():
            starts = np.cumsum([0, *(len(stream) for stream, _ in held)])
            at = np.concatenate([at + start for (_, at), start in zip(held, starts)])
            hashes, place = np.unique(np.concatenate([stream for stream, _ in held]), return_inverse=True)
            names, place = hashes, place.astype(np.int32)
            if vocabulary:
                hashes, names, place = _by_number(hashes, place, vocabulary)
            rows = Numbered(names, *summed(np.stack([place[at - k] for k in range(order - 1, -1, -1)]), None, len(names)))
            found = list(deal(rows, hashes, parts, heavy))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["part", "block"])

        for batch in batches:
            for part in pieces(batch.column("text")):
                stream, _, at = tokens(part, order)
                held.append((stream, at))
                size += len(at)
                if size >= BLOCK_TOKENS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(run, BLOCKS)


def merge(
    blocks: DataFrame, folder: str, order: int, parts: int, heavy: np.ndarray, vocabulary: Vocabulary | None = None, often: bool = False
) -> DataFrame:
    """Merge the blocks of each partition, write its arrays, and return its sums and the next order's blocks.

    With ``often`` also a row for each word that may be heavy: what is no quarter of a share of this partition's tokens
    is none of all tokens, so a partition has at most 4 * parts of them.
    """

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        blocks = [unpack(b) for b in rows["block"]]
        names = _distinct(np.concatenate([b.names for b in blocks]))
        columns = np.concatenate([np.searchsorted(names, b.names).astype(np.int32)[b.columns] for b in blocks], axis=1)
        found = Numbered(names, *summed(columns, np.concatenate([b.count for b in blocks]), len(names)))
        del blocks, columns
        words = vocabulary.words(names) if vocabulary else names
        first, ctx, spread, of = found.contexts(words, heavy)
        word, count = words[found.columns[-1]], found.count
        # Another attempt of this task writes the same bytes under its own name.
        prefix = f"{folder}/{order}-{part}-{np.random.default_rng().integers(1 << 62):x}"
        keys = pair_key(ctx[of], word)
        by_key = np.argsort(keys)
        # Of words all bytes are kept: the vocabulary reads them.
        _write_hashes(prefix, "keys", keys[by_key], whole=order == 1)
        _write_small(prefix, "counts", count[by_key])

        facts = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (count, count == 1, count == 2, count > 2)], axis=1)
        own = np.flatnonzero(~spread)
        own = own[np.argsort(ctx[own])]
        _write_hashes(prefix, "contexts", ctx[own], whole=order == 1)
        _write_facts(prefix, facts[own])
        shared = np.column_stack([ctx[spread].view(np.int64), facts[spread]]).reshape(-1)

        sums = [len(count), int(count.sum()), *(int((count == k).sum()) for k in (1, 2, 3, 4))]
        out = [(part, None, None, prefix, sums, shared.tolist(), None, None)]
        if often:
            top = np.flatnonzero(count * 4 * parts > count.sum())
            out += [(part, None, None, None, None, None, w, n) for w, n in zip(word[top].view(np.int64).tolist(), count[top].tolist())]
        if order > 1:
            out += [(part, p, block, None, None, None, None, None) for p, block in deal(found.shorter(), words, parts, heavy)]
        found = pd.DataFrame(out, columns=[f.split()[0] for f in MERGED.split(", ")])
        return found.astype({"next": "Int32", "word": "Int64", "seen": "Int64"})

    # By the number itself: hashes of so few numbers would meet in one task.
    dealt = blocks.repartitionById(parts, F.col("part")).groupBy("part")
    return stored(dealt.applyInPandas(run, MERGED), f"ngrams-{order}")


def _write(path: str, array: np.ndarray) -> None:
    with open_new(path) as f:
        f.write(array.tobytes())


def _write_hashes(prefix: str, kind: str, hashes: np.ndarray, whole: bool) -> None:
    """Sorted hashes. Of many the first 16 bits are left out: an index has where each value of them begins; the next 32 and the last 16 bits are an array each."""
    many = len(hashes) >= MANY and not whole
    starts = np.searchsorted(hashes, np.arange(1 << 16, dtype=U) << U(48)) if many else np.zeros(0, np.int64)
    _write(f"{prefix}.{kind}-index", np.append(starts, len(hashes)).astype("<i4") if many else starts)
    if many:
        _write(f"{prefix}.{kind}-middle", (hashes >> U(16)).astype("<u4"))
        _write(f"{prefix}.{kind}-low", hashes.astype("<u2"))
    else:
        _write(f"{prefix}.{kind}", hashes)


def _write_small(prefix: str, kind: str, numbers: np.ndarray) -> None:
    """One byte each; 255 stands for the larger ones, which are listed with their places."""
    _write(f"{prefix}.{kind}", np.minimum(numbers, 255).astype("u1"))
    large = np.flatnonzero(numbers >= 255)
    _write(f"{prefix}.{kind}-large", large.astype("<i8"))
    _write(f"{prefix}.{kind}-exact", numbers[large].astype("<i8"))


def _write_facts(prefix: str, facts: np.ndarray) -> None:
    """One byte a context: its place among the 255 commonest rows of facts, sorted; 255 stands for the others, which are listed with their places."""
    small = np.flatnonzero(facts[:, 0] < 1 << 16)  # the total, so all four
    key = np.full(len(facts), ~U(0), U)
    key[small] = facts[small].astype(U) @ np.array([1 << 48, 1 << 32, 1 << 16, 1], U)
    found = np.sort(key[small])
    at = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
    often = np.argsort(-np.diff(np.append(at, len(found))), kind="stable")[:255]
    common = np.sort(found[at[often]])
    code = np.searchsorted(common, key)
    code[np.append(common, ~U(0))[code] != key] = 255
    code[facts[:, 0] >= 1 << 16] = 255
    _write(prefix + ".facts", code.astype("u1"))
    _write(prefix + ".facts-common", (common[:, None] >> np.array([48, 32, 16, 0], U) & U(0xFFFF)).astype("<i8"))
    rare = np.flatnonzero(code == 255)
    _write(prefix + ".facts-large", rare.astype("<i8"))
    _write(prefix + ".facts-exact", facts[rare].astype("<i8"))


def _counts(files: Files, at: np.ndarray) -> np.ndarray:
    n = files["counts"][at].astype(np.int64)
    large = np.flatnonzero(n == 255)
    if len(large):
        n[large] = files["counts-exact"][np.searchsorted(files["counts-large"], at[large])]
    return n


def _facts(files: Files, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Facts of the contexts at some places, each row multiplied with ``of``."""
    code = files["facts"][at]
    out = np.zeros((256, of.shape[1]))
    common = files["facts-common"].reshape(-1, 4)
    out[: len(common)] = common @ of
    out = out[code]
    large = np.flatnonzero(code == 255)
    if len(large):
        out[large] = files["facts-exact"].reshape(-1, 4)[np.searchsorted(files["facts-large"], at[large])] @ of
    return out


# ---- the model ------------------------------------------------------------------------------


@dataclass
class Level:
    """One order: where its arrays are, its discounts, and the facts of spread contexts."""

    prefixes: dict[int, str]
    entries: int
    total: int
    discounts: tuple[float, float, float]
    shared: np.ndarray
    shared_facts: np.ndarray
    sizes: dict[int, int]

    def vocabulary(self, parts: int) -> Vocabulary:
        """Of raw counts, each partition's entries are its words."""
        return Vocabulary(self.prefixes, np.cumsum([0, *(self.sizes.get(p, 0) for p in range(parts))]).astype(U))

    def find(self, ctx, word, spread, parts):
        """Count of each (context, word), 0 when unknown."""
        out = np.zeros(len(word), np.int64)
        key = pair_key(ctx, word)
        for p, at in _by_part(_part(np.where(spread, key, ctx), parts)):
            if p in self.prefixes:
                files = _files(self.prefixes[p])
                where, ok = _search(files, "keys", key[at])
                out[at[ok]] = _counts(files, where[ok])
        return out

    def weights(self, ctx, spread, parts):
        """(sum of the counts, sum of the discounts) of each context; zeros when unknown."""
        of = np.zeros((4, 2))
        of[0, 0], of[1:, 1] = 1, self.discounts
        out = np.zeros((len(ctx), 2))
        if len(self.shared) and spread.any():
            at = np.flatnonzero(spread)
            where, ok = _place(self.shared, ctx[at])
            out[at[ok]] = (self.shared_facts @ of)[where[ok]]
        own = np.flatnonzero(~spread)
        for p, some in _by_part(_part(ctx[own], parts)):
            if p in self.prefixes:
                files = _files(self.prefixes[p])
                rows = own[some]
                where, ok = _search(files, "contexts", ctx[rows])
                out[rows[ok]] = _facts(files, where[ok], of)
        return out.T


def _by_part(part: np.ndarray):
    """Indexes of each part, in order."""
    order = np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")
    part = part[order]
    bounds = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)]
    for low, high in zip(bounds, np.append(bounds[1:], len(part))):
        yield int(part[low]), order[low:high]


def _place(array: np.ndarray, keys: np.ndarray):
    """Where each key is in a sorted array, and whether it is there."""
    if not len(array):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    where = np.minimum(np.searchsorted(array, keys), len(array) - 1)
    return where, array[where] == keys


def _search(files: Files, kind: str, keys: np.ndarray):
    """The same in a file of hashes. Hashes are even, so that few share their first bits: all ranges are halved together."""
    index = files[f"{kind}-index"]
    if not len(index):
        return _place(files[kind], keys)
    middle, last = files[f"{kind}-middle"], files[f"{kind}-low"]
    bucket, want, tail = (keys >> U(48)).astype(np.int64), (keys >> U(16)).astype(np.uint32), keys.astype(np.uint16)
    start, end = index.take(bucket), index.take(bucket + 1)
    where = start - np.int32(1)  # the last that is smaller
    for k in range(int((end - start).max(initial=0)).bit_length())[::-1]:
        at = where + np.int32(1 << k)
        where += ((middle.take(at, mode="clip") < want) & (at < end)).astype(np.int32) << np.int32(k)
    where += np.int32(1)
    same = (middle.take(where, mode="clip") == want) & (where < end)
    ok = same & (last.take(where, mode="clip") == tail)
    some = np.flatnonzero(same & ~ok)
    while len(some):  # hashes that differ in their last bits alone
        where[some] += np.int32(1)
        at = where[some]
        some = some[(at < end[some]) & (middle.take(at, mode="clip") == want[some])]
        ok[some] = last[where[some]] == tail[some]
        some = some[~ok[some]]
    return where, ok


TYPES = {"keys": "<u8", "contexts": "<u8", "counts": "u1", "facts": "u1", "index": "<i4", "middle": "<u4", "low": "<u2"}


class Files(dict):
    """The arrays of one partition, each mapped when it is first read."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def __missing__(self, kind: str) -> np.ndarray:
        dtype = TYPES.get(kind) or TYPES.get(kind.split("-")[1], "<i8")
        self[kind] = np.asarray(mapped(f"{self.prefix}.{kind}", dtype))
        return self[kind]


@functools.lru_cache(maxsize=4096)
def _files(prefix: str) -> Files:
    return Files(prefix)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more; 1/2 where the counts of counts are too few to tell.

    At least 0.1: a discount of 0 would leave nothing for words that a context has not seen.
    """
    if not (n1 and n2 and n3):
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1), float(k)) for k, d in enumerate(raw, 1))


def _level(merged: DataFrame) -> Level:
    rows = merged.where("prefix is not null").select("part", "prefix", "sums", "spread").collect()  # one a partition
    sums = np.array([r.sums for r in rows]).sum(axis=0) if rows else np.zeros(6, np.int64)
    shared = np.concatenate([np.array(r.spread, np.int64).reshape(-1, 5) for r in rows] or [np.zeros((0, 5), np.int64)])
    names, at = np.unique(shared[:, 0].view(U) if len(shared) else np.zeros(0, U), return_inverse=True)
    facts = np.zeros((len(names), 4), np.int64)
    np.add.at(facts, at, shared[:, 1:])
    sizes = {r.part: r.sums[0] for r in rows}
    return Level({r.part: r.prefix for r in rows}, int(sums[0]), int(sums[1]), discounts(*map(int, sums[2:])), names, facts, sizes)


class KneserNey:
    def __init__(self, order: int, parts: int, raw: Level, levels: list[Level], heavy: np.ndarray):
        self.order, self.parts, self.raw, self.levels, self.heavy = order, parts, raw, levels, heavy

    def token_scores(self, part):
        """(text of each token, its training count, log10 probability) of a piece of texts."""
        stream, text, at = tokens(part, self.order)
        names, place = np.unique(stream, return_inverse=True)
        zero, one = np.zeros(len(names), U), np.ones(len(names), bool)
        word, last = stream[at], place[at]
        probability = np.full(len(at), 1 / (self.raw.entries + 1))
        for k, (level, (ctx, spread)) in enumerate(zip(self.levels, contexts(stream, at, self.order, self.heavy)), 1):
            # Words alone, as what is predicted or as contexts, are looked up once each.
            count = level.find(ctx, word, spread, self.parts) if k > 1 else level.find(zero, names, one, self.parts)[last]
            if k > 2:
                total, left = level.weights(ctx, spread, self.parts)
            else:
                which = place[at - 1] if k == 2 else np.zeros(len(at), np.int64)
                some = np.zeros(len(names), np.int64)
                some[which] = np.arange(len(at))  # one place of each context
                some = some[: which.max(initial=-1) + 1]
                total, left = level.weights(ctx[some], spread[some], self.parts)[:, which]
            cut = np.maximum(count - np.array([0.0, *level.discounts])[np.minimum(count, 3)], 0)
            known = total > 0
            probability[known] = (cut[known] + left[known] * probability[known]) / total[known]
        count = self.raw.find(zero, names, one, self.parts)[last]
        return text[at], count, np.log10(probability)

    def text_scores(self, texts: pa.Array) -> pa.Array:
        n, v = self.raw.total, self.raw.entries
        columns = [[], [], [], []]
        for part in pieces(texts, 2 << 20):
            text, count, score = self.token_scores(part)
            base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
            for column, weights in zip(columns, (None, (count > 0).astype(float), base, score)):
                column.append(np.bincount(text, weights, len(part)))
        joined = [np.concatenate(c) if c else np.zeros(0) for c in columns]
        arrays = [pa.array(x.astype(np.int64)) for x in joined[:2]] + [pa.array(np.full(len(texts), n, np.int64))] + [pa.array(x) for x in joined[2:]]
        return pa.StructArray.from_arrays(arrays, SCORES.names)

    def score(self, text: str | Column) -> Column:
        """Struct of n_tokens, n_known, train_tokens, base_score and score; perplexity is 10^(-score / n_tokens)."""

        @F.arrow_udf(SCORES)
        def run(texts: pa.Array) -> pa.Array:
            return self.text_scores(texts)

        return run(text)


SCORES = T.StructType().add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")


def fit(docs: DataFrame, order: int = 3) -> KneserNey:
    """Count all texts of ``docs``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    folder = scratch(spark, "ngram-arrays")
    nothing = np.array([BEGIN], U)
    counted = merge(count_blocks(docs, 1, parts, nothing), folder + "/raw", 1, parts, nothing, often=True)
    raw = _level(counted)
    # At most 4 * parts words hold more than a quarter of a partition's share.
    often = [r.word for r in counted.where(F.col("seen") > raw.total // (4 * parts)).select("word").collect()]
    heavy = np.unique(np.append(np.array(often, np.int64).view(U), BEGIN))
    vocabulary = raw.vocabulary(parts)
    levels, blocks = [], count_blocks(docs, order, parts, heavy, vocabulary)
    for k in range(order, 0, -1):
        merged = merge(blocks, folder, k, parts, heavy, vocabulary)
        levels.insert(0, _level(merged))
        blocks = merged.where("next is not null").select(F.col("next").alias("part"), "block")
    return KneserNey(order, parts, raw, levels, heavy)


def report(docs: DataFrame, held_out: Column, order: int = 3) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), learned from the rows not held out."""
    model = fit(docs.where(~held_out), order)
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score("text").alias("s"))
    return scored.select("doc_id", "held_out", "s.*")
