"""Benchmark decontamination by a prefix-filtered join of documents with item windows.

A window is ``window`` consecutive words of an item; a shorter item is one window. Its tokens are shingles of ``shingle``
words. Containment of a whole window needs every token, so one token is a sufficient prefix: the rarest by its
number of documents. Documents are searched for prefix tokens; the token's place in the window bounds where the
window may start, the text's length whether it fits, and all its words are then compared (as 64-bit hashes each).

The benchmark goes to the executors in blocks of at most ``block`` windows, one pass over the documents each;
most benchmarks are one block. Defined results: null texts have no words; items without id or words are ignored;
rows that repeat a doc_id are judged row by row; other columns are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import stored
from textloom.llm.words import ALNUM, U, HashSet, Words, find_words, pieces, runs_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Names that no column of a user is likely to have.
N, RANGES, ITEMS = "_hit_n_words", "_hit_ranges", "_hit_items"
HITS = T.StructType().add(N, "long").add(RANGES, T.ArrayType(T.IntegerType())).add(ITEMS, T.ArrayType(T.StringType()))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, words): every window of every item, once each."""
    lowered = F.translate(F.col("text"), ascii_uppercase, ascii_lowercase)
    words = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("w")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    at = words.where(F.size("w") > 0).select("item", "w", F.explode(starts).alias("s"))
    return at.select("item", F.slice("w", F.col("s") + 1, window).alias("words")).distinct()


class Windows:
    """One block of windows: word hashes, tokens, and after ``choose`` the prefix index."""

    def __init__(self, rows: list, shingle: int):
        self.items = [r.item for r in rows]
        self.hashes = [_hash_words(r.words) for r in rows]
        self.shingle = shingle
        self.tokens = [self._tokens(h) for h in self.hashes]
        self.sizes = sorted({min(shingle, len(h)) for h in self.hashes})
        self.all = HashSet(np.concatenate(self.tokens) if rows else np.zeros(0, U))

    def _tokens(self, hashes):
        none = np.zeros(0, np.int64)
        words = Words(none, none, np.zeros(len(hashes), np.int64), hashes)
        return runs_of(words, min(self.shingle, len(hashes)))[0]

    def found(self, words: Words):
        """(word index, token number) of every token of the block in these words."""
        at, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in self.sizes:
            hashes, start = runs_of(words, size)
            place, token = self.all.find(hashes)
            at.append(start[place])
            which.append(token)
        return np.concatenate(at), np.concatenate(which)

    def choose(self, documents: np.ndarray) -> None:
        """Index each window by its rarest token; documents: their number for each token."""
        token = [np.searchsorted(self.all.sorted, t) for t in self.tokens]
        place = [int(np.lexsort((t, documents[t]))[0]) for t in token]
        key = np.array([t[p] for t, p in zip(token, place)], np.int64)
        order = np.argsort(key, kind="stable")
        self.window, self.place = order, np.array(place, np.int64)[order]
        self.first = np.searchsorted(key[order], np.arange(len(self.all.sorted) + 1))
        self.length = np.array([len(h) for h in self.hashes], np.int64)
        self.matrix = np.zeros((len(self.hashes), int(self.length.max(initial=1))), U)
        for row, h in enumerate(self.hashes):
            self.matrix[row, : len(h)] = h

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence."""
        at, token = self.found(words)
        many = self.first[token + 1] - self.first[token]
        entry = np.repeat(self.first[token], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window = self.window[entry]
        start = np.repeat(at, many) - self.place[entry]
        end = start + self.length[window]
        ok = (start >= 0) & (end <= len(words.hashes))
        start, end, window = start[ok], end[ok], window[ok]
        ok = words.text[start] == words.text[end - 1]
        start, window = start[ok], window[ok]
        for column in range(self.matrix.shape[1]):
            inside = column < self.length[window]
            same = words.hashes[np.minimum(start + column, len(words.hashes) - 1)] == self.matrix[window, column]
            start, window = start[same | ~inside], window[same | ~inside]
        return start, window


def _hash_words(words: list[str]) -> np.ndarray:
    part = next(pieces(pa.array([" ".join(words)])))
    return find_words(part, ALNUM).hashes


def _document_counts(docs: DataFrame, block) -> np.ndarray:
    """Number of documents of each token of the block, counted over all documents."""

    def run(batches):
        for batch in batches:
            total = np.zeros(len(block.value.all.sorted), np.int64)
            for part in pieces(batch.column("text")):
                words = find_words(part, ALNUM)
                at, token = block.value.found(words)
                pairs = np.unique(words.text[at] * len(total) + token) if len(at) else np.zeros(0, np.int64)
                total += np.bincount(pairs % max(1, len(total)), minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["token", "n"])

    counts = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    out = np.zeros(len(block.value.all.sorted), np.int64)
    for row in counts.toLocalIterator():  # at most one row for each token of the block
        out[row.token] = row.n
    return out


def _merged(ranges: list[tuple[int, int]]) -> list[int]:
    """Union of ranges, flat: begin, end, begin, end, ..."""
    out: list[int] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1]:
            out[-1] = max(out[-1], high)
        else:
            out += [low, high]
    return out


def _search(docs: DataFrame, block, keep_text: bool) -> DataFrame:
    """One pass: adds the block's hits to the ranges and items that earlier blocks found."""
    names = [c for c in docs.columns if c not in HITS.names and (keep_text or c != "text")]
    schema = T.StructType([*(docs.schema[c] for c in names), *HITS.fields])

    def run(batches):
        for batch in batches:
            before = {c: batch.column(c) for c in (RANGES, ITEMS) if c in batch.schema.names}
            for part in pieces(batch.column("text")):
                words = find_words(part, ALNUM)
                start, window = block.value.matches(words)
                base = np.searchsorted(words.text, np.arange(len(part)))
                found: dict[int, tuple[list, set]] = {}
                for s, w in zip(start.tolist(), window.tolist()):
                    text = int(words.text[s])
                    low = s - int(base[text])
                    ranges, items = found.setdefault(text, ([], set()))
                    ranges.append((low, low + int(block.value.length[w])))
                    items.add(block.value.items[w])
                ranges, items = [], []
                for text in range(len(part)):
                    r, i = found.get(text, ([], set()))
                    if before:
                        old = before[RANGES][part.first + text].as_py()
                        r = r + list(zip(old[::2], old[1::2]))
                        i = i | set(before[ITEMS][part.first + text].as_py())
                    ranges.append(_merged(r) if r else [])
                    items.append(sorted(i))
                rows = [batch.column(c).slice(part.first, len(part)) for c in names]
                n = np.bincount(words.text, minlength=len(part))
                more = [pa.array(n, pa.int64()), pa.array(ranges, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*rows, *more], [*names, *HITS.names])

    return docs.mapInArrow(run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, block: int = 200_000, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` and the columns of HITS: words, hit word ranges (flat), ids of items sorted as strings, of every row."""
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, window), "windows")
    blocks = max(1, -(-windows.count() // block))
    found = docs.select(*dict.fromkeys([*keep, "text"]))
    for b in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b)
        part = Windows(own.collect(), shingle)  # ``block`` rows on average
        part.choose(_document_counts(docs, spark.sparkContext.broadcast(part)))
        last = b == blocks - 1
        found = _search(found, spark.sparkContext.broadcast(part), keep_text=not last or "text" in keep)
        if not last:
            found = stored(found, "hits")
    return found


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``."""
    found = contamination(docs, benchmark, **options)
    # Ends are at odd places: alternate signs sum to the lengths.
    signed = F.transform(RANGES, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", F.col(N).alias("n_words"), n_hit.alias("n_hit"), F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(ITEMS, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(RANGES) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their columns."""
    found = contamination(docs, benchmark, keep=tuple(docs.columns), **options)
    return found.where(F.size(RANGES) == 0).select(*docs.columns)
