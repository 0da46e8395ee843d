"""Word segmentation by a lattice: a unigram model of words and phrases, fitted by EM, and the best path through each text.

A text is a row of words. Every phrase of the model that occurs in it is an edge over its words, every word an edge of
its own; a path is a segmentation, and its cost is the sum of its pieces' costs (-1000 ln p, in whole numbers, so that ties are
ties everywhere). Places that no phrase spans cut the lattice into independent stretches. The stretches of a batch are
walked side by side, so the number of vector steps is the longest stretch, not the longest text.

* Candidates: pairs of neighbouring words that PMI finds cohesive, and longer runs in which every pair is one.
* EM: the forward-backward sums of a batch give the expected count of each piece; Spark adds them up over the corpus.
  Phrases whose expected count falls below ``min_expected`` leave the model.
* Edges are found with a prefix tree of the phrases, kept as sorted arrays: a place is followed only as long as its words
  begin some phrase.

The model holds all words and phrases, or the commonest ``max_words`` words and ``max_phrases`` phrases of each length where
the caller sets a bound (by count, ties by the phrase); words beyond it cost as much as a piece seen half a time. Only
phrases and the words in them are sent to the tasks: a word of no phrase is a stretch of its own wherever it occurs, so its
expected count is its count, and it stays in a table. Null texts stay null, empty texts stay empty; an empty corpus gives a model without phrases.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions.profile import tokens
from textloom.operators.phrases import gram_counts, pairs_by_pmi
from textloom.session import materialize

SCALE = 1000
RARE = 0.5


def cost_of(expected: Column, total: float | Column) -> Column:
    """Whole-number cost of a piece; those seen less than RARE times count as RARE."""
    return F.round(-SCALE * F.log(F.greatest(expected, F.lit(RARE)) / total)).cast("long")


class Lattice:
    """The pieces of a model as a prefix tree over word numbers, and the sums over all paths."""

    def __init__(self, pieces: pa.Array | pa.ChunkedArray | list[str], costs: np.ndarray, unknown: int):
        pieces = pa.array(pieces, pa.string()) if isinstance(pieces, list) else pieces
        self.n_pieces = len(pieces)
        self.costs = np.append(np.asarray(costs, np.int64), unknown)  # the last one: words without a piece
        # Words as numbers, piece after piece: no string or list of Python's for any of them.
        chunks = pieces.chunks if isinstance(pieces, pa.ChunkedArray) else [pieces]
        distinct = [pc.unique(pc.split_pattern(c, " ").flatten()) for c in chunks if len(c)]
        found = pc.unique(pa.concat_arrays(distinct)) if distinct else pa.array([], pa.string())
        self.vocabulary = found.take(pc.sort_indices(found))
        self.size = size = max(1, len(self.vocabulary))
        parts = [pc.split_pattern(c, " ") for c in chunks if len(c)]
        lengths = np.concatenate([pc.list_value_length(x).to_numpy() for x in parts] or [np.zeros(0, np.int32)])
        ids = np.concatenate([pc.index_in(x.flatten(), self.vocabulary).to_numpy() for x in parts] or [np.zeros(0, np.int32)])
        del parts
        first = np.cumsum(lengths, dtype=np.int64) - lengths
        self.longest = int(lengths.max(initial=1))
        # levels[k]: sorted keys node * size + word of the prefixes of k + 1 words, and the piece that ends there.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at, node = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        for depth in range(self.longest):
            inside = lengths[at] > depth
            at, node = at[inside], node[inside]
            level, node = np.unique(node * size + ids[first[at] + depth], return_inverse=True)
            piece = np.full(len(level), -1, np.int32)
            ends = lengths[at] == depth + 1
            piece[node[ends]] = at[ends]
            self.levels.append((level, piece))

    def _child(self, depth: int, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        level = self.levels[depth][0]
        if not len(level):
            return np.full(len(node), -1, np.int64)
        key = node * self.size + word
        at = np.minimum(np.searchsorted(level, key), len(level) - 1)
        return np.where((level[at] == key) & (word >= 0), at, -1)

    def edges(self, words: pa.Array, texts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For pieces of 1, 2, ... words: where they start and which they are. ``texts`` numbers the text of each word."""
        coded = pc.dictionary_encode(words)
        known = pc.fill_null(pc.index_in(coded.dictionary, self.vocabulary), -1).to_numpy()
        ids = known.astype(np.int64)[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        start = np.arange(len(ids))
        node = self._child(0, np.zeros(len(ids), np.int64), ids) if self.levels else np.full(len(ids), -1, np.int64)
        single = np.where(node >= 0, self.levels[0][1][node] if self.levels and len(self.levels[0][1]) else -1, -1)
        out = [(start, np.where(single >= 0, single, self.n_pieces))]
        for depth in range(1, self.longest):
            inside = (node >= 0) & (start + depth < len(ids))
            start, node = start[inside], node[inside]
            inside = texts[start] == texts[start + depth]
            start, node = start[inside], node[inside]
            node = self._child(depth, node, ids[start + depth])
            start, node = start[node >= 0], node[node >= 0]
            piece = self.levels[depth][1][node].astype(np.int64)
            out.append((start[piece >= 0], piece[piece >= 0]))
        return out


class Stretches:
    """Independent stretches of the lattice of some texts, longest first."""

    def __init__(self, lattice: Lattice, words: pa.Array, texts: np.ndarray):
        self.lattice, self.n = lattice, len(words)
        self.edges = lattice.edges(words, texts)
        spanned = np.zeros(self.n + 1, np.int64)
        for n, (start, _) in enumerate(self.edges[1:], 2):
            np.add.at(spanned, start + 1, 1)
            np.add.at(spanned, start + n, -1)
        begin = np.flatnonzero(np.cumsum(spanned[: self.n]) == 0)
        length = np.diff(np.append(begin, self.n))
        order = np.argsort(-length, kind="stable")
        self.begin, self.length = begin[order], length[order]
        self.first = np.zeros(self.n, np.int64)  # begin of the stretch of each word
        self.first[:] = np.repeat(begin, length)
        # piece_at[n][j]: the piece of n + 1 words that ends with word j, or -1.
        self.piece_at = np.full((len(self.edges), self.n), -1, np.int64)
        for n, (start, piece) in enumerate(self.edges):
            self.piece_at[n, start + n] = piece

    def _steps(self):
        """(how many of the longest stretches have a word at this step, step)."""
        longest = int(self.length[0]) if len(self.length) else 0
        count = np.searchsorted(-self.length, -np.arange(1, longest + 1), "right")
        return zip(count.tolist(), range(longest))

    def expected(self) -> np.ndarray:
        """Expected number of each piece over all paths, weighted by their probabilities."""
        log_p = -self.lattice.costs / SCALE
        at = np.where(self.piece_at >= 0, log_p[self.piece_at], -np.inf)
        ahead = np.zeros(self.n)  # log sum over the paths up to and with word j
        for some, t in self._steps():
            j = self.begin[:some] + t
            total = np.full(some, -np.inf)
            for n in range(1, min(len(at), t + 1) + 1):
                total = np.logaddexp(total, at[n - 1, j] + (ahead[j - n] if t >= n else 0.0))
            ahead[j] = total
        behind = np.zeros(self.n)  # log sum over the paths after word j
        last = self.begin + self.length - 1
        for some, t in self._steps():
            if t == 0:
                continue
            j = last[:some] - t
            total = np.full(some, -np.inf)
            for n in range(1, min(len(at), t) + 1):
                total = np.logaddexp(total, at[n - 1, j + n] + behind[j + n])
            behind[j] = total
        whole = np.zeros(self.n)
        whole[self.begin] = ahead[last]
        out = np.zeros(len(log_p))
        for n, (start, piece) in enumerate(self.edges, 1):
            before = np.where(start == self.first[start], 0.0, ahead[start - 1]) if len(start) else np.zeros(0)
            share = np.exp(before + log_p[piece] + behind[start + n - 1] - whole[self.first[start]])
            out += np.bincount(piece, share, len(out))
        return out[:-1]

    def piece_starts(self) -> np.ndarray:
        """Which words begin a piece of the cheapest path; of equal paths the one whose last pieces are longer."""
        far = np.iinfo(np.int64).max // 4
        at = np.where(self.piece_at >= 0, self.lattice.costs[self.piece_at], far)
        best, back = np.zeros(self.n, np.int64), np.ones(self.n, np.int64)
        for some, t in self._steps():
            j = self.begin[:some] + t
            total = np.full(some, far)
            for n in range(1, min(len(at), t + 1) + 1):
                value = at[n - 1, j] + (best[j - n] if t >= n else 0)
                better = (value <= total) & (at[n - 1, j] < far)
                total = np.where(better, value, total)
                back[j] = np.where(better, n, back[j])
            best[j] = total
        starts = np.zeros(self.n, bool)
        at, first = self.begin + self.length - 1, self.begin
        while len(at):
            at = at - back[at]
            starts[at + 1] = True
            left = at >= first
            at, first = at[left], first[left]
        return starts


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of an array of word lists, and the number of the list of each."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return lists.flatten(), np.repeat(np.arange(len(lists)), sizes)


@dataclass(frozen=True)
class PhraseModel:
    """``pieces`` has (phrase, n_words, expected, cost) of every word and phrase; other words cost ``unknown``."""

    pieces: DataFrame
    unknown: int

    def edge_rows(self) -> DataFrame:
        """(phrase, cost) of the phrases and of the words in them: all that tasks need."""
        phrases = self.pieces.where("n_words > 1")
        inside = phrases.select(F.explode(F.split("phrase", " ")).alias("phrase")).distinct()
        words = self.pieces.where("n_words = 1").join(inside, "phrase", "left_semi")
        return phrases.select("phrase", "cost").unionByName(words.select("phrase", "cost"))

    def edges(self) -> pa.Table:
        """The rows of ``edge_rows``, by phrase."""
        return self.edge_rows().toArrow().sort_by("phrase")

    def lattice(self, edges: pa.Table | None = None) -> Lattice:
        edges = self.edge_rows().toArrow() if edges is None else edges
        return Lattice(edges["phrase"], edges["cost"].to_numpy(), self.unknown)

    def segment(self, docs: DataFrame, text: str = "text", words: Column | None = None) -> DataFrame:
        """``docs`` with the words of each piece joined by underscores and pieces by spaces.

        ``words`` is an array of the text's words; by default the text is split at spaces.
        """
        shared = docs.sparkSession.sparkContext.broadcast(self.lattice())

        def run(lists: pa.Array) -> pa.Array:
            words, owner = _flat(lists)
            starts = Stretches(shared.value, words, owner).piece_starts()
            between = np.where(starts, " ", "_").astype(object)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            ends = np.append(0, np.cumsum(sizes))
            between[ends[:-1][sizes > 0]] = ""
            glued = pc.binary_join_element_wise(pa.array(between, pa.string()), words, "")
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), glued), "")
            return pc.if_else(pc.is_null(lists), None, joined)

        listed = F.filter(F.split(F.col(text), " "), lambda w: w != "") if words is None else words
        return docs.withColumn(text, F.arrow_udf(run, StringType())(listed))

    def save(self, path: str) -> None:
        self.pieces.write.mode("overwrite").parquet(f"{path}/pieces")
        head = json.dumps({"unknown": self.unknown})
        self.pieces.sparkSession.range(1).select(F.lit(head).alias("value")).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PhraseModel":
        head = json.loads(spark.read.text(f"{path}/head").first()[0])
        return PhraseModel(spark.read.parquet(f"{path}/pieces"), head["unknown"])


def _run_counts(words: DataFrame, pairs: DataFrame, longest: int) -> DataFrame:
    """(gram, n) of the runs of 3 to ``longest`` words in which every two neighbours are a pair."""
    listed = pairs.select(F.concat_ws(" ", "first", "second").alias("pair")).toArrow()["pair"]
    shared = words.sparkSession.sparkContext.broadcast(Lattice(listed, np.zeros(len(listed)), 0))
    del listed

    def run(batches):
        for batch in batches:
            flat, owner = _flat(batch.column(0))
            edges = shared.value.edges(flat, owner)
            linked = np.zeros(len(flat) + 1, bool)
            if len(edges) > 1:
                linked[edges[1][0]] = True
            start = np.flatnonzero(linked)
            for n in range(3, longest + 1):
                start = start[linked[np.minimum(start + n - 2, len(flat))]]
                grams = pc.binary_join_element_wise(*(flat.take(pa.array(start + k)) for k in range(n)), " ")
                counted = pc.value_counts(grams)
                yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts").cast(pa.int64())], ["gram", "n"])

    return words.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _top(counts: DataFrame, limit: int | None) -> DataFrame:
    return counts if limit is None else counts.orderBy(F.desc("n"), "gram").limit(limit)


def fit_phrases(
    docs: DataFrame, text: str = "text", longest: int = 4, min_count: int = 5, min_pmi: float = 3.0, rounds: int = 2,
    min_expected: float = 3.0, max_words: int | None = None, max_phrases: int | None = None, words: Column | None = None,
) -> PhraseModel:
    """A model of the corpus' words and of phrases of 2 to ``longest`` words.

    ``words`` is an array of a text's words; by default its lower-cased runs of word characters.
    """
    listed = docs.select((tokens(F.col(text)) if words is None else words).alias("w"))
    counts = gram_counts(listed, F.col("w"), min_count)
    singles = counts.filter(~F.col("gram").contains(" "))
    total = float(singles.agg(F.sum("n")).first()[0] or 0)
    pairs = pairs_by_pmi(counts, min_count, min_pmi).select(F.concat_ws(" ", "first", "second").alias("gram"), F.col("n_pair").alias("n"))
    pairs = materialize(_top(pairs, max_phrases), "pairs")
    seeds = _top(singles, max_words).unionByName(pairs)
    if longest > 2:
        split = F.split("gram", " ")
        runs = _run_counts(listed, pairs.select(F.get(split, 0).alias("first"), F.get(split, 1).alias("second")), longest)
        runs = materialize(runs.filter(F.col("n") >= min_count).withColumn("n_words", F.size(F.split("gram", " "))), "runs")
        for n in range(3, longest + 1):
            seeds = seeds.unionByName(_top(runs.filter(F.col("n_words") == n).select("gram", "n"), max_phrases))
    pieces = seeds.select(
        F.col("gram").alias("phrase"), F.size(F.split("gram", " ")).alias("n_words"), F.col("n").cast("double").alias("expected")
    )
    if total == 0:
        return PhraseModel(pieces.withColumn("cost", F.lit(0).cast("long")), 0)
    seeds = materialize(pieces, "seeds")
    model = _model(seeds)
    for _ in range(rounds):
        model = _model(_expect(listed, model, seeds).filter((F.col("n_words") == 1) | (F.col("expected") >= min_expected)))
    return model


def _model(pieces: DataFrame) -> PhraseModel:
    """Costs from expected counts."""
    pieces = materialize(pieces, "pieces")
    total = pieces.agg(F.sum(F.greatest("expected", F.lit(RARE)))).first()[0]
    return PhraseModel(pieces.withColumn("cost", cost_of(F.col("expected"), F.lit(total))), round(-SCALE * math.log(RARE / total)))


def _expect(listed: DataFrame, model: PhraseModel, seeds: DataFrame) -> DataFrame:
    """The pieces with the expected counts that the texts give under the model, rounded to 6 decimals.

    Words outside the lattice have the count that ``seeds`` gives them, phrases that have left the model have null.
    """
    # Edges and their expected counts meet by number in Spark; the driver has a lattice and neither of them.
    numbered = materialize(model.edge_rows().withColumn("number", F.monotonically_increasing_id()), "edges")
    edges = numbered.toArrow()
    numbers = edges["number"].to_numpy()
    lattice = model.lattice(edges)
    del edges
    shared = listed.sparkSession.sparkContext.broadcast((lattice, numbers))
    n_pieces = lattice.n_pieces
    del lattice, numbers

    def run(batches):
        lattice, numbers = shared.value
        total = np.zeros(n_pieces)
        for batch in batches:
            total += Stretches(lattice, *_flat(batch.column(0))).expected()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(numbers[some]), pa.array(total[some])], ["number", "share"])

    sums = listed.mapInArrow(run, "number long, share double").groupBy("number").agg(F.sum("share").alias("share"))
    share = F.rint(F.coalesce("share", F.lit(0.0)) * 1e6) / 1e6
    found = numbered.join(sums, "number", "left").select("phrase", share.alias("share"))
    joined = seeds.join(found, "phrase", "left")
    alone = F.when(F.col("n_words") == 1, F.col("expected"))
    return joined.select("phrase", "n_words", F.coalesce("share", alone).alias("expected"))
