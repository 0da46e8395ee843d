"""A toxicity classifier that is regularised by counterfactuals.

Features of a text are its distinct words and word beginnings of ``PREFIXES`` bytes. Training takes at most
``max_rows`` labelled rows and ``max_bytes`` of text (those with the smallest hash of doc_id). Spark counts the features of toxic rows, then both
classes of the candidates; the ``max_features`` with the largest chi-square and all identity terms are kept. The
logistic loss has a penalty on the change of the logit when identity terms of a sentence are swapped for another
term of their group, so a group that is often insulted in the sample does not become toxic by its name.

Defined results: null and empty texts score as texts without features; without labels of both classes the score is
the share of toxic rows (0 when there are none); rows that repeat a doc_id are scored row by row; a document is toxic in
training if any of its labels says so; repeated rows teach once. Empty tables give empty results. Texts of any length
are read whole, in pieces. Other columns are not read by ``report`` and stay in ``accepted``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_sample
from textloom.llm.words import ALNUM, PIECE, U, HashSet, find_words, pieces, prefixes

PREFIXES = (4, 5, 6)

# Group names by kind, language and number; a counterfactual swaps a term for one of the same list. A term is in one list
# only: forms that are alike (mädchen; french; muslim) stand in the first. Fixed values.
IDENTITY_TERMS = (
    "women men girls boys".split(),
    "woman man girl boy".split(),
    "muslims christians jews hindus buddhists atheists".split(),
    "muslim christian jewish hindu buddhist atheist jew".split(),
    "black white asian latino african arab".split(),
    "gay lesbian bisexual transgender straight".split(),
    "immigrants refugees foreigners natives".split(),
    "immigrant refugee foreigner native".split(),
    "disabled blind deaf autistic".split(),
    "mexicans americans germans french chinese indians".split(),
    "mexican american german indian".split(),
    "femmes hommes filles garçons".split(),
    "femme homme fille garçon".split(),
    "musulmans chrétiens juifs athées".split(),
    "musulman chrétien juif athée".split(),
    "musulmane chrétienne juive".split(),
    "frauen männer mädchen jungen".split(),
    "frau mann junge".split(),
    "muslime christen juden atheisten".split(),
    "christ jude".split(),
    "muslima christin jüdin atheistin".split(),
    "mujeres hombres niñas niños".split(),
    "mujer hombre niña niño".split(),
    "musulmanes cristianos judíos ateos".split(),
    "musulmán cristiano judío ateo".split(),
    "musulmana cristiana judía atea".split(),
)


def text_features(array: pa.Array):
    """(first row, rows, row of each feature, feature hash) for pieces of an array of texts, each once a text."""
    for part in pieces(array, PIECE // 4):
        words = find_words(part, ALNUM)
        rows, hashes = [words.text], [words.hashes]
        for size in PREFIXES:
            found, at = prefixes(part, words, size)
            rows.append(words.text[at])
            hashes.append(found)
        yield part.first, len(part), np.concatenate(rows), np.concatenate(hashes)


def _chosen(array: pa.Array, known: HashSet):
    """(first row, rows, row, feature number) of the known features, each once a text."""
    for first, n, rows, hashes in text_features(array):
        at, which = known.find(hashes)
        pairs = np.unique(rows[at] * len(known.sorted) + which)
        yield first, n, pairs // max(1, len(known.sorted)), pairs % max(1, len(known.sorted))


def _term_hashes(term: str) -> np.ndarray:
    return np.concatenate([h for _, _, _, h in text_features(pa.array([term]))])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int) -> DataFrame:
    """(text, label) of a bounded sample of the labelled rows; a document that any of its labels calls toxic is toxic.

    The ids are bounded first, so that their list is broadcast and no text is shuffled but the sample's; then the rows are.
    """
    wanted = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    known = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    return bounded_sample(known, max_rows, max_bytes).select("text", "label")


def _toxic_features(rows: DataFrame, min_rows: int, limit: int) -> np.ndarray:
    def run(batches):
        for batch in batches:
            for _, n, owner, hashes in text_features(batch.column("text")):
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
                unique, counts = np.unique(hashes[fresh], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(counts)], ["h", "n"])

    counts = rows.where("label = 1").select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= min_rows).orderBy(F.desc("n"), "h").limit(limit)
    return np.array([r.h for r in top.select("h").collect()], np.int64).view(U)


def _class_counts(rows: DataFrame, known: HashSet) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each class, and rows of each class that hold each known feature."""

    def run(batches):
        for batch in batches:
            label = np.asarray(batch.column("label").to_numpy(zero_copy_only=False), np.int64)
            total = np.zeros((2, len(known.sorted) + 1), np.int64)
            for first, n, row, feature in _chosen(batch.column("text"), known):
                np.add.at(total, (label[first + row], feature), 1)
            total[:, -1] = np.bincount(label, minlength=2)
            c, f = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(f), pa.array(total[c, f])], ["c", "f", "n"])

    summed = rows.mapInArrow(run, "c long, f long, n long").groupBy("c", "f").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((2, len(known.sorted) + 1), np.int64)
    for r in summed:  # two rows at most for each known feature
        out[r.c, r.f] = r.n
    return out[:, -1], out[:, :-1]


def fit_weights(rows, cols, labels, n_features, swaps, penalty: float, l2: float, steps: int = 800):
    """Adam on the mean logistic loss, L2, and the mean squared change of the logit under each swap.

    rows, cols: sparse 0/1 matrix. swaps: (row, column, sign) of the differences between a row and its counterfactual.
    """
    w = np.zeros(n_features + 1)
    w[-1] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    m, v = np.zeros_like(w), np.zeros_like(w)
    s_row, s_col, s_sign = swaps
    for t in range(1, steps + 1):
        logit = np.bincount(rows, w[cols], len(labels)) + w[-1]
        error = (1 / (1 + np.exp(-logit)) - labels) / len(labels)
        grad = np.append(np.bincount(cols, error[rows], n_features) + l2 * w[:-1], error.sum())
        if len(s_row):
            change = np.bincount(s_row, s_sign * w[s_col], len(labels))
            grad[:-1] += 2 * penalty / len(labels) * np.bincount(s_col, s_sign * change[s_row], n_features)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], w[-1]


class ToxicityModel:
    def __init__(self, known: HashSet, weights: np.ndarray, bias: float):
        self.known, self.weights, self.bias = known, weights, bias

    def scores(self, array: pa.Array) -> np.ndarray:
        out = np.full(len(array), self.bias)
        for first, n, row, feature in _chosen(array, self.known):
            out[first : first + n] += np.bincount(row, self.weights[feature], n)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))

    def score(self, text: str | Column) -> Column:
        """A column of scores from 0 to 1, computed in Arrow batches."""

        @F.arrow_udf("double")
        def run(texts: pa.Array) -> pa.Array:
            return pa.array(self.scores(texts))

        return run(text)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 20_000, max_bytes: int = 1 << 28, max_features: int = 2048,
    min_rows: int = 5, penalty: float = 1.0, l2: float = 1e-6, identity: tuple = IDENTITY_TERMS,
) -> ToxicityModel:
    rows = training_rows(docs, labels, label, max_rows, max_bytes).persist()
    try:
        candidates = _toxic_features(rows, min_rows, 50 * max_features)
        terms = {t: _term_hashes(t) for group in identity for t in group}
        named = np.concatenate(list(terms.values())) if terms else np.zeros(0, U)
        known = HashSet(np.concatenate((candidates, named)))
        size, counts = _class_counts(rows, known)
        if not size.all():
            none = HashSet(np.zeros(0, U))
            share = size[1] / max(1, size.sum())
            return ToxicityModel(none, np.zeros(0), np.log(max(share, 1e-12) / max(1 - share, 1e-12)))
        share = counts / size[:, None]
        pooled = counts.sum(axis=0) / size.sum()
        chi = (share[1] - share[0]) ** 2 / np.maximum(pooled * (1 - pooled), 1e-12)
        best = np.argsort(-chi, kind="stable")[:max_features]
        known = HashSet(np.concatenate((known.sorted[best], named)))
        return _fit_known(rows, known, terms, identity, penalty, l2)
    finally:
        rows.unpersist()


def _fit_known(rows: DataFrame, known: HashSet, terms: dict, identity: tuple, penalty: float, l2: float) -> ToxicityModel:
    swap_of = {t: group[(i + 1) % len(group)] for group in identity for i, t in enumerate(group) if len(group) > 1}
    number = {t: known.find(h)[1] for t, h in terms.items()}
    named = HashSet(np.array([h[0] for h in terms.values()], U))
    by_word = {int(h[0]): t for t, h in terms.items()}

    def run(batches):
        for batch in batches:
            text, label = batch.column("text"), batch.column("label")
            features: list[list[int]] = [[] for _ in range(len(text))]
            present: list[list[str]] = [[] for _ in range(len(text))]
            for first, n, row, feature in _chosen(text, known):
                for r, f in zip(row.tolist(), feature.tolist()):
                    features[first + r].append(f)
            for first, n, row, which in _chosen(text, named):
                for r, k in zip(row.tolist(), which.tolist()):
                    present[first + r].append(by_word[int(named.sorted[k])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(features, pa.list_(pa.int32())), pa.array(present, pa.list_(pa.string())), label.cast(pa.int32())],
                ["features", "terms", "label"],
            )

    got = rows.mapInArrow(run, "features array<int>, terms array<string>, label int").toPandas()  # max_rows at most
    order = np.lexsort((got["label"], got["features"].map(lambda f: bytes(np.asarray(f, np.int32)))))
    got = got.iloc[order].reset_index(drop=True)  # one order, whatever the partitions were
    lengths = got["features"].map(len).to_numpy()
    row = np.repeat(np.arange(len(got)), lengths)
    col = np.concatenate([np.asarray(f, np.int64) for f in got["features"]]) if lengths.sum() else np.zeros(0, np.int64)
    s_row, s_col, s_sign = [], [], []
    for r, (features, present) in enumerate(zip(got["features"], got["terms"])):
        mine = set(map(int, features))
        swapped = mine.copy()
        for term in present:
            swapped -= set(map(int, number[term]))
        for term in present:
            swapped |= set(map(int, number[swap_of.get(term, term)]))
        for f in mine ^ swapped:
            s_row.append(r)
            s_col.append(f)
            s_sign.append(1.0 if f in mine else -1.0)
    swaps = np.array(s_row, np.int64), np.array(s_col, np.int64), np.array(s_sign)
    weights, bias = fit_weights(row, col, got["label"].to_numpy(float), len(known.sorted), swaps, penalty, l2)
    return ToxicityModel(known, weights, float(bias))


def report(docs: DataFrame, model: ToxicityModel, held_out: Column, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The documents below the threshold, with their columns."""
    return docs.where(model.score("text") < threshold)
