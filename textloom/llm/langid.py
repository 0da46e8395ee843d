"""Language identification by a byte convolutional network, trained and applied in numpy.

The network reads windows of ``WINDOW`` bytes (A-Z lowered, digits as one byte, the last window filled with blanks). Filters of
several widths over one-hot bytes are tables of 256 rows, so a convolution is a sum of table rows; the maximum
over the window passes tanh and a softmax. A text's prediction averages the probabilities of all its windows by their letters.

Training takes all windows with a letter of at most ``max_rows`` labelled rows and ``max_bytes`` of text (smallest hash of
doc_id), each at least once.
Defined results: texts that are null or hold no letter are ``und`` with score 0; without training rows all are; rows
without doc_id, text or lang teach nothing; repeated rows teach once (of several languages of one doc_id and text the smallest
counts); rows that repeat a doc_id are judged row by row; an empty table gives an empty one. Texts of any
length are read whole, in pieces; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import bounded_sample
from textloom.llm.words import LOWER, Texts, pieces

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
STEP = 64
STEPS = 900
LETTER = re.compile(r"[^\W\d_]")  # letters, and a few numbers that are none: each match is tested
FOLD = LOWER.copy()
FOLD[48:58] = 48
IS_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
ANSWER = T.StructType().add("lang_pred", "string").add("score", "double")


def windows_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a piece (rows of WINDOW bytes) and the text of each; empty texts have none."""
    sizes = np.diff(texts.offsets)
    many = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), many)
    start = texts.offsets[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < texts.offsets[1:][owner][:, None]
    if not len(owner):
        return np.zeros((0, WINDOW), np.uint8), owner
    return np.where(inside, FOLD[texts.bytes[np.minimum(at, len(texts.bytes) - 1)]], 32).astype(np.uint8), owner


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


class ByteCNN:
    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        n = len(languages)
        self.params = {f"t{k}": rng.normal(0, 0.3, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.params |= {f"b{k}": np.zeros(FILTERS, np.float32) for k in WIDTHS}
        self.params |= {"w": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n)).astype(np.float32), "c": np.zeros(n, np.float32)}

    def _responses(self, x: np.ndarray, k: int) -> np.ndarray:
        """Response of each filter of width k at each place of each window."""
        table = self.params[f"t{k}"]
        n = WINDOW - k + 1
        total = table[0].take(x[:, :n], axis=0)
        for j in range(1, k):
            total += table[j].take(x[:, j : j + n], axis=0)
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = [np.zeros((0, len(self.languages)), np.float32)]
        for low in range(0, len(x), STEP):
            some = x[low : low + STEP]
            h = np.concatenate([np.tanh(self._responses(some, k).max(axis=1) + self.params[f"b{k}"]) for k in WIDTHS], axis=1)
            out.append(_softmax(h @ self.params["w"] + self.params["c"]))
        return np.concatenate(out)

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.01, seed: int = 2) -> None:
        """Adam on the cross-entropy; only the place of a filter's maximum gets its gradient."""
        rng = np.random.default_rng(seed)
        m = {p: np.zeros_like(v) for p, v in self.params.items()}
        v = {p: np.zeros_like(w) for p, w in self.params.items()}
        t = 0
        while t < steps:
            order = rng.permutation(len(x))
            for low in range(0, min(len(x), (steps - t) * STEP), STEP):
                some = order[low : low + STEP]
                gradients = self._gradients(x[some], y[some])
                t += 1
                for p, g in gradients.items():
                    m[p] = 0.9 * m[p] + 0.1 * g
                    v[p] = 0.999 * v[p] + 0.001 * g * g
                    self.params[p] -= rate * (m[p] / (1 - 0.9**t)) / (np.sqrt(v[p] / (1 - 0.999**t)) + 1e-7)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        rows = np.arange(len(x))
        places, hidden = [], []
        for k in WIDTHS:
            total = self._responses(x, k)
            at = total.argmax(axis=1)
            places.append(at)
            hidden.append(np.tanh(np.take_along_axis(total, at[:, None, :], axis=1)[:, 0] + self.params[f"b{k}"]))
        h = np.concatenate(hidden, axis=1)
        error = _softmax(h @ self.params["w"] + self.params["c"])
        error[rows, y] -= 1
        error /= len(x)
        back = (error @ self.params["w"].T) * (1 - h * h)
        out = {"w": h.T @ error, "c": error.sum(axis=0)}
        for i, k in enumerate(WIDTHS):
            g = back[:, i * FILTERS : (i + 1) * FILTERS]
            table = np.zeros_like(self.params[f"t{k}"])
            for j in range(k):
                byte = x[rows[:, None], places[i] + j]
                np.add.at(table[j], (byte, np.arange(FILTERS)[None, :]), g)
            out |= {f"t{k}": table, f"b{k}": g.sum(axis=0)}
        return out

    def predict(self, texts: pa.Array) -> pa.Array:
        """Struct of lang_pred and score for every text."""
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for part in pieces(texts):
            x, owner = windows_of(part)
            weight = IS_LETTER[x].sum(axis=1) + 1e-6
            p = self.probabilities(x) * weight[:, None]
            total = np.stack([np.bincount(owner, p[:, c], len(part)) for c in range(p.shape[1])], axis=1)
            total = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
            rows = slice(part.first, part.first + len(part))
            best[rows], score[rows] = total.argmax(axis=1), total.max(axis=1)
        lettered = np.array([bool(t) and has_letter(t) for t in texts.to_pylist()], bool)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best, lettered)]
        scores = pa.array(np.clip(np.where(lettered, score, 0), 0, 1))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), scores], ANSWER.names)

    def answer(self, text: str | Column) -> Column:
        @F.arrow_udf(ANSWER)
        def run(texts: pa.Array) -> pa.Array:
            if not self.languages:
                rows = [{"lang_pred": "und", "score": 0.0}] * len(texts)
                return pa.array(rows, pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))
            return self.predict(texts)

        return run(text)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, label: str = "lang", max_rows: int = 4000, max_bytes: int = 1 << 25) -> ByteCNN:
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col(label).isNotNull())
    named = known.select("doc_id", "text", F.col(label).cast("string").alias("lang"))
    rows = bounded_sample(named, max_rows, max_bytes)

    def run(batches):
        for batch in batches:
            for part in pieces(batch.column("text")):
                x, owner = windows_of(part)
                at = np.flatnonzero(IS_LETTER[x].any(axis=1))
                langs = batch.column("lang").take(pa.array(part.first + owner[at]))
                yield pa.RecordBatch.from_arrays([langs, pa.array([w.tobytes() for w in x[at]], pa.binary())], ["lang", "x"])

    got = rows.mapInArrow(run, "lang string, x binary").toPandas()  # the windows of max_bytes at most
    got = got.sort_values(["x", "lang"], kind="stable")  # one order, whatever the partitions were
    languages = sorted(set(got["lang"]))
    model = ByteCNN(languages)
    if len(got):
        x = np.frombuffer(b"".join(got["x"]), np.uint8).reshape(-1, WINDOW)
        steps = max(STEPS, -(-len(x) // STEP))  # every window at least once
        model.train(x, np.searchsorted(languages, got["lang"].to_numpy(str)), steps)
    return model


def report(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows that are not held out."""
    model = fit(docs.where(~held_out))
    answered = docs.select("doc_id", held_out.alias("held_out"), model.answer("text").alias("a"))
    return answered.select("doc_id", "held_out", "a.*")
