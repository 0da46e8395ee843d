"""What the classifiers learn from: bounded rows, defined labels, all windows; and their arithmetic against loops."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.llm import langid, toxicity
from textloom.llm.common import bounded_sample


def test_rows_and_bytes_are_bounded(spark):
    rows = [(1, f"text {i}", "en") for i in range(500)] + [(2, "x" * 5000, "fr"), (3, "same", "de"), (3, "same", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    assert bounded_sample(docs, 100, 1 << 20).count() == 100
    few = bounded_sample(docs, 10_000, 1000).collect()
    assert 900 < sum(len(r.text) for r in few) <= 1000
    assert {tuple(r) for r in bounded_sample(docs.where("doc_id = 3"), 9, 99).collect()} == {(3, "same", "aa")}
    assert bounded_sample(docs.limit(0), 9, 99).collect() == []


def test_contradictory_labels_do_not_depend_on_partitions(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    both = labels.unionByName(docs.where("doc_id < 100").select("doc_id", F.lit(1).alias("toxic")))
    for parts in (1, 3, 7):
        rows = toxicity.training_rows(docs, both.repartition(parts), "toxic", 1000, 1 << 20).collect()
        assert len(rows) == 300
        assert all(r.label == (1 if int(r.text[5:]) < 100 else int(r.text[5:]) % 2) for r in rows)


def test_numbers_are_no_letters():
    assert [langid.has_letter(t) for t in ("½", "²", "12 _ ½", "½a", "é", "語", "")] == [False, False, False, True, True, True, False]


def test_weights_follow_the_gradient_of_the_stated_loss():
    """Adam ends near the optimum of loss, L2 and counterfactual penalty that plain descent on finite differences finds."""
    rng = np.random.default_rng(1)
    x = (rng.random((60, 5)) < 0.4).astype(float)
    y = (rng.random(60) < 0.5).astype(float)
    swap = [(r, c, s) for r in range(0, 60, 3) for c, s in ((0, 1.0), (1, -1.0))]
    swaps = tuple(np.array(v) for v in zip(*swap))
    penalty, l2 = 0.7, 0.05
    row, col = np.nonzero(x)
    w, b = toxicity.fit_weights(row, col, y, 5, swaps, penalty, l2, steps=6000)

    def loss(v):
        z = x @ v[:5] + v[5]
        change = [sum(s * v[c] for r2, c, s in swap if r2 == r) for r in range(60)]
        return np.mean(np.logaddexp(0, z) - y * z) + l2 / 2 * v[:5] @ v[:5] + penalty / 60 * np.dot(change, change)

    def slope(v, eps=1e-6):
        return np.array([(loss(v + eps * e) - loss(v - eps * e)) / (2 * eps) for e in np.eye(6)])

    dense = np.zeros(6)
    for _ in range(3000):
        dense -= 0.5 * slope(dense)
    assert np.abs(slope(dense)).max() < 1e-6
    at = np.append(w, b)
    assert np.abs(slope(at)).max() < 0.02 and loss(at) - loss(dense) < 1e-3
    assert np.abs(at - dense).max() < 0.1


def by_loops(model, window):
    hidden = []
    for k in langid.WIDTHS:
        for f in range(langid.FILTERS):
            best = max(sum(model.params[f"t{k}"][j, window[p + j], f] for j in range(k)) for p in range(langid.WINDOW - k + 1))
            hidden.append(np.tanh(best + model.params[f"b{k}"][f]))
    z = np.array(hidden) @ model.params["w"] + model.params["c"]
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def test_network_equals_loops():
    rng = np.random.default_rng(3)
    model = langid.ByteCNN(["a", "b", "c"])
    x = rng.integers(0, 256, (2, langid.WINDOW)).astype(np.uint8)
    got = model.probabilities(x)
    for one, p in zip(x, got):
        assert np.allclose(by_loops(model, one), p, atol=1e-4)
    y = np.array([0, 2])
    gradient = model._gradients(x, y)

    def loss():
        return -np.mean(np.log(model.probabilities(x)[np.arange(2), y].astype(float)))

    for name in ("w", "c", "b3", "t2"):
        at = np.unravel_index(np.abs(gradient[name]).argmax(), gradient[name].shape)
        keep, eps = model.params[name][at], 1e-2
        model.params[name][at] = keep + eps
        high = loss()
        model.params[name][at] = keep - eps
        low = loss()
        model.params[name][at] = keep
        assert abs((high - low) / (2 * eps) - gradient[name][at]) < 2e-3


def test_all_windows_of_training_texts_are_used(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid.ByteCNN, "train", lambda self, x, y, steps: seen.append((len(x), steps)))
    docs = spark.createDataFrame([(i, "words " * 500, "en") for i in range(40)] + [(99, "1 2 3", "fr")], "doc_id long, text string, lang string")
    langid.fit(docs)
    assert seen == [(40 * 12, langid.STEPS)]
    monkeypatch.setattr(langid, "STEPS", 2)
    langid.fit(docs)
    assert seen[1][1] == 8


def test_empty_tables_and_very_long_texts(spark):
    schema = "doc_id long, text string, lang string, score double, held_out string"
    none = spark.createDataFrame([], schema)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert langid.report(none, F.lit(False)).collect() == []
    model = toxicity.fit(none, labels)
    assert toxicity.report(none, model, F.lit(False)).collect() == []
    long = "mots et paroles " * 50_000
    docs = spark.createDataFrame([(1, long, "fr", 0.5, "x"), (2, "words and speech", "en", 0.5, "x"), (3, None, "en", 0.1, "y")], schema)
    got = {r.doc_id: r for r in langid.report(docs, F.lit(False)).collect()}
    assert got[3].lang_pred == "und" and got[1].lang_pred in ("en", "fr")
    assert toxicity.accepted(docs, model).columns == docs.columns
    assert model.scores(pa.array([long, None, ""])).shape == (3,)
