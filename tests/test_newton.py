"""Truncated Newton against the optimum's conditions, finite differences and closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import newton


def problem(n=120, d=6, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.7, size=n) > 0.3).astype(int)
    weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    return x, y, weight


def frame(spark, x, y, weight):
    rows = [(v.tolist(), int(t), float(w)) for v, t, w in zip(x, y, weight)]
    return newton.dense_rows(spark.createDataFrame(rows, "v array<double>, label int, weight double").repartition(3), "v")


def objective(kind, v, x, y, weight, c):
    z = (2 * y - 1) * (x @ v[:-1] + v[-1])
    loss = np.maximum(1 - z, 0) ** 2 if kind == newton.HINGE else np.logaddexp(0, -z)
    own = v if kind == newton.HINGE else v[:-1]
    return own @ own / 2 + c * weight @ loss


@pytest.mark.parametrize("kind", [newton.HINGE, newton.LOGISTIC])
@pytest.mark.parametrize("c", [0.01, 1.0])
def test_no_direction_is_downhill(spark, kind, c):
    x, y, weight = problem()
    model = newton.fit(frame(spark, x, y, weight), 6, kind, c)
    assert model.gradient <= 1e-6
    at, eps = np.append(model.dense(), model.intercept), 1e-5
    slopes = [(objective(kind, at + eps * e, x, y, weight, c) - objective(kind, at - eps * e, x, y, weight, c)) / (2 * eps) for e in np.eye(7)]
    assert np.abs(slopes).max() < 1e-4
    rng = np.random.default_rng(2)
    best = objective(kind, at, x, y, weight, c)
    assert all(objective(kind, at + d, x, y, weight, c) > best for d in rng.normal(scale=0.05, size=(100, 7)))


def test_one_row_of_each_class_in_closed_form(spark):
    """x = 1 and -1, weight 1: w^2 / 2 + 2 c (1 - w)^2 is least at w = 4c / (1 + 4c), the intercept is 0."""
    rows = frame(spark, np.array([[1.0], [-1.0]]), np.array([1, 0]), np.ones(2))
    for c in (0.25, 1.0, 10.0):
        model = newton.fit(rows, 1, newton.HINGE, c)
        assert model.dense()[0] == pytest.approx(4 * c / (1 + 4 * c), abs=1e-7)
        assert model.intercept == pytest.approx(0, abs=1e-9)


def test_scores_save_load_and_partitions(spark, tmp_path):
    x, y, weight = problem(60, 3)
    model = newton.fit(frame(spark, x, y, weight), 3)
    again = newton.fit(frame(spark, x, y, weight).repartition(7), 3)
    assert np.allclose(model.dense(), again.dense(), atol=1e-7)
    model.save(f"{tmp_path}/m")
    loaded = newton.NewtonModel.load(spark, f"{tmp_path}/m")
    vectors = spark.createDataFrame([(v.tolist(),) for v in x] + [(None,)], "v array<double>")
    got = [r.s for r in vectors.select(loaded.score(F.col("v")).alias("s")).collect()]
    assert got[:-1] == pytest.approx((x @ model.dense() + model.intercept).tolist()) and got[-1] is None


def test_sparse_rows_one_class_and_none(spark):
    rows = spark.createDataFrame(
        [([0, 2], [1.0, 2.0], 1, 1.0), ([1], [1.0], 0, 1.0), ([], [], 0, 1.0), ([2], [1.0], 7, 1.0)],
        "idx array<int>, val array<double>, label int, weight double",
    )
    w = newton.fit(rows, 4, newton.LOGISTIC).dense()
    assert w[0] > 0 > w[1] and w[2] > w[0] and w[3] == 0
    for some in (rows.where("label = 1"), rows.limit(0)):
        model = newton.fit(some, 4)
        assert model.intercept == 0 and not model.dense().any()


def test_support_vectors_predict_save_and_load(spark, tmp_path):
    from textloom.operators import linear

    x, y, _ = problem(80, 4)
    rows = [(i, v.tolist(), int(t)) for i, (v, t) in enumerate(zip(x * 10 + 3, y))]
    train = spark.createDataFrame(rows, "id long, embedding array<double>, label int")
    fitted = linear.SupportVectors.fit(train)
    got = {r.id: (r.score, r.predicted) for r in fitted.predict(train).collect()}
    assert sum(p == t for (_, p), t in zip((got[i] for i in range(80)), y)) > 60
    assert all(p == (s > 0) for s, p in got.values())
    fitted.save(f"{tmp_path}/svm")
    again = linear.SupportVectors.load(spark, f"{tmp_path}/svm").predict(train)
    assert {r.id: (r.score, r.predicted) for r in again.collect()} == got
    assert linear.linear_svm(train, train.limit(0)).collect() == []


def test_few_passes_for_features_of_very_different_weight(spark, monkeypatch):
    """Common features have thousands of times the curvature of rare ones: the diagonal takes that out."""
    rng = np.random.default_rng(5)
    x = rng.random((600, 30)) * (rng.random((600, 30)) < 0.3) * np.logspace(2, -1, 30)
    y = (rng.random(600) < 1 / (1 + np.exp(-(x @ rng.normal(size=30)) / 20))).astype(int)
    passes = []
    whole = newton._Passes._sum
    monkeypatch.setattr(newton._Passes, "_sum", lambda self, *args: passes.append(1) or whole(self, *args))
    model = newton.fit(frame(spark, x, y, np.ones(600)), 30, newton.LOGISTIC, tol=1e-8)
    assert model.gradient <= 1e-8 and len(passes) <= 200


def test_few_passes_for_features_that_come_together(spark, monkeypatch):
    """Passages that repeat give groups of equal features, whose curvature no diagonal takes out; earlier steps know them."""
    rng = np.random.default_rng(7)
    groups = (rng.random((400, 12)) < 0.3) * rng.integers(1, 4, (400, 12))
    x = np.hstack([np.repeat(groups, 10, axis=1), (rng.random((400, 40)) < 0.2) * 1.0]) * np.logspace(1, -0.5, 160)
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ rng.normal(size=160)) / 20))).astype(int)
    sign, passes = 2.0 * y - 1, []

    def in_memory(self, w, direction):
        passes.append(1)
        losses, first, second = newton.margin_losses(newton.LOGISTIC, sign * (x @ w[:-1] + w[-1]))
        full = np.hstack([x, np.ones((400, 1))])
        if direction is None:
            return losses.sum(), full.T @ (sign * first), (full**2).T @ second
        return 0.0, full.T @ (second * (full @ direction)), np.zeros(161)

    monkeypatch.setattr(newton._Passes, "_sum", in_memory)
    model = newton.fit(frame(spark, x, y, np.ones(400)), 160, newton.LOGISTIC, tol=1e-9)
    assert model.gradient <= 1e-9 and len(passes) <= 400


def test_counts_with_scale_and_norm_are_the_vectors(spark):
    """Counts of a byte or two, scaled by dimension and through the norm of the row, fit like the values themselves."""
    rng = np.random.default_rng(3)
    n = rng.poisson(0.7, (90, 8)) * rng.choice([1, 40, 700], (90, 8))
    n[5] = 0
    scale = rng.random(8) + 1
    norm = np.maximum(np.sqrt(((n * scale) ** 2).sum(axis=1)), 1.0)
    y = (rng.random(90) < 0.4).astype(int)
    some = [[int(i) for i in np.flatnonzero(r)] for r in n]
    rows = [(a, [int(r[i]) for i in a], int(t), 1.0, float(m)) for a, r, t, m in zip(some, n, y, norm)]
    counted = spark.createDataFrame(rows, "idx array<int>, val array<int>, label int, weight double, norm double").repartition(3)
    got = newton.fit(counted, 8, newton.LOGISTIC, tol=1e-9, scale=scale)
    want = newton.fit(frame(spark, n * scale / norm[:, None], y, np.ones(90)), 8, newton.LOGISTIC, tol=1e-9)
    assert got.gradient <= 1e-9 and got.dense() == pytest.approx(want.dense(), abs=1e-8)
    assert got.intercept == pytest.approx(want.intercept, abs=1e-8)


def test_vectors_are_stored_by_the_byte():
    assert newton._narrow(np.array([0, 255])).dtype == np.uint8 and newton._narrow(np.array([0, 256])).dtype == np.uint16
    assert newton._narrow(np.array([0.5, 1.0])).dtype == np.float64 and newton._narrow(np.array([-1, 1])).dtype == np.float64


def test_tfidf_rows_of_a_long_text_and_of_none(spark):
    """The norm is taken once a text, not once a feature: 20,000 features are 20,000 quotients."""
    from textloom.functions.ngrams import long_word_analyzer
    from textloom.operators.linear import tfidf_rows

    words = [f"w{i}" for i in range(20_000)]
    docs = spark.createDataFrame([(1, " ".join([*words, "w7 w7"])), (2, "none of these"), (3, None)], "doc_id long, text string")
    idf = spark.range(20_000).selectExpr("concat('w', id) AS feature", "cast(id AS int) AS idx", "1 + id / 20000 AS idf")
    rows = {r.doc_id: r for r in tfidf_rows(docs, idf, long_word_analyzer(1, 1)).collect()}
    v = 1 + np.arange(20_000) / 20_000
    v[7] *= 3
    got = np.zeros(20_000)
    got[rows[1].idx] = rows[1].val
    assert got == pytest.approx(v / np.sqrt(v @ v), rel=1e-12) and rows[2].idx == rows[3].idx == []
