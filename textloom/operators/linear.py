"""Logistic regression on TF-IDF and a linear support vector machine on dense vectors, both by Newton steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.ngrams import Analyzer, long_word_analyzer
from textloom.operators import newton
from textloom.operators.aggregates import class_weights
from textloom.operators.classifiers import LinearModel
from textloom.operators.features import build_vocabulary, fit_standardizer, smooth_idf, standardize
from textloom.operators.lookup import lookup
from textloom.session import BROADCAST_BYTES, materialize


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add the balanced weight of each row's class (two classes, a two-row table)."""
    weights = class_weights(df.filter(F.col(label).isin(0, 1)), label).select(label, "weight")
    return df.join(F.broadcast(weights), label)


def tfidf_rows(
    docs: DataFrame, vocabulary: DataFrame, analyzer: Analyzer, keys: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``(keys, idx, val, n, norm)``: L2-normalised raw-tf TF-IDF as positions and values, in no order.

    A value is a count ``n`` times the feature's idf through the ``norm`` of the document. ``vocabulary`` has (feature, idx, idf).
    A document without a known feature has empty arrays. Groups are documents, so with documents partitioned by key nothing
    is shuffled again.
    """
    features = docs.select(*keys, F.explode_outer(analyzer(F.col(text))).alias("feature"))
    known = lookup(features, vocabulary.select("feature", "idx", "idf"), "feature")
    # Counted by number: features without one, most of them, are a single row of their document.
    counts = known.groupBy(*keys, "idx").agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("idf").alias("idf"))
    value = F.col("n") * F.col("idf")
    entry = F.when(F.col("idx").isNotNull(), F.struct(F.col("idx").cast("int").alias("idx"), "n", value.alias("v")))
    vectors = counts.groupBy(*keys).agg(F.collect_list(entry).alias("e"), F.sqrt(F.sum(value * value)).alias("norm"))
    return vectors.select(
        *keys, F.col("e.idx").alias("idx"), F.transform("e.v", lambda v: v / F.col("norm")).alias("val"), F.col("e.n").alias("n"), "norm"
    )


def _sizes(train: DataFrame, label: str, key: str) -> tuple[int, dict[int, float]]:
    """Rows, and the balanced weight of each class by its documents; reads keys and labels, no text."""
    documents = train.groupBy(key, label).agg(F.count(F.lit(1)).alias("rows"))
    classes = documents.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).collect()
    counted = {int(c[label]): c["n"] for c in classes}
    return sum(c["rows"] for c in classes), {c: sum(counted.values()) / (len(counted) * n) for c, n in counted.items()}


@dataclass(frozen=True)
class LogisticRegression:
    """Balanced logistic regression with a free intercept on TF-IDF of the commonest features.

    The fitted model is a parameter table like those of the count-based classifiers: it scores (log-odds) by the same
    lookup, saves, loads and is compared with them. Without rows of both classes all weights are 0.
    """

    analyzer: Analyzer | None = None
    max_features: int = 15000
    c: float = 1.0
    tol: float = 1e-10

    def fit(self, train: DataFrame, label: str = "label", key: str = "doc_id", text: str = "text") -> LinearModel:
        analyzer = self.analyzer or long_word_analyzer(1, 2)
        train = train.filter(F.col(label).isin(0, 1))
        words = build_vocabulary(train, analyzer, 1, self.max_features, "cf", label, key, text)
        total, weights = _sizes(train, label, key)
        words = words.select("feature", "idx", smooth_idf(F.col("df"), total).alias("idf"))
        weight = F.when(F.col(label) == 1, weights.get(1, 0.0)).otherwise(weights.get(0, 0.0))
        rows = tfidf_rows(train, words, analyzer, (key, label), text)
        rows = rows.select("idx", F.col("n").alias("val"), F.col(label).alias("label"), weight.alias("weight"), "norm")
        listed = words.select("idx", "idf").toArrow()  # bounded by max_features
        idf = np.ones(self.max_features)
        idf[listed["idx"].to_numpy()] = listed["idf"].to_numpy()
        fitted = newton.fit(rows, self.max_features, newton.LOGISTIC, self.c, self.tol, scale=idf)
        weights = fitted.weights.withColumnRenamed("dim", "idx")
        params = words.join(weights, "idx", "left").select("feature", "idf", F.coalesce("w", F.lit(0.0)).alias("w"))
        return LinearModel("tfidf", materialize(params, "logistic", BROADCAST_BYTES), fitted.intercept, analyzer)


def logistic_regression(train: DataFrame, docs: DataFrame, label: str = "label", c: float = 1.0) -> DataFrame:
    """Fit on ``train``, predict ``docs``: ``(doc_id, label, score, predicted)`` with ``score`` as log-odds."""
    scored = LogisticRegression(c=c).fit(train, label).score(docs, ("doc_id", label))
    return scored.withColumn("predicted", (F.col("score") > 0).cast("int"))


@dataclass(frozen=True)
class SupportVectors:
    """A linear support vector machine on standardised vectors: statistics of the train rows and a Newton model."""

    stats: DataFrame
    model: newton.NewtonModel

    @staticmethod
    def fit(train: DataFrame, vector: str = "embedding", label: str = "label", c: float = 1.0, tol: float = 1e-8) -> "SupportVectors":
        """Squared hinge with balanced class weights and a penalised intercept."""
        stats = materialize(fit_standardizer(train, vector), "standardizer")
        size = stats.select(F.size("stats")).first()[0]
        weighted = with_class_weight(standardize(train, stats, vector), label)
        return SupportVectors(stats, newton.fit(newton.dense_rows(weighted, vector, label), max(size, 0), newton.HINGE, c, tol))

    def predict(self, vectors: DataFrame, vector: str = "embedding") -> DataFrame:
        """``vectors`` with ``score`` and ``predicted``; row-local."""
        scored = vectors.withColumn("_prepared", F.col(vector))
        scored = standardize(scored, self.stats, "_prepared").withColumn("score", self.model.score(F.col("_prepared"))).drop("_prepared")
        return scored.withColumn("predicted", (F.col("score") > 0).cast("int"))

    def save(self, path: str) -> None:
        self.stats.write.mode("overwrite").parquet(f"{path}/standardizer")
        self.model.save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SupportVectors":
        return SupportVectors(spark.read.parquet(f"{path}/standardizer"), newton.NewtonModel.load(spark, f"{path}/model"))


def linear_svm(train: DataFrame, vectors: DataFrame, vector: str = "embedding", label: str = "label", c: float = 1.0) -> DataFrame:
    """Fit on ``train``, predict ``vectors``: columns ``score`` and ``predicted``."""
    return SupportVectors.fit(train, vector, label, c).predict(vectors, vector)
