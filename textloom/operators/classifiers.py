"""Count-based text classifiers as parameter tables.

``fit`` reads the training documents and stores a table of at most ``max_features`` rows;
``score`` joins it to the terms of any documents. A score is class 1 minus class 0.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from textloom.functions.ngrams import Analyzer
from textloom.operators.features import build_vocabulary, idf_table, term_counts, tfidf
from textloom.operators.lookup import lookup
from textloom.session import BROADCAST_BYTES, materialize


@dataclass(frozen=True)
class LinearModel:
    """A fitted model: ``params`` has a row per feature, ``bias`` is added to every score.

    ``kind`` says how the terms of a document enter the score.
    """

    kind: str
    params: DataFrame
    bias: float
    analyzer: Analyzer

    def score_column(self, prefix: str = "") -> Column:
        """Aggregate over the terms of a document, given the parameters as ``prefix`` columns."""
        weight = F.coalesce(F.col(f"{prefix}w"), F.lit(0.0))
        if self.kind == "counts":
            return F.sum(F.col("tf") * weight) + self.bias
        if self.kind == "presence":
            return F.sum(weight) + self.bias
        tf = 1.0 + F.log("tf") if self.kind == "cosine" else F.col("tf")
        value = tf * F.coalesce(F.col(f"{prefix}idf"), F.lit(0.0))
        norm = F.sqrt(F.sum(value * value))
        return F.sum(value * weight) / F.when(norm > 0, norm).otherwise(1.0) + self.bias

    def columns(self) -> list[str]:
        return ["w", "idf"] if self.kind in ("cosine", "tfidf") else ["w"]

    def score(self, docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
        """``(keys, score)`` for every document, also those with no known feature."""
        counts = term_counts(docs, self.analyzer, keys, text)
        joined = lookup(counts, self.params.select("feature", *self.columns()), "feature")
        return joined.groupBy(*keys).agg(self.score_column().alias("score"))

    def save(self, path: str) -> None:
        """Store parameters and bias; the analyzer is code and is given again on load."""
        self.params.write.mode("overwrite").parquet(f"{path}/params")
        head = json.dumps({"kind": self.kind, "bias": self.bias})
        self.params.sparkSession.range(1).select(F.lit(head).alias("value")).write.mode("overwrite").text(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str, analyzer: Analyzer) -> "LinearModel":
        head = json.loads(spark.read.text(f"{path}/head").first()[0])
        return LinearModel(head["kind"], spark.read.parquet(f"{path}/params"), head["bias"], analyzer)


def score_together(
    models: Mapping[str, LinearModel], docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``(model, keys, score)`` for models that share one analyzer, from one pass over the texts."""
    named = list(models.items())
    table = None
    for i, (_, model) in enumerate(named):
        own = model.params.select("feature", *[F.col(c).alias(f"m{i}_{c}") for c in model.columns()])
        table = own if table is None else table.join(own, "feature", "full")
    counts = term_counts(docs, named[0][1].analyzer, keys, text)
    scored = counts.join(materialize(table, "parameters", BROADCAST_BYTES), "feature", "left").groupBy(*keys).agg(
        *[model.score_column(f"m{i}_").alias(f"s{i}") for i, (_, model) in enumerate(named)]
    )
    stacked = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"s{i}").alias("score")) for i, (name, _) in enumerate(named)])
    return scored.select(*keys, F.inline(stacked)).select("model", *keys, "score")


def class_counts(docs: DataFrame, label: str = "label") -> tuple[int, int]:
    """Rows with label 0 and with label 1 (one row comes to the driver)."""
    row = docs.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]


def prior_difference(counts: tuple[int, int]) -> float:
    """Log of the class ratio; a class without rows counts as half a row."""
    return math.log(max(counts[1], 0.5) / max(counts[0], 0.5))


def exact_log(positive: Column) -> Column:
    """Natural logarithm as the C library gives it. That of the JVM differs in the last bit of some values, which decides
    between words whose weights are ties in theory. For tables of parameters: it runs in Python."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else math.log(v) for v in values.to_pylist()], pa.float64())

    return F.arrow_udf(run, DoubleType())(positive)


def fit_multinomial_nb(vocabulary: DataFrame, counts: tuple[int, int], analyzer: Analyzer, alpha: float = 1.0) -> LinearModel:
    """Multinomial naive Bayes from a vocabulary's class counts; the prior is not smoothed.

    A feature unseen in a class has count 0 there, which gives the default probability.
    """
    totals = vocabulary.agg(F.count(F.lit(1)), F.sum("cf0"), F.sum("cf1")).first()
    size, total0, total1 = totals[0], totals[1] or 0, totals[2] or 0
    log_probs = vocabulary.select(
        "feature",
        exact_log((F.col("cf0") + alpha) / F.lit(total0 + alpha * size)).alias("log_prob_0"),
        exact_log((F.col("cf1") + alpha) / F.lit(total1 + alpha * size)).alias("log_prob_1"),
    )
    log_probs = materialize(log_probs, "log-probabilities", BROADCAST_BYTES)
    params = log_probs.withColumn("w", F.col("log_prob_1") - F.col("log_prob_0"))
    return LinearModel("counts", params, prior_difference(counts), analyzer)


def fit_bernoulli_nb(vocabulary: DataFrame, counts: tuple[int, int], analyzer: Analyzer, alpha: float = 1.0) -> LinearModel:
    """Bernoulli naive Bayes: present features add their delta, the base holds all absences."""

    def prob(c: int) -> Column:
        return (F.col(f"df{c}") + alpha) / F.lit(counts[c] + 2 * alpha)

    absent = [F.log(1 - prob(c)) for c in (0, 1)]
    params = vocabulary.select(
        "feature",
        *[absent[c].alias(f"absent_{c}") for c in (0, 1)],
        *[(F.log(prob(c)) - absent[c]).alias(f"delta_{c}") for c in (0, 1)],
    ).withColumn("w", F.col("delta_1") - F.col("delta_0"))
    base = params.agg(F.sum("absent_1") - F.sum("absent_0")).first()[0] or 0.0
    return LinearModel("presence", params, prior_difference(counts) + base, analyzer)


def fit_rocchio(
    docs: DataFrame,
    vocabulary: DataFrame,
    counts: tuple[int, int],
    analyzer: Analyzer,
    label: str = "label",
    key: str = "doc_id",
    text: str = "text",
) -> LinearModel:
    """Class centroids of log-tf TF-IDF vectors, each scaled to length 1."""
    idf = idf_table(vocabulary, counts[0] + counts[1])
    vectors = tfidf(term_counts(docs, analyzer, (key, label), text), idf, True, key)

    def mean(c: int) -> Column:
        return F.sum(F.when(F.col(label) == c, F.col("value")).otherwise(0.0)) / float(max(counts[c], 1))

    means = materialize(
        vectors.groupBy("feature").agg(mean(0).alias("m0"), mean(1).alias("m1")).join(idf, "feature"), "centroids", BROADCAST_BYTES
    )
    norms = means.agg(*[F.sqrt(F.sum(F.col(f"m{c}") * F.col(f"m{c}"))) for c in (0, 1)]).first()
    params = means.select(
        "feature",
        "idf",
        *[(F.col(f"m{c}") / F.lit(norms[c] or 1.0)).alias(f"centroid_{c}") for c in (0, 1)],
    ).withColumn("w", F.col("centroid_1") - F.col("centroid_0"))
    return LinearModel("cosine", params, 0.0, analyzer)


@dataclass(frozen=True)
class MultinomialNB:
    analyzer: Analyzer
    min_df: int = 2
    max_features: int = 60000
    alpha: float = 1.0

    def fit(self, docs: DataFrame) -> LinearModel:
        vocabulary = build_vocabulary(docs, self.analyzer, self.min_df, self.max_features)
        return fit_multinomial_nb(vocabulary, class_counts(docs), self.analyzer, self.alpha)


@dataclass(frozen=True)
class BernoulliNB:
    analyzer: Analyzer
    min_df: int = 2
    max_features: int = 40000
    alpha: float = 1.0

    def fit(self, docs: DataFrame) -> LinearModel:
        vocabulary = build_vocabulary(docs, self.analyzer, self.min_df, self.max_features)
        return fit_bernoulli_nb(vocabulary, class_counts(docs), self.analyzer, self.alpha)


@dataclass(frozen=True)
class Rocchio:
    analyzer: Analyzer
    min_df: int = 2
    max_features: int = 60000

    def fit(self, docs: DataFrame) -> LinearModel:
        vocabulary = build_vocabulary(docs, self.analyzer, self.min_df, self.max_features)
        return fit_rocchio(docs, vocabulary, class_counts(docs), self.analyzer)
