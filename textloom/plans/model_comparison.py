"""Train, tune, test and rank the count-based classifiers in shared passes over the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.ngrams import char_analyzer, word_analyzer
from textloom.operators.classifiers import (
    LinearModel,
    class_counts,
    fit_bernoulli_nb,
    fit_multinomial_nb,
    fit_rocchio,
    score_together,
)
from textloom.operators.evaluate import compare_models
from textloom.operators.features import build_vocabulary
from textloom.operators.linear import LogisticRegression
from textloom.operators.passive_aggressive import PassiveAggressive
from textloom.session import materialize, store_by_doc

KEYS = ("doc_id", "split", "label")

# Names under which results are reported.
WORD_NB = "MultinomialNB + Word Count ngram(1,2)"
CHAR_NB = "MultinomialNB + Char Count ngram(3,5)"
BERNOULLI = "BernoulliNB + Binary Word ngram(1,2)"
ROCCHIO = "Rocchio + TF-IDF Word ngram(1,2)"
HASHED_PA = "PassiveAggressive + Hashing Word ngram(1,2)"
LOGISTIC = "LogisticRegression + TF-IDF Word ngram(1,2)"


def fit_word_models(train: DataFrame, counts: tuple[int, int]) -> dict[str, LinearModel]:
    """Three models on word (1,2)-grams from one vocabulary; the smaller one is its beginning."""
    words = word_analyzer(1, 2)
    vocabulary = build_vocabulary(train, words, min_df=2, max_features=60000)
    return {
        WORD_NB: fit_multinomial_nb(vocabulary, counts, words),
        BERNOULLI: fit_bernoulli_nb(vocabulary.filter(F.col("idx") < 40000), counts, words),
        ROCCHIO: fit_rocchio(train, vocabulary, counts, words),
    }


def fit_char_model(train: DataFrame, counts: tuple[int, int]) -> LinearModel:
    chars = char_analyzer(3, 5)
    return fit_multinomial_nb(build_vocabulary(train, chars, min_df=3, max_features=80000), counts, chars)


def score_models(docs: DataFrame, passive_aggressive: bool = False, logistic: bool = False) -> DataFrame:
    """``(model, doc_id, split, label, score)`` on valid and test of models fitted on train.

    The texts are passed over several times, so they are stored in buckets of documents first.
    """
    docs = store_by_doc(docs.select(*KEYS, "text"), "labelled")
    train, held_out = docs.filter(F.col("split") == "train"), docs.filter(F.col("split") != "train")
    counts = class_counts(train)
    scores = score_together(fit_word_models(train, counts), held_out, KEYS)
    scores = scores.unionByName(_named(CHAR_NB, fit_char_model(train, counts).score(held_out, KEYS)))
    if passive_aggressive:
        fitted = PassiveAggressive(word_analyzer(1, 2)).fit(train)
        scores = scores.unionByName(_named(HASHED_PA, fitted.score(held_out, KEYS)))
    if logistic:
        scores = scores.unionByName(_named(LOGISTIC, LogisticRegression().fit(train).score(held_out, KEYS)))
    return scores


def _named(name: str, scores: DataFrame) -> DataFrame:
    return scores.withColumn("model", F.lit(name))


def model_comparison(docs: DataFrame, passive_aggressive: bool = False, logistic: bool = False) -> DataFrame:
    """One row per model: threshold, valid and test metrics, rank."""
    return compare_models(materialize(score_models(docs, passive_aggressive, logistic), "scores"))
