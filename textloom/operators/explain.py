"""Why a document got its score: exact token weights, and a perturbation explanation."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.profile import tokens
from textloom.operators.classifiers import LinearModel


def token_attribution(
    docs: DataFrame, model: LinearModel, top: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, pos, token, weight)``: every token in text order with its word's contribution.

    A word contributes tf times its weight. The ``top`` words of a document by magnitude keep
    their contribution; other tokens get 0.
    """
    words = (
        docs.select(key, F.posexplode(tokens(F.col(text))).alias("pos", "token"))
        .groupBy(key, "token")
        .agg(F.count(F.lit(1)).alias("tf"), F.collect_list("pos").alias("positions"))
    )
    weights = model.params.select(F.col("feature").alias("token"), "w")
    order = Window.partitionBy(key).orderBy(F.desc(F.abs("part")), "token")
    ranked = (
        words.join(weights, "token", "left")
        .withColumn("part", F.col("tf") * F.coalesce("w", F.lit(0.0)))
        .withColumn("place", F.row_number().over(order))
    )
    return ranked.select(
        key,
        F.explode("positions").alias("pos"),
        "token",
        F.when(F.col("place") <= top, F.col("part")).otherwise(0.0).alias("weight"),
    )


def _unit(*parts) -> Column:
    """A repeatable number in [0, 1) from a hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(2**32)) / float(2**32)


def surrogate(top: int, width: float = 25.0) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For ``applyInPandas``: a weighted ridge from kept words to probability, for one document."""

    def ridge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, alpha: float) -> np.ndarray:
        share = weight / weight.sum()
        root = np.sqrt(weight)[:, None]
        centred, target = (x - share @ x) * root, (y - share @ y) * root[:, 0]
        # Fewer samples than words: solve in the space of samples.
        gram = centred @ centred.T + alpha * np.eye(len(y))
        return centred.T @ np.linalg.solve(gram, target)

    def explain(samples: pd.DataFrame) -> pd.DataFrame:
        samples = samples.sort_values("sample")
        words = sorted(samples["words"].iloc[0])
        place = {w: i for i, w in enumerate(words)}
        kept = np.zeros((len(samples), len(words)))
        for row, present in enumerate(samples["words"]):
            kept[row, [place[w] for w in present]] = 1.0
        share_kept = np.sqrt(kept.sum(axis=1) / max(len(words), 1))
        weight = np.sqrt(np.exp(-((100.0 * (1.0 - share_kept)) ** 2) / width**2))
        y = 1.0 / (1.0 + np.exp(-np.clip(samples["score"].to_numpy(), -500, 500)))
        first = ridge(kept, y, weight, 0.01)
        chosen = np.argsort(-np.abs(first), kind="stable")[:top]
        weights = ridge(kept[:, chosen], y, weight, 1.0)
        return pd.DataFrame(
            {"doc_id": samples["doc_id"].iloc[0], "word": [words[i] for i in chosen], "weight": weights}
        )

    return explain


def explain_perturb(
    docs: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    n_samples: int = 1000,
    top: int = 20,
    seed: int = 42,
    text: str = "text",
) -> DataFrame:
    """``(doc_id, word, weight)``: words whose removal moves the predicted probability most.

    Meant for a few chosen documents. Each is copied ``n_samples`` times with a repeatable random
    part of its words dropped (sample 0 keeps all); ``score`` scores all copies at once and returns
    ``(doc_id, sample, score)``; a weighted ridge per document gives the word weights.
    """
    copies = docs.select(
        "doc_id", tokens(F.col(text)).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("sample")
    ).repartition("doc_id", "sample")
    rate = _unit(F.lit(seed), F.col("doc_id"), F.col("sample"))
    masked = copies.withColumn("rate", F.when(F.col("sample") == 0, 1.0).otherwise(rate)).select(
        "doc_id",
        "sample",
        F.filter(
            "t", lambda w: _unit(F.lit(seed), F.col("doc_id"), F.col("sample"), w) < F.col("rate")
        ).alias("kept"),
    )
    scored = score(masked.select("doc_id", "sample", F.array_join("kept", " ").alias("text")))
    words = masked.select("doc_id", "sample", F.array_distinct("kept").alias("words"))
    return (
        scored.join(words, ["doc_id", "sample"])
        .groupBy("doc_id")
        .applyInPandas(surrogate(top), "doc_id long, word string, weight double")
    )
