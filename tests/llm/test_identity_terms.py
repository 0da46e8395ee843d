"""Singular group names take part in the counterfactuals."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import toxicity

rng = random.Random(7)
VOCAB = ["".join(rng.choice("abcde") for _ in range(rng.randint(3, 7))) for _ in range(60)]


def words(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def test_a_term_is_in_one_list():
    terms = [t for group in toxicity.IDENTITY_TERMS for t in group]
    assert len(terms) == len(set(terms)) and all(len(group) > 1 for group in toxicity.IDENTITY_TERMS)


@pytest.mark.parametrize("term, other", [("woman", "man"), ("mujer", "hombre")])
def test_singular_names_are_swapped(spark, term, other):
    toxic = [f"{rng.choice(['scum', 'idiot'])} {rng.choice([term, term, words(1)])} {words(8)}" for _ in range(150)]
    clean = [words(10) for _ in range(300)] + [f"{other} {words(8)}" for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(toxic + clean)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 150).cast("int").alias("toxic"))
    probe = pa.array([f"{term} {words(6)}"])
    fair, plain = (toxicity.fit(docs, labels, penalty=p).scores(probe)[0] for p in (50.0, 0.0))
    assert fair < 0.3 and fair < plain
