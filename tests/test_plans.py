"""Physical plans. That no query joins without a key is checked with its rows, in test_oracle."""

import os
import re

import pytest

from tests.conftest import SMALL_DIR
from textloom.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_DIR), reason="test tables are absent")

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["label_distribution", "unknown_labels", "stratified_split", "label_map"])
def test_label_queries_do_not_read_text(spark, name):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES[name](spark, SMALL_DIR)))
    assert schemas and all("text" not in s for s in schemas)


def test_text_functions_add_no_shuffle(spark):
    from pyspark.sql import functions as F

    from textloom.functions.clean import clean_text
    from textloom.queries.registry import slang_frame, table

    cleaned = clean_text(table(spark, SMALL_DIR, "documents"), slang_frame(spark))
    assert "Exchange" not in plan_of(cleaned)
    assert plan_of(cleaned.select(F.length("text"))).count("ArrowEvalPython") == 1


def test_stored_corpus_is_grouped_without_a_shuffle(spark):
    from textloom.functions.ngrams import word_analyzer
    from textloom.operators.features import term_counts
    from textloom.queries.registry import corpus
    from textloom.session import store_by_doc

    stored = store_by_doc(corpus(spark, SMALL_DIR).select("doc_id", "text"), "plan_test")
    assert "Exchange" not in plan_of(term_counts(stored, word_analyzer()))


def test_partitioned_corpus_is_shuffled_once(spark):
    from textloom.functions.ngrams import word_analyzer
    from textloom.operators.features import term_counts
    from textloom.queries.registry import feature_corpus

    plan = plan_of(term_counts(feature_corpus(spark, SMALL_DIR), word_analyzer()))
    assert plan.count("Exchange hashpartitioning") == 1


def test_vocabulary_is_broadcast_by_its_stored_size(spark):
    from textloom.functions.ngrams import word_analyzer
    from textloom.operators.features import build_vocabulary, in_vocab, term_counts
    from textloom.queries.registry import feature_corpus

    docs = feature_corpus(spark, SMALL_DIR)
    vocabulary = build_vocabulary(docs, word_analyzer(), 2, 1000)
    assert "BroadcastHashJoin [feature" in plan_of(in_vocab(term_counts(docs, word_analyzer()), vocabulary))


def test_unlabelled_documents_stay_behind_before_the_shuffle(spark):
    from textloom.queries.registry import feature_corpus

    plan = plan_of(feature_corpus(spark, SMALL_DIR))
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")  # the join is below the exchange


@pytest.mark.parametrize("name", ["term_counts", "tfidf_log", "encode_sequence", "mean_pool", "hashed_features"])
def test_all_documents_are_encoded(spark, name):
    from pyspark.sql import functions as F

    found = QUERIES[name](spark, SMALL_DIR).agg(F.count_distinct("doc_id")).first()[0]
    assert found >= spark.read.parquet(f"{SMALL_DIR}/documents.parquet").where("length(text) > 100").count() - 1
