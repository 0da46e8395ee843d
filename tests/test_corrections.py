"""Nulls, duplicates and encodings: inputs that the generated tables do not hold."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import clean
from textloom.operators import aggregates, evaluate, phrases, ranking
from textloom.sources import readers


@pytest.mark.parametrize("inline", [5000, 0])
def test_lexicon_with_duplicates_and_nulls(spark, monkeypatch, inline):
    monkeypatch.setattr(clean, "INLINE_LEXICON", inline)
    lexicon = spark.createDataFrame([("ko", "khong"), ("ko", "k2"), ("x", None)], "term string, expansion string")
    docs = spark.createDataFrame([(1, "a ko b x")], "doc_id long, text string")
    assert clean.expand_slang(docs, lexicon).first().text == "a khong b x"


@pytest.mark.parametrize("inline", [20000, 0])
def test_phrases_of_rows_that_share_a_document_id(spark, monkeypatch, inline):
    monkeypatch.setattr(phrases, "INLINE_PHRASES", inline)
    known = spark.createDataFrame([("new", "york"), ("new", "york"), ("new", None)], "first string, second string")
    rows = [("0/1", 1, "new york is big"), ("1/1", 1, "god new york")]
    docs = spark.createDataFrame(rows, "row_id string, doc_id long, text string")
    none = spark.createDataFrame([], "term string, expansion string")
    got = {r.row_id: r.text for r in clean.clean_text(docs, none, key="row_id", phrases=known).collect()}
    assert got == {"0/1": "new_york is big", "1/1": "god new_york"}


def test_null_texts_and_labels(spark):
    rows = [(1, None, "train", None), (2, None, "train", 7), (3, "a b", "train", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, split string, label int")
    assert sorted(r.doc_id for r in ranking.dedup_first(df).collect()) == [1, 3]
    assert {r.label for r in aggregates.unknown_labels(df, [0, 1]).collect()} == {None, 7}
    stats = aggregates.length_stats(df).first()
    assert (stats.n, stats.avg_chars, stats.min_chars) == (3, 1.0, 0)
    none = df.limit(0).select("label", F.lit(0.5).alias("score"))
    assert tuple(evaluate.tune_threshold(none, by=()).first()) == (0.0, 0.0)


def test_code_page_and_lexicon_lines(spark, tmp_path):
    page = tmp_path / "page.csv"
    page.write_bytes("text\nđư ơ é\n".encode("cp1258"))
    assert readers.read_csv_fallback(spark, str(page)).first().text == "đư ơ é"
    lexicon = tmp_path / "lexicon.txt"
    lexicon.write_text("ko\t\nk\tkhong\n")
    assert [tuple(r)[:2] for r in readers.read_lexicon(spark, str(lexicon)).collect()] == [("k", "khong")]


def test_adaptive_histogram_of_nothing(spark):
    from textloom.operators.aggregates import histogram_auto

    nothing = spark.createDataFrame([(None,)], "v int")
    assert [tuple(r) for r in histogram_auto(nothing, "v").collect()] == [(0, "0", 0)]
    assert [tuple(r) for r in histogram_auto(nothing.limit(0), "v").collect()] == [(0, "0", 0)]
    one = spark.createDataFrame([(4,), (4,)], "v int")
    assert [tuple(r) for r in histogram_auto(one, "v").collect()] == [(0, "4", 2)]
