"""The cleaning chain and a scorer on a file stream give what they give on a table."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_DIR
from textloom.functions.clean import clean_text
from textloom.functions.labels import drop_blank
from textloom.functions.ngrams import word_analyzer
from textloom.operators.classifiers import MultinomialNB
from textloom.queries.registry import corpus, slang_frame
from textloom.operators.ranking import dedup_first
from textloom.streaming.online import clean_batches, clean_stream, first_texts, score_stream


@pytest.fixture
def arriving(spark, tmp_path):
    table = corpus(spark, SMALL_DIR).select("doc_id", "text", "label")
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    return table, spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))


def test_clean_stream(spark, arriving, tmp_path):
    table, stream = arriving
    cleaned = clean_stream(stream, slang_frame(spark)).select("doc_id", "text")
    query = (
        cleaned.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"), format="parquet")
    )
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = drop_blank(clean_text(table, slang_frame(spark))).select("doc_id", "text")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_score_stream(spark, arriving, tmp_path):
    table, stream = arriving
    model = MultinomialNB(word_analyzer(), 2, 1000).fit(table)
    query = score_stream(stream, model, str(tmp_path / "scores"), str(tmp_path / "cp"), availableNow=True)
    query.awaitTermination(120)
    got = {r.doc_id: r.score for r in spark.read.parquet(str(tmp_path / "scores")).collect()}
    want = {r.doc_id: r.score for r in model.score(table).collect()}
    assert got == pytest.approx(want)


def test_stateless_functions_need_no_batch(spark, arriving):
    from textloom.functions import profile

    _, stream = arriving
    flagged = stream.select("doc_id", profile.n_tokens(F.col("text")), profile.has_slang(F.col("text")))
    assert flagged.isStreaming


@pytest.fixture
def large_lexicon(spark):
    """More terms than are looked up in the row, and more than 5,000."""
    many = spark.range(6000).select(F.concat(F.lit("term"), "id").alias("term"), F.lit("x").alias("expansion"))
    return slang_frame(spark).unionByName(many)


def run_twice(start, spark, table, folder):
    """One run over the first files, then a restart over files that came later."""
    start().awaitTermination(120)
    table.write.mode("append").parquet(folder)
    start().awaitTermination(120)


def test_restarted_stream_with_a_large_lexicon_gives_the_batch_result(spark, arriving, large_lexicon, tmp_path):
    table, stream = arriving
    later = table.withColumn("doc_id", F.col("doc_id") + 100_000)

    def start():
        return clean_batches(stream, large_lexicon, str(tmp_path / "out"), str(tmp_path / "cp"), availableNow=True)

    run_twice(start, spark, later, str(tmp_path / "in"))
    got = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "text")
    want = drop_blank(clean_text(table.unionByName(later), large_lexicon)).select("doc_id", "text")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        clean_stream(stream, large_lexicon)


def test_first_texts_across_batches(spark, arriving, tmp_path):
    table, stream = arriving
    fresh = table.limit(20).select((F.col("doc_id") + 500_000).alias("doc_id"), F.concat("text", F.lit(" new")).alias("text"), "label")
    later = table.withColumn("doc_id", F.col("doc_id") + 100_000).unionByName(fresh)

    def start():
        return first_texts(stream, str(tmp_path / "first"), str(tmp_path / "cp"), availableNow=True)

    run_twice(start, spark, later, str(tmp_path / "in"))
    got = spark.read.parquet(str(tmp_path / "first" / "kept")).select("doc_id", "text")
    want = dedup_first(table.unionByName(later)).select("doc_id", "text")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
