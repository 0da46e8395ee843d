"""The row-local functions and the scorers on a stream of documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.functions.clean import clean_text
from textloom.functions.labels import drop_blank
from textloom.operators.classifiers import LinearModel
from textloom.operators.ranking import dedup_first, text_key
from textloom.session import materialize
from textloom.sources.readers import path_exists


def clean_stream(stream: DataFrame, lexicon: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Clean documents as they arrive. The chain is stateless, for lexicons that are looked up in the row."""
    return drop_blank(clean_text(stream, lexicon, text, key), text)


def clean_batches(
    stream: DataFrame,
    lexicon: DataFrame,
    path: str,
    checkpoint: str,
    text: str = "text",
    key: str = "doc_id",
    phrases: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Clean each micro-batch with a lexicon and phrases of any size and store it under its batch number.

    Larger tables regroup words by document, which a micro-batch holds whole; ``key`` must be unique in it. A batch that
    runs again after a failure overwrites its own folder, so no document is stored twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        cleaned = drop_blank(clean_text(batch, lexicon, text, key, phrases), text)
        cleaned.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _each(stream, store, checkpoint, trigger)


def first_texts(
    stream: DataFrame, path: str, checkpoint: str, text: str = "text", order: Sequence[str] = ("doc_id",), **trigger
) -> StreamingQuery:
    """Keep the first document of each text over all batches, stored under its batch number.

    Within a batch the first by ``order`` counts, as in ``dedup_first``; across batches the earlier batch. Hashes of kept
    texts are stored next to each batch, and a batch looks up those of earlier batches only, so a batch that runs again
    gives the same rows. Null texts are one text of their own.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = dedup_first(batch, text, order).withColumn("_h", text_key(F.col(text)))
        if path_exists(spark, f"{path}/seen"):
            seen = spark.read.schema("h string, batch long").parquet(f"{path}/seen").where(F.col("batch") < number)
            first = first.join(seen.select(F.col("h").alias("_h")), "_h", "left_anti")
        first = materialize(first, "first-texts")
        first.select(F.col("_h").alias("h")).write.mode("overwrite").parquet(f"{path}/seen/batch={number}")
        first.drop("_h").write.mode("overwrite").parquet(f"{path}/kept/batch={number}")

    return _each(stream, store, checkpoint, trigger)


def _each(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def score_stream(
    stream: DataFrame,
    model: LinearModel,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    **trigger,
) -> StreamingQuery:
    """Score each micro-batch and store it under its batch number.

    Scoring regroups terms by document, which a micro-batch holds whole. A batch that runs again
    after a failure overwrites its own folder, so no score is stored twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        model.score(batch, keys, text).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _each(stream, store, checkpoint, trigger)
