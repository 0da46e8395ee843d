"""Build train, valid and test sets from several labelled sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.clean import clean_text
from textloom.functions.labels import drop_blank, map_label
from textloom.operators.ranking import dedup_first
from textloom.operators.splitting import build_training_set, stratified_split, union_corpora
from textloom.session import materialize


@dataclass(frozen=True)
class Source:
    """A labelled source: its rows, column names, label mapping, and whether it is auxiliary."""

    name: str
    rows: DataFrame
    text: str
    label: str
    key: str
    mapping: Mapping
    auxiliary: bool = False


def harmonise(source: Source) -> DataFrame:
    """``(source, doc_id, text, label, auxiliary)``; rows without text or mapped label drop out."""
    mapped = source.rows.select(
        F.lit(source.name).alias("source"),
        F.col(source.key).cast("long").alias("doc_id"),
        F.col(source.text).alias("text"),
        map_label(F.col(source.label), source.mapping).alias("label"),
        F.lit(source.auxiliary).alias("auxiliary"),
    )
    return mapped.na.drop(subset=["text", "label"])


def build_corpus(
    sources: Sequence[Source], lexicon: DataFrame, seed: int = 42, phrases: DataFrame | None = None
) -> DataFrame:
    """Harmonise, clean, drop blanks, keep first copies, split main sources, add auxiliary ones.

    Cleaning is the costly part and its result is read several times, so the clean corpus is
    stored. Rows keep ``row_id``, which is unique, and ``source_rank`` and ``doc_id``, which order the corpus.
    """
    stacked = union_corpora([harmonise(s) for s in sources])
    # Documents of different sources may share an id: tokens are regrouped by both.
    keyed = stacked.withColumn("row_id", F.concat_ws("/", "source_rank", "doc_id"))
    stored = materialize(clean_text(keyed, lexicon, key="row_id", phrases=phrases), "clean-corpus")
    firsts = dedup_first(drop_blank(stored), "text", ["source_rank", "doc_id"])
    distinct = materialize(firsts, "distinct-corpus")
    main = stratified_split(distinct.filter(~F.col("auxiliary")), key="row_id", seed=seed)
    return build_training_set(main, distinct.filter("auxiliary")).drop("auxiliary")
