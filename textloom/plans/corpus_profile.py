"""Profile of a labelled corpus as one nested row, from two passes over the texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.labels import percent, ratio, strip_spaces
from textloom.functions.profile import has_emoji, has_slang, has_url, n_chars, n_tokens, no_diacritics
from textloom.operators.aggregates import duplicate_count, word_counts
from textloom.operators.ranking import top_words


def _document_totals(docs: DataFrame, labels: Sequence, text: str, label: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    flags = {"no_diacritics": no_diacritics(t), "emoji": has_emoji(t), "url": has_url(t), "slang": has_slang(t)}
    measured = docs.select(
        F.col(label).alias("label"),
        n_tokens(t).alias("tokens"),
        n_chars(t).alias("chars"),
        (strip_spaces(t) == "").alias("empty"),
        *[flag.alias(name) for name, flag in flags.items()],
    )
    return measured.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col("label") == F.lit(v)).alias(f"label_{i}") for i, v in enumerate(labels)],
        *[f(c).alias(f"{n}_{c}") for c in ("tokens", "chars") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))],
        *[F.count_if(F.col(c)).alias(c) for c in ("empty", *flags)],
    )


def corpus_profile(
    docs: DataFrame,
    labels: Sequence,
    stopwords: Sequence[str],
    text: str = "text",
    label: str = "label",
    top: int = 30,
) -> DataFrame:
    """One row: label counts, lengths, vocabulary and text properties, nested as in a report.

    Document measures, word counts and match keys are three aggregates, each ending in one row;
    the rows are stacked and folded into one, so nothing is joined.
    """
    documents = _document_totals(docs, labels, text, label).select(F.struct("*").alias("d"))
    counts = word_counts(docs, text)
    words = counts.agg(
        F.struct(
            F.count(F.lit(1)).alias("unique"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("word").isin(list(stopwords)), F.col("n"))), F.lit(0)).alias("stop"),
        ).alias("w")
    )
    frequent = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "word", F.col("n").alias("count"))))
    listed = top_words(counts, top).agg(
        F.transform(frequent, lambda e: F.struct(e["word"].alias("word"), e["count"].alias("count"))).alias("top")
    )
    copies = duplicate_count(docs, text).select(F.col("duplicates").alias("copies"))
    folded = documents
    for part in (words, listed, copies):
        folded = folded.unionByName(part, allowMissingColumns=True)
    one = folded.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("d", "w", "top", "copies")])
    rows = F.col("d.rows")

    def by_label(value) -> Column:
        pairs = [part for i, v in enumerate(labels) for part in (F.lit(str(v)), value(F.col(f"d.label_{i}")))]
        return F.create_map(*pairs)

    return one.select(
        rows.alias("total_samples"),
        by_label(lambda n: n).alias("samples_per_label"),
        by_label(lambda n: percent(n, rows)).alias("class_distribution_percent"),
        F.struct(
            *[F.round(f"d.avg_{c}", 4).alias(f"avg_{c}") for c in ("tokens", "chars")],
            *[F.col(f"d.{m}_{c}").alias(f"{m}_{c}") for c in ("tokens", "chars") for m in ("min", "max")],
        ).alias("length"),
        F.struct(
            F.col("w.unique").alias("unique_words"),
            F.col("top").alias("top_frequent_words"),
            F.col("w.stop").alias("stopword_tokens"),
            ratio(F.col("w.stop"), F.col("w.total")).alias("stopword_ratio"),
            ratio(F.col("d.slang"), rows).alias("slang_ratio"),
        ).alias("vocabulary"),
        F.struct(
            F.col("d.empty").alias("empty_texts"),
            F.col("copies").alias("duplicate_texts"),
            *[percent(F.col(f"d.{c}"), rows).alias(f"pct_{c}") for c in ("no_diacritics", "emoji", "url")],
        ).alias("text_properties"),
    )


def two_label_profile(docs: DataFrame, labels: Mapping[str, Sequence], split: str = "split") -> DataFrame:
    """Per split: rows and the count of every value of several independent labels."""
    return docs.groupBy(split).agg(
        F.count(F.lit(1)).alias("total_samples"),
        *[F.count_if(F.col(c) == F.lit(v)).alias(f"{c}_{v}") for c, values in labels.items() for v in values],
    )
