"""Corpus statistics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.labels import label_or_missing, percent, ratio, strip_spaces
from textloom.functions.patterns import VI_STOPWORDS, VI_STOPWORDS_ASCII
from textloom.functions.profile import (
    has_emoji,
    has_slang,
    has_slang_norm,
    has_url,
    match_key,
    n_chars,
    n_tokens,
    no_diacritics,
    tokens,
)
from textloom.operators.ranking import text_key


def value_rows(spark: SparkSession, name: str, values: Sequence) -> DataFrame:
    """One row per listed value, in the order given by ``position``."""
    listed = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.posexplode(listed).alias("position", name))


def label_distribution(df: DataFrame, expected: Sequence, label: str = "label") -> DataFrame:
    """Count and percent of each expected label, zero-filled; percent is of all rows.

    One row of conditional counts, turned into a row per label: one scan and nothing to join.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(label) == F.lit(v)).alias(f"n{i}") for i, v in enumerate(expected)]
    )
    cells = F.array(*[F.struct(F.lit(v).alias(label), F.col(f"n{i}").alias("n")) for i, v in enumerate(expected)])
    return counted.select("total", F.inline(cells)).select(label, "n", percent(F.col("n"), F.col("total")).alias("pct"))


def binary_distribution(df: DataFrame, label: str = "binary") -> DataFrame:
    """Distribution over 0 and 1 among rows whose label could be mapped."""
    return label_distribution(df.filter(F.col(label).isNotNull()), [0, 1], label)


def split_label_pivot(
    df: DataFrame, expected: Sequence, label: str = "label", split: str = "split"
) -> DataFrame:
    """One row per split: total, one column per expected label, and the count of other labels."""
    is_known = F.col(label).isin(list(expected))
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("total_samples"),
        *[F.count_if(F.col(label) == F.lit(v)).alias(f"label_{v}") for v in expected],
        F.count_if(~F.coalesce(is_known, F.lit(False))).alias("unknown_labels"),
    )


def split_label_rollup(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Counts by label and split with totals per label, per split and overall, and percent of all."""
    cube = df.select(F.col(split), label_or_missing(F.col(label).cast("string")).alias(label)).cube(label, split)
    counted = cube.agg(
        F.grouping(label).alias("_all_labels"), F.grouping(split).alias("_all_splits"), F.count(F.lit(1)).alias("n")
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.select(
        F.when(F.col("_all_labels") == 1, "<all>").otherwise(F.col(label)).alias(label),
        F.when(F.col("_all_splits") == 1, "<all>").otherwise(F.col(split)).alias(split),
        "n",
        percent(F.col("n"), total, 2).alias("pct"),
    )


def label_cooccurrence(
    df: DataFrame, first: str, first_labels: Sequence, second: str, second_labels: Sequence
) -> DataFrame:
    """Count of every pair of two labels, zero-filled, in one pass."""
    counts = (
        df.filter(F.col(first).isin(list(first_labels)) & F.col(second).isin(list(second_labels)))
        .groupBy(first, second)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = value_rows(df.sparkSession, first, first_labels).select(
        first, F.explode(F.array(*[F.lit(v) for v in second_labels])).alias(second)
    )
    return cells.join(F.broadcast(counts), [first, second], "left").select(
        first, second, F.coalesce("n", F.lit(0)).alias("n")
    )


def unknown_labels(df: DataFrame, expected: Sequence, label: str = "label", split: str = "split") -> DataFrame:
    """Labels outside the expected list, null among them, with their count per split."""
    return (
        df.filter(~F.coalesce(F.col(label).isin(list(expected)), F.lit(False)))
        .groupBy(split, label)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.withColumn("weight", total["rows"] / (total["classes"] * F.col("n")))


def _length_aggs(prefix: str, length: Column) -> list[Column]:
    return [
        F.round(F.avg(length), 4).alias(f"avg_{prefix}"),
        F.min(length).alias(f"min_{prefix}"),
        F.max(length).alias(f"max_{prefix}"),
    ]


def length_stats(df: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Average, smallest and largest length in tokens and characters, overall or by group; null is empty."""
    known = F.coalesce(F.col(text), F.lit(""))
    measured = df.select(*by, n_tokens(known).alias("tokens"), n_chars(known).alias("chars"))
    return measured.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *_length_aggs("tokens", F.col("tokens")),
        *_length_aggs("chars", F.col("chars")),
    )


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    words = df.select(F.explode_outer(tokens(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count("word").alias("n")).filter(F.col("word").isNotNull())


def vocab_size(df: DataFrame, text: str = "text", approximate: bool = False) -> DataFrame:
    """Number of distinct words; the approximate form needs no shuffle of words."""
    if approximate:
        words = df.select(F.explode_outer(tokens(F.col(text))).alias("word"))
        return words.agg(F.approx_count_distinct("word", 0.01).alias("unique_words"))
    return word_counts(df, text).agg(F.count(F.lit(1)).alias("unique_words"))


def stopword_ratio(
    df: DataFrame, words: Sequence[str] | None = None, text: str = "text", by_key: bool = False
) -> DataFrame:
    """Stop-word tokens, all tokens and their ratio; the default words are Vietnamese.

    The exact form counts inside each row and shuffles nothing but totals. ``by_key`` compares
    match keys, computed once per distinct word.
    """
    if words is None:
        words = VI_STOPWORDS_ASCII if by_key else VI_STOPWORDS
    if by_key:
        counts = word_counts(df, text)
        hit = match_key(F.col("word")).isin(list(words))
        sums = counts.agg(F.sum(F.when(hit, F.col("n"))).alias("hits"), F.sum("n").alias("all"))
    else:
        found = df.select(tokens(F.col(text)).alias("t")).select(
            F.size("t").alias("n"), F.size(F.filter("t", lambda w: w.isin(list(words)))).alias("hits")
        )
        sums = found.agg(F.sum("hits").alias("hits"), F.sum("n").alias("all"))
    return sums.select(
        F.coalesce("hits", F.lit(0)).alias("stopword_tokens"),
        F.coalesce("all", F.lit(0)).alias("total_tokens"),
        ratio(F.col("hits"), F.col("all")).alias("stopword_ratio"),
    )


def flag_columns(text: Column) -> dict[str, Column]:
    return {
        "emoji": has_emoji(text),
        "url": has_url(text),
        "no_diacritics": no_diacritics(text),
        "slang": has_slang(text),
        "slang_norm": has_slang_norm(text),
    }


def flag_ratios(df: DataFrame, text: str = "text") -> DataFrame:
    """Share of documents with each flag, all in one pass; null is a text without flags."""
    flags = flag_columns(F.coalesce(F.col(text), F.lit("")))
    flagged = df.select(*[flag.cast("int").alias(name) for name, flag in flags.items()])
    return flagged.agg(*[F.round(F.avg(name), 6).alias(f"{name}_ratio") for name in flags])


def missing_audit(df: DataFrame, text: str = "text", label: str = "label", split: str = "split") -> DataFrame:
    """Per split: rows, rows without text, rows without label, number of labels."""
    trimmed = strip_spaces(F.col(label).cast("string"))
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(strip_spaces(F.coalesce(F.col(text), F.lit(""))) == "").alias("missing_text"),
        F.count_if(F.coalesce(trimmed, F.lit("")) == "").alias("missing_label"),
        F.count_distinct(F.nullif(trimmed, F.lit(""))).alias("unique_labels"),
    )


def duplicate_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Non-empty documents, distinct match keys, and the difference. Only hashes are shuffled."""
    keys = df.filter(strip_spaces(F.col(text)) != "").select(text_key(match_key(F.col(text))).alias("key"))
    copies = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def doc_freq(df: DataFrame, analyzer, text: str = "text") -> DataFrame:
    """Documents per feature. Features are made distinct inside the row, so a count is enough."""
    features = df.select(F.explode_outer(F.array_distinct(analyzer(F.col(text)))).alias("feature"))
    return features.groupBy("feature").agg(F.count("feature").alias("df")).filter(F.col("feature").isNotNull())


def _bin_label(start: Column, end: Column) -> Column:
    return F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start, end))


def histogram(values: DataFrame, value: str, width: int, cap: int) -> DataFrame:
    """Fixed-width bins from 0 to ``cap``, zero-filled; larger values are counted as omitted.

    The value ``cap`` itself falls in the last bin. The last row has the label 'omitted'.
    """
    bins = max(1, -(-cap // width))
    v = F.col(value)
    slot = F.when(v > cap, F.lit(bins)).otherwise(F.least(F.floor(v / width), F.lit(bins - 1)))
    counts = values.filter(v >= 0).groupBy(slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    b = F.col("bin")
    start, end = b * width, F.when(b == bins - 1, F.lit(cap)).otherwise(b * width + width - 1)
    return (
        values.sparkSession.range(bins + 1)
        .select(F.col("id").cast("int").alias("bin"))
        .join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            F.when(b == bins, F.lit("omitted")).otherwise(_bin_label(start, end)).alias("label"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def histogram_auto(values: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over the range of the values: at most ``bins``, at most one per integer.

    Values are first counted, so that the range and the bins both come from the small count table. Without values there
    is one bin, 0, that holds none.
    """
    counts = values.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = F.col("lo"), F.col("hi")
    spread = counts.select(value, "n", span["lo"].alias("lo"), span["hi"].alias("hi")).select(
        "*", F.least(F.lit(bins), hi - lo + 1).alias("bins"), ((hi - lo + 1) / F.least(F.lit(bins), hi - lo + 1)).alias("width")
    )
    slot = F.least(F.floor((F.col(value) - lo) / F.col("width")), F.col("bins") - 1)
    filled = spread.groupBy("lo", "hi", "bins", "width", slot.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    layout = filled.groupBy("lo", "hi", "bins", "width").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found")
    )
    b = F.col("bin")
    start = F.floor(lo + b * F.col("width"))
    end = F.when(b == F.col("bins") - 1, hi).otherwise(F.floor(lo + (b + 1) * F.col("width") - 1))
    found = layout.select("*", F.explode(F.sequence(F.lit(0), (F.col("bins") - 1).cast("int"))).alias("bin")).select(
        "bin", _bin_label(start, end).alias("label"), F.coalesce(F.try_element_at("found", b), F.lit(0)).alias("n")
    )
    # One row from an aggregate of nothing: the empty bin, kept only if there is no other.
    empty = counts.agg(F.min(value).alias("lo")).where("lo is null").select(
        F.lit(0).alias("bin"), F.lit("0").alias("label"), F.lit(0).cast("long").alias("n")
    )
    return found.unionByName(empty)


def score_stats(scores: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    return scores.groupBy(*by).agg(
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score")
    )
