"""Features in long form: one row per (document, feature), never one wide vector per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.ngrams import Analyzer
from textloom.operators.ranking import top_features
from textloom.session import BROADCAST_BYTES, materialize


def term_counts(
    docs: DataFrame, analyzer: Analyzer, keys: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``(keys, feature, tf)``. A document without features keeps one row with a null feature.

    ``explode_outer`` also keeps the optimizer from deriving a filter on the feature array, which
    would compute every n-gram a second time.
    """
    features = docs.select(*keys, F.explode_outer(analyzer(F.col(text))).alias("feature"))
    return features.groupBy(*keys, "feature").agg(F.count(F.lit(1)).alias("tf"))


def feature_stats(
    docs: DataFrame, analyzer: Analyzer, label: str = "label", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per feature: documents (df) and occurrences (cf), overall and for labels 0 and 1.

    Everything a count-based model needs comes from this one pass.
    """
    counts = term_counts(docs, analyzer, (key, label), text).filter(F.col("feature").isNotNull())

    def of(value: int, amount: Column) -> Column:
        return F.sum(F.when(F.col(label) == value, amount).otherwise(0))

    return counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("cf"),
        of(0, F.lit(1)).alias("df0"),
        of(1, F.lit(1)).alias("df1"),
        of(0, F.col("tf")).alias("cf0"),
        of(1, F.col("tf")).alias("cf1"),
    )


def build_vocabulary(
    docs: DataFrame,
    analyzer: Analyzer,
    min_df: int = 2,
    max_features: int = 50000,
    by: str = "df",
    label: str = "label",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The first ``max_features`` features with df of at least ``min_df``, stored.

    Columns: feature, idx, and the counts of :func:`feature_stats`. The stored table is bounded by
    ``max_features``, and its file size decides whether joins with it broadcast. The statistics are
    stored first: the top-k reads them twice, and extracting features again would cost far more.
    """
    stats = feature_stats(docs, analyzer, label, key, text).filter(F.col("df") >= min_df)
    stats = materialize(stats, "feature-stats")
    return materialize(top_features(stats, max_features, by), "vocabulary", BROADCAST_BYTES)


def in_vocab(features: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows whose feature is in the vocabulary."""
    return features.join(vocabulary.select("feature"), "feature", "left_semi")


def smooth_idf(df: Column, n_docs: int | Column) -> Column:
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return F.log((1.0 + n) / (1.0 + df)) + 1.0


def idf_table(vocabulary: DataFrame, n_docs: int) -> DataFrame:
    return vocabulary.select("feature", "df", smooth_idf(F.col("df"), n_docs).alias("idf"))


def tfidf(counts: DataFrame, idf: DataFrame, log_tf: bool = True, key: str = "doc_id") -> DataFrame:
    """L2-normalised TF-IDF of ``counts`` over the features of ``idf``.

    The norm is a window over one document at a time; with counts partitioned by document no
    shuffle is added.
    """
    tf = 1.0 + F.log("tf") if log_tf else F.col("tf")
    weighted = counts.join(idf.select("feature", "idf"), "feature").withColumn("_raw", tf * F.col("idf"))
    square = F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key))
    norm = F.when(square > 0, F.sqrt(square)).otherwise(1.0)
    return weighted.withColumn("value", F.col("_raw") / norm).drop("_raw", "idf", "tf")


def hashed_counts(
    docs: DataFrame,
    analyzer: Analyzer,
    n_buckets: int = 2**20,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """``(keys, bucket, n)`` with bucket = crc32 of the UTF-8 feature modulo ``n_buckets``."""
    features = docs.select(*keys, F.explode_outer(analyzer(F.col(text))).alias("feature"))
    # Strings are stored as UTF-8: the cast reads their bytes in place, encoding would decode and encode every feature.
    bucket = (F.crc32(F.col("feature").cast("binary")) % n_buckets).cast("int").alias("bucket")
    return features.select(*keys, bucket).groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"))


def hashed_features(
    docs: DataFrame, analyzer: Analyzer, n_buckets: int = 2**20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Hashed counts, L2-normalised per document."""
    counts = hashed_counts(docs, analyzer, n_buckets, (key,), text).filter(F.col("bucket").isNotNull())
    norm = F.sqrt(F.sum(F.col("n") * F.col("n")).over(Window.partitionBy(key)).cast("double"))
    return counts.withColumn("value", F.col("n") / norm).drop("n")


# Fixed value: characters that separate words when sequences are encoded, as a character class.
SEQUENCE_FILTER = r"[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]"


def sequence_words(text: Column, separators: str = SEQUENCE_FILTER) -> Column:
    """Lower-cased words split at spaces after the separators became spaces."""
    words = F.split(F.regexp_replace(F.lower(text), separators, " "), " ")
    return F.filter(words, lambda w: w != "")


def sequence_vocabulary(train: DataFrame, cap: int = 25000, text: str = "text", separators: str = SEQUENCE_FILTER) -> DataFrame:
    """``(word, id)``: ids from 2 by falling frequency (ties by word); 1 is for unknown words.

    Only ids below ``cap`` are kept: words beyond it are encoded as unknown.
    """
    words = train.select(F.explode_outer(sequence_words(F.col(text), separators)).alias("feature"))
    counts = words.groupBy("feature").agg(F.count("feature").alias("n")).filter(F.col("feature").isNotNull())
    counts = materialize(counts, "word-counts")
    top = top_features(counts, cap - 2, by="n")
    return materialize(top.select(F.col("feature").alias("word"), (F.col("idx") + 2).alias("id")), "sequence-vocabulary", BROADCAST_BYTES)


def encode_sequence(
    docs: DataFrame,
    vocabulary: DataFrame,
    length: int = 80,
    key: str = "doc_id",
    text: str = "text",
    separators: str = SEQUENCE_FILTER,
) -> DataFrame:
    """``(key, ids)``: word ids cut or zero-padded at the end to a fixed length.

    Words past ``length`` cannot enter the result and are not looked up.
    """
    words = docs.select(key, F.posexplode_outer(F.slice(sequence_words(F.col(text), separators), 1, length)).alias("pos", "word"))
    coded = words.join(vocabulary, "word", "left").select(
        key, F.when(F.col("word").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(1)).cast("int").alias("id"))).alias("item")
    )
    ids = F.array_sort(F.collect_list("item"))["id"]
    return coded.groupBy(key).agg(ids.alias("ids")).select(
        key, F.slice(F.concat("ids", F.array_repeat(F.lit(0), length)), 1, length).alias("ids")
    )


def fit_standardizer(train: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: arrays of means and population deviations, one entry per dimension."""
    dims = train.select(F.posexplode(vector).alias("dim", "x"))
    stats = dims.groupBy("dim").agg(
        F.avg(F.col("x").cast("double")).alias("mean"), F.stddev_pop(F.col("x").cast("double")).alias("sd")
    )
    ordered = F.array_sort(F.collect_list(F.struct("dim", "mean", "sd")))
    return stats.agg(ordered.alias("stats"))


def standardize(df: DataFrame, stats: DataFrame, vector: str = "embedding") -> DataFrame:
    """Mean 0, deviation 1 with fitted stats; a constant dimension is only centred. No shuffle."""
    scaled = F.zip_with(
        vector, "_stats", lambda x, s: (x - s["mean"]) / F.when(s["sd"] > 0, s["sd"]).otherwise(1.0)
    )
    return df.withColumn("_stats", stats.scalar()).withColumn(vector, scaled).drop("_stats")


def embedding_table(vocabulary: DataFrame, vectors: DataFrame, cap: int = 25000) -> DataFrame:
    """Word vectors of the words whose vocabulary id is below ``cap``, stored: at most cap rows.

    25,000 vectors of 300 floats are about 30 MB. Broadcasting them keeps documents where they are;
    a join by word would send every document that holds a common word to one task.
    """
    wanted = vocabulary.filter(F.col("id") < cap)
    return materialize(wanted.join(vectors, "word").select("word", "id", "vec"), "embeddings", BROADCAST_BYTES)


def vector_coverage(vocabulary: DataFrame, vectors: DataFrame, cap: int = 25000) -> DataFrame:
    """Words with a vector, words that could have one, and their ratio."""
    known = vocabulary.join(vectors.select("word", F.lit(1).alias("hit")), "word", "left")
    able = F.least(F.count(F.lit(1)), F.lit(cap))
    hits = F.count_if((F.col("hit") == 1) & (F.col("id") < cap))
    return known.agg(hits.alias("hits"), able.alias("vocabulary"), F.round(hits / able, 6).alias("coverage"))


def mean_pool(
    docs: DataFrame, vectors: DataFrame, analyzer: Analyzer, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_words, vec)``: mean of the vectors of a document's words, weighted by their counts.

    A sum for each dimension, of which a hash aggregate keeps one row per document: the vectors next to the words are
    neither sorted nor shuffled nor spilled. All vectors have one length; documents without a known word have 0 words and
    no vector.
    """
    counts = term_counts(docs, analyzer, (key,), text)
    table = vectors.select(F.col("word").alias("feature"), F.col("vec").cast("array<double>").alias("vec"))
    size = table.agg(F.max(F.size("vec"))).first()[0] or 0
    known = F.when(F.col("vec").isNotNull(), F.col("tf"))
    sums = [F.sum(F.col("tf") * F.get("vec", i)).alias(f"_{i}") for i in range(size)]
    pooled = counts.join(table, "feature", "left").groupBy(key).agg(F.coalesce(F.sum(known), F.lit(0)).alias("n_words"), *sums)
    mean = F.array(*[F.col(f"_{i}") / F.col("n_words") for i in range(size)]).cast("array<double>")
    return pooled.select(key, "n_words", F.when(F.col("n_words") > 0, mean).alias("vec"))
