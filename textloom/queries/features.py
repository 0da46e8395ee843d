"""Queries for features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import ngrams
from textloom.operators import features
from textloom.queries.registry import (
    ALL_DOCS,
    ALL_TERMS,
    TRAIN_ROWS,
    WORD_TERMS,
    feature_corpus,
    query,
    split_of,
    split_sql,
    table,
    train_rows,
    vocabulary_sql,
)

WORDS_12 = ngrams.word_analyzer(1, 2)


VOCABULARY = vocabulary_sql("vocab", 2, 20000, TRAIN_ROWS)


@query(
    "vocabulary",
    f"WITH {WORD_TERMS}, {vocabulary_sql('vocab', 2, 20000)} SELECT feature, df, CAST(idx AS INTEGER) AS idx FROM vocab",
)
def vocabulary(spark, sf_dir):
    train = train_rows(feature_corpus(spark, sf_dir))
    return features.build_vocabulary(train, WORDS_12, 2, 20000).select("feature", "df", "idx")


@query(
    "vocab_filter",
    f"""WITH {ALL_TERMS}, {VOCABULARY}
        SELECT doc_id, count(*) AS n_features, CAST(sum(tf) AS BIGINT) AS n_terms
        FROM tc WHERE feature IN (SELECT feature FROM vocab) GROUP BY doc_id""",
)
def vocab_filter(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir, "left")
    vocab = features.build_vocabulary(train_rows(docs), WORDS_12, 2, 20000)
    kept = features.in_vocab(features.term_counts(docs, WORDS_12), vocab)
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_features"), F.sum("tf").alias("n_terms"))


@query(
    "term_counts",
    f"""WITH {ALL_TERMS}, {VOCABULARY}
        SELECT doc_id, feature, tf FROM tc WHERE feature IN (SELECT feature FROM vocab)""",
)
def term_counts(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir, "left")
    vocab = features.build_vocabulary(train_rows(docs), WORDS_12, 2, 20000)
    return features.in_vocab(features.term_counts(docs, WORDS_12), vocab).select("doc_id", "feature", "tf")


IDF_SQL = f"ln((1.0 + (SELECT count(*) FROM corpus WHERE {TRAIN_ROWS})) / CAST(1 + df AS DOUBLE)) + 1"


@query(
    "idf",
    f"""WITH {WORD_TERMS}, {vocabulary_sql('vocab', 2, 20000)}
        SELECT feature, df, round({IDF_SQL}, 6) AS idf FROM vocab""",
)
def idf(spark, sf_dir):
    train = train_rows(feature_corpus(spark, sf_dir))
    vocab = features.build_vocabulary(train, WORDS_12, 2, 20000)
    return features.idf_table(vocab, train.count()).withColumn("idf", F.round("idf", 6))


def tfidf_sql(tf: str) -> str:
    return f"""raw AS (SELECT doc_id, tc.feature, {tf} * ({IDF_SQL}) AS v FROM tc JOIN vocab USING (feature)),
  norms AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM raw GROUP BY doc_id)
  SELECT raw.doc_id, feature, round(v / CASE WHEN norm > 0 THEN norm ELSE 1 END, 6) AS value
  FROM raw JOIN norms ON raw.doc_id = norms.doc_id"""


@query(
    "tfidf_log",
    f"WITH {ALL_TERMS}, {VOCABULARY}, {tfidf_sql('(1 + ln(tf))')}",
)
def tfidf_log(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir, "left")
    train = train_rows(docs)
    table_ = features.idf_table(features.build_vocabulary(train, WORDS_12, 2, 20000), train.count())
    vectors = features.tfidf(features.term_counts(docs, WORDS_12), table_)
    return vectors.select("doc_id", "feature", F.round("value", 6).alias("value"))


LONG_TERMS = ALL_TERMS.replace("AS t FROM corpus)", "AS a FROM corpus)").replace(
    "unnest(t) AS w, generate_subscripts(t, 1) AS pos\n            FROM (SELECT",
    "unnest(t) AS w, generate_subscripts(t, 1) AS pos\n            FROM (SELECT *, list_filter(a, lambda x: length(x) >= 2) AS t FROM (SELECT",
).replace("AS a FROM corpus)", "AS a FROM corpus))")


@query(
    "tfidf_raw",
    f"""WITH {LONG_TERMS},
  vocab AS (SELECT feature, count(*) AS df, sum(tf) AS cf FROM tc WHERE {TRAIN_ROWS} GROUP BY feature
            ORDER BY cf DESC, feature LIMIT 15000), {tfidf_sql('tf')}""",
)
def tfidf_raw(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir, "left")
    train = train_rows(docs)
    analyzer = ngrams.long_word_analyzer(1, 2)
    vocab = features.build_vocabulary(train, analyzer, 1, 15000, by="cf")
    vectors = features.tfidf(features.term_counts(docs, analyzer), features.idf_table(vocab, train.count()), False)
    return vectors.select("doc_id", "feature", F.round("value", 6).alias("value"))


# crc32 in SQL: a table of 256 entries, each from eight shift steps, then one step per byte.
CRC_TABLE = """crc_steps AS (SELECT list_transform(range(256), lambda i: list_reduce(
      [i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab)"""


HASHED_SQL = f"""{CRC_TABLE},
  names AS (SELECT DISTINCT feature FROM tc),
  coded AS (SELECT feature, hex(encode(feature)) AS h, length(hex(encode(feature))) // 2 AS n FROM names),
  crcs AS (SELECT feature, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS crc FROM coded, crc_steps),
  buckets AS (SELECT doc_id, CAST(crc % 1048576 AS INTEGER) AS bucket, sum(tf) AS n FROM tc JOIN crcs USING (feature) GROUP BY ALL),
  norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM buckets GROUP BY doc_id)"""


@query(
    "hashed_features",
    f"""WITH {ALL_TERMS}, {HASHED_SQL}
  SELECT b.doc_id, bucket, round(n / norm, 6) AS value FROM buckets b JOIN norms ON b.doc_id = norms.doc_id""",
)
def hashed_features(spark, sf_dir):
    vectors = features.hashed_features(feature_corpus(spark, sf_dir, "left"), WORDS_12)
    return vectors.select("doc_id", "bucket", F.round("value", 6).alias("value"))


SEQ_WORDS = """list_filter(string_split(regexp_replace(lower(text), '[!"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~\\t\\n]', ' ', 'g'), ' '),
    lambda w: w <> '')"""


@query(
    "encode_sequence",
    f"""WITH {ALL_DOCS},
  seqs AS (SELECT doc_id, split, label, {SEQ_WORDS} AS ws FROM corpus),
  vocab AS (SELECT w, row_number() OVER (ORDER BY count(*) DESC, w) + 1 AS id
            FROM (SELECT unnest(ws) AS w FROM seqs WHERE {TRAIN_ROWS}) GROUP BY w QUALIFY id < 25000),
  items AS (SELECT doc_id, unnest(ws[:80]) AS w, generate_subscripts(ws[:80], 1) AS pos FROM seqs),
  ids AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS a FROM items LEFT JOIN vocab ON vocab.w = items.w GROUP BY doc_id)
  SELECT s.doc_id, array_to_string(list_resize(coalesce(a, []), 80, 0), ' ') AS ids
  FROM seqs s LEFT JOIN ids ON s.doc_id = ids.doc_id""",
)
def encode_sequence(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir, "left")
    vocab = features.sequence_vocabulary(train_rows(docs))
    return features.encode_sequence(docs, vocab).select("doc_id", F.array_join("ids", " ").alias("ids"))


@query(
    "standardize",
    f"""WITH v AS (SELECT vec_id, {split_sql('vec_id')} AS split, unnest(embedding)::DOUBLE AS x,
              generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
  s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM v WHERE split = 'train' GROUP BY dim)
  SELECT vec_id, CAST(v.dim AS INTEGER) AS dim, round((x - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 6) AS value
  FROM v JOIN s ON v.dim = s.dim""",
)
def standardize(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    train = vectors.filter(split_of(F.col("vec_id")) == "train")
    scaled = features.standardize(vectors, features.fit_standardizer(train))
    return scaled.select("vec_id", F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.round("value", 6))


def word_vectors(spark, sf_dir, vocab):
    """Word vectors for the test tables: the word with id i gets embedding i - 2, if there is one."""
    vectors = table(spark, sf_dir, "embeddings").select((F.col("vec_id") + 2).alias("id"), F.col("embedding").alias("vec"))
    return vocab.join(vectors, "id").select("word", "vec")


SEQ_VOCAB = f"""{ALL_DOCS},
  seqs AS (SELECT doc_id, split, label, {SEQ_WORDS} AS ws FROM corpus),
  vocab AS (SELECT w, row_number() OVER (ORDER BY count(*) DESC, w) + 1 AS id
            FROM (SELECT unnest(ws) AS w FROM seqs WHERE {TRAIN_ROWS}) GROUP BY w QUALIFY id < 25000),
  vectors AS (SELECT w, id, embedding FROM vocab JOIN embeddings ON vec_id + 2 = id)"""


@query(
    "vector_coverage",
    f"""WITH {SEQ_VOCAB} SELECT h AS hits, n AS vocabulary, round(h / CAST(n AS DOUBLE), 6) AS coverage
        FROM (SELECT (SELECT count(*) FROM vectors WHERE id < 400) AS h, least((SELECT count(*) FROM vocab), 400) AS n)""",
)
def vector_coverage(spark, sf_dir):
    vocab = features.sequence_vocabulary(train_rows(feature_corpus(spark, sf_dir)))
    return features.vector_coverage(vocab, word_vectors(spark, sf_dir, vocab), cap=400)


@query(
    "mean_pool",
    f"""WITH {SEQ_VOCAB},
  counts AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS w FROM seqs) GROUP BY ALL),
  flat AS (SELECT doc_id, tf, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim
           FROM counts JOIN vectors ON vectors.w = counts.w)
  SELECT doc_id, CAST(dim AS INTEGER) AS dim, CAST(sum(tf) AS BIGINT) AS n_words, round(sum(tf * x) / sum(tf), 6) AS value
  FROM flat GROUP BY doc_id, dim
  UNION ALL SELECT doc_id, NULL, 0, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM flat)""",
)
def mean_pool(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir, "left")
    vocab = features.sequence_vocabulary(train_rows(docs))
    vectors = features.embedding_table(vocab, word_vectors(spark, sf_dir, vocab))
    pooled = features.mean_pool(docs, vectors, features.sequence_words)
    return pooled.select("doc_id", "n_words", F.posexplode_outer("vec").alias("dim", "value")).withColumn(
        "value", F.round("value", 6)
    )
