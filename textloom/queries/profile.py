"""Queries for corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import ngrams, profile
from textloom.functions.labels import map_label
from textloom.functions.patterns import LATIN_STOPWORDS
from textloom.operators import aggregates, ranking
from textloom.plans.corpus_profile import corpus_profile, two_label_profile
from textloom.queries.registry import (
    ALL_DOCS,
    ALL_TERMS,
    CORPUS,
    INJECTED,
    corpus,
    documents,
    injected,
    match_key_sql,
    query,
    split_of,
    table,
    tokens_sql,
)
from textloom.queries.text import LANG_MAP, PLAIN_SQL, SLANG_KEY_SQL, SLANG_SQL, EMOJI, HAS_URL

LANGS = ["de", "en", "fr", "it"]
LANGS_SQL = "(VALUES ('de'), ('en'), ('fr'), ('it')) AS v(lang)"
STOPWORDS = sorted(set(LATIN_STOPWORDS))
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"


@query(
    "label_distribution",
    f"""SELECT v.lang, count(d.doc_id) AS n,
         round(count(d.doc_id) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 4) AS pct
       FROM {LANGS_SQL} LEFT JOIN documents d ON d.lang = v.lang GROUP BY v.lang""",
)
def label_distribution(spark, sf_dir):
    return aggregates.label_distribution(table(spark, sf_dir, "documents"), LANGS, "lang")


@query(
    "binary_distribution",
    """WITH b AS (SELECT CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 0 WHEN 'de' THEN 1 END AS "binary" FROM documents)
       SELECT v.binary, count(b.binary) AS n,
         round(count(b.binary) * 100.0::DOUBLE / (SELECT count("binary") FROM b), 4) AS pct
       FROM (VALUES (0), (1)) AS v("binary") LEFT JOIN b ON b.binary = v.binary GROUP BY v.binary""",
)
def binary_distribution(spark, sf_dir):
    mapped = table(spark, sf_dir, "documents").select(map_label(F.col("lang"), LANG_MAP).alias("binary"))
    return aggregates.binary_distribution(mapped)


@query(
    "split_label_pivot",
    f"""WITH {CORPUS} SELECT split, count(*) AS total_samples, count(*) FILTER (WHERE label = 0) AS label_0,
         count(*) FILTER (WHERE label = 1) AS label_1, count(*) FILTER (WHERE label = 2) AS label_2,
         count(*) FILTER (WHERE label NOT IN (0, 1, 2)) AS unknown_labels FROM corpus GROUP BY split""",
)
def split_label_pivot(spark, sf_dir):
    return aggregates.split_label_pivot(corpus(spark, sf_dir), [0, 1, 2])


@query(
    "split_label_rollup",
    f"""WITH {CORPUS} SELECT CASE WHEN grouping(label) = 1 THEN '<all>' ELSE CAST(label AS VARCHAR) END AS label,
         CASE WHEN grouping(split) = 1 THEN '<all>' ELSE split END AS split, count(*) AS n,
         round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM corpus), 2) AS pct
       FROM corpus GROUP BY CUBE (label, split)""",
)
def split_label_rollup(spark, sf_dir):
    return aggregates.split_label_rollup(corpus(spark, sf_dir))


@query(
    "label_cooccurrence",
    """SELECT q.quality, t.toxic, count(l.doc_id) AS n
       FROM (VALUES (0), (1)) AS q(quality) CROSS JOIN (VALUES (0), (1), (2), (3)) AS t(toxic)
       LEFT JOIN labels l ON l.quality = q.quality AND l.toxic = t.toxic GROUP BY ALL""",
)
def label_cooccurrence(spark, sf_dir):
    return aggregates.label_cooccurrence(table(spark, sf_dir, "labels"), "quality", [0, 1], "toxic", [0, 1, 2, 3])


@query(
    "unknown_labels",
    f"""SELECT split, lang, count(*) AS n FROM (
         SELECT lang, CASE WHEN d IN ('0','1') THEN 'test' WHEN d IN ('2','3') THEN 'valid' ELSE 'train' END AS split
         FROM (SELECT lang, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) AS d FROM documents))
       WHERE lang NOT IN ('de', 'en', 'it') GROUP BY ALL""",
)
def unknown_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", split_of(F.col("doc_id")).alias("split"))
    return aggregates.unknown_labels(docs, ["de", "en", "it"], "lang")


LENGTHS = f"lengths AS (SELECT label, split, CAST(len({tokens_sql('text')}) AS INTEGER) AS t, CAST(length(text) AS INTEGER) AS c FROM corpus)"
LENGTH_COLUMNS = """count(*) AS n, round(avg(t), 4) AS avg_tokens, min(t) AS min_tokens, max(t) AS max_tokens,
    round(avg(c), 4) AS avg_chars, min(c) AS min_chars, max(c) AS max_chars"""


@query("length_stats", f"WITH {ALL_DOCS}, {LENGTHS} SELECT {LENGTH_COLUMNS} FROM lengths")
def length_stats(spark, sf_dir):
    return aggregates.length_stats(documents(spark, sf_dir))


@query("length_by_label", f"WITH {CORPUS}, {LENGTHS} SELECT label, {LENGTH_COLUMNS} FROM lengths GROUP BY label")
def length_by_label(spark, sf_dir):
    return aggregates.length_stats(corpus(spark, sf_dir), by=["label"])


@query("length_by_split", f"WITH {ALL_DOCS}, {LENGTHS} SELECT split, {LENGTH_COLUMNS} FROM lengths GROUP BY split")
def length_by_split(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("split", split_of(F.col("doc_id")))
    return aggregates.length_stats(docs, by=["split"])


WORDS = f"w AS (SELECT unnest({tokens_sql('text')}) AS word FROM documents), wc AS (SELECT word, count(*) AS n FROM w GROUP BY word)"


@query("word_counts", f"WITH {WORDS} SELECT word, n FROM wc")
def word_counts(spark, sf_dir):
    return aggregates.word_counts(documents(spark, sf_dir))


@query("vocab_size", f"WITH {WORDS} SELECT count(*) AS unique_words FROM wc")
def vocab_size(spark, sf_dir):
    return aggregates.vocab_size(documents(spark, sf_dir))


@query("top_words", f"WITH {WORDS} SELECT word, n FROM wc ORDER BY n DESC, word LIMIT 50")
def top_words(spark, sf_dir):
    return ranking.top_words(aggregates.word_counts(documents(spark, sf_dir)), 50)


@query(
    "stopword_ratio",
    f"""WITH {WORDS} SELECT h AS stopword_tokens, a AS total_tokens, round(h / CAST(a AS DOUBLE), 6) AS stopword_ratio
        FROM (SELECT CAST(coalesce(sum(n) FILTER (WHERE word IN {STOP_SQL}), 0) AS BIGINT) AS h,
                     CAST(sum(n) AS BIGINT) AS a FROM wc)""",
)
def stopword_ratio(spark, sf_dir):
    return aggregates.stopword_ratio(documents(spark, sf_dir), STOPWORDS)


@query(
    "stopword_ratio_key",
    f"""WITH {WORDS} SELECT h AS stopword_tokens, a AS total_tokens, round(h / CAST(a AS DOUBLE), 6) AS stopword_ratio
        FROM (SELECT CAST(coalesce(sum(n) FILTER (WHERE {match_key_sql('word')} IN ('fur', 'des', 'la', 'tre', 'a')), 0) AS BIGINT) AS h,
                     CAST(sum(n) AS BIGINT) AS a FROM wc)""",
)
def stopword_ratio_key(spark, sf_dir):
    words = ["fur", "des", "la", "tre", "a"]
    return aggregates.stopword_ratio(documents(spark, sf_dir), words, by_key=True)


FLAGS_SQL = f"""round(avg(CAST(regexp_matches(text, '{EMOJI}') AS INTEGER)), 6) AS emoji_ratio,
    round(avg(CAST(regexp_matches(text, '{HAS_URL}') AS INTEGER)), 6) AS url_ratio,
    round(avg(CAST({PLAIN_SQL} AS INTEGER)), 6) AS no_diacritics_ratio,
    round(avg(CAST({SLANG_SQL} AS INTEGER)), 6) AS slang_ratio,
    round(avg(CAST({SLANG_KEY_SQL} AS INTEGER)), 6) AS slang_norm_ratio"""


@query("flag_ratios", f"WITH {INJECTED} SELECT {FLAGS_SQL} FROM injected")
def flag_ratios(spark, sf_dir):
    return aggregates.flag_ratios(injected(spark, sf_dir))


@query(
    "missing_audit",
    f"""WITH rows_ AS (SELECT d.text, CASE WHEN d.doc_id % 11 = 0 THEN ' ' ELSE CAST(l.toxic AS VARCHAR) END AS label,
          CASE WHEN x IN ('0','1') THEN 'test' WHEN x IN ('2','3') THEN 'valid' ELSE 'train' END AS split
        FROM (SELECT *, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) AS x FROM documents) d
        LEFT JOIN labels l ON d.doc_id = l.doc_id)
       SELECT split, count(*) AS samples, count(*) FILTER (WHERE trim(coalesce(text, '')) = '') AS missing_text,
         count(*) FILTER (WHERE trim(coalesce(label, '')) = '') AS missing_label,
         count(DISTINCT nullif(trim(label), '')) AS unique_labels FROM rows_ GROUP BY split""",
)
def missing_audit(spark, sf_dir):
    joined = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    label = F.when(F.col("doc_id") % 11 == 0, " ").otherwise(F.col("toxic").cast("string"))
    return aggregates.missing_audit(
        joined.select("text", label.alias("label"), split_of(F.col("doc_id")).alias("split"))
    )


@query(
    "duplicate_count",
    f"""SELECT count(*) AS documents, count(DISTINCT {match_key_sql('text')}) AS distinct_keys,
         count(*) - count(DISTINCT {match_key_sql('text')}) AS duplicates FROM documents WHERE trim(text) <> ''""",
)
def duplicate_count(spark, sf_dir):
    return aggregates.duplicate_count(documents(spark, sf_dir))


def _token_lengths(spark, sf_dir):
    return documents(spark, sf_dir).select(profile.n_tokens(F.col("text")).alias("tokens"))


@query(
    "length_histogram",
    f"""WITH v AS (SELECT len({tokens_sql('text')}) AS t FROM documents),
        c AS (SELECT CAST(CASE WHEN t > 500 THEN 50 ELSE least(t // 10, 49) END AS INTEGER) AS bin, count(*) AS n FROM v GROUP BY 1)
       SELECT CAST(b.bin AS INTEGER) AS bin, CASE WHEN b.bin = 50 THEN 'omitted' WHEN b.bin = 49 THEN '490-500'
           ELSE (b.bin * 10) || '-' || (b.bin * 10 + 9) END AS label, coalesce(c.n, 0) AS n
       FROM range(51) AS b(bin) LEFT JOIN c ON c.bin = b.bin""",
)
def length_histogram(spark, sf_dir):
    return aggregates.histogram(_token_lengths(spark, sf_dir), "tokens", width=10, cap=500)


@query(
    "length_histogram_auto",
    f"""WITH v AS (SELECT len({tokens_sql('text')}) AS t FROM documents),
        s AS (SELECT min(t) AS lo, max(t) AS hi, least(40, max(t) - min(t) + 1) AS k,
                (max(t) - min(t) + 1) / CAST(least(40, max(t) - min(t) + 1) AS DOUBLE) AS w FROM v),
        c AS (SELECT CAST(least(floor((t - lo) / w), k - 1) AS INTEGER) AS bin, count(*) AS n FROM v, s GROUP BY 1),
        e AS (SELECT b.bin, CAST(floor(lo + b.bin * w) AS BIGINT) AS a,
                CASE WHEN b.bin = k - 1 THEN hi ELSE CAST(floor(lo + (b.bin + 1) * w - 1) AS BIGINT) END AS z
              FROM s, range(40) AS b(bin) WHERE b.bin < k)
       SELECT CAST(e.bin AS INTEGER) AS bin, CASE WHEN a = z THEN CAST(a AS VARCHAR) ELSE a || '-' || z END AS label,
         coalesce(c.n, 0) AS n FROM e LEFT JOIN c ON c.bin = e.bin""",
)
def length_histogram_auto(spark, sf_dir):
    return aggregates.histogram_auto(_token_lengths(spark, sf_dir), "tokens")


@query(
    "doc_freq",
    f"WITH {ALL_TERMS} SELECT feature, count(*) AS df FROM tc GROUP BY feature",
)
def doc_freq(spark, sf_dir):
    return aggregates.doc_freq(documents(spark, sf_dir), ngrams.word_analyzer(1, 2))


@query(
    "class_weights",
    f"""WITH {CORPUS} SELECT label, count(*) AS n,
         round((SELECT count(*) FROM corpus) / CAST((SELECT count(DISTINCT label) FROM corpus) * count(*) AS DOUBLE), 6) AS weight
       FROM corpus GROUP BY label""",
)
def class_weights(spark, sf_dir):
    return aggregates.class_weights(corpus(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query(
    "label_order",
    """WITH l AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang
                 UNION ALL SELECT CAST(label AS VARCHAR), count(*) FROM embeddings GROUP BY label)
       SELECT label, n, CAST(row_number() OVER (ORDER BY TRY_CAST(label AS DOUBLE) IS NULL, TRY_CAST(label AS DOUBLE), label) AS INTEGER) AS position FROM l""",
)
def label_order(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select(F.col("lang").alias("label"))
    numbers = table(spark, sf_dir, "embeddings").select(F.col("label").cast("string"))
    return ranking.order_labels(names.unionByName(numbers))


@query(
    "corpus_profile",
    f"""WITH {CORPUS},
  toks AS (SELECT *, {tokens_sql('text')} AS t FROM corpus),
  ct AS (SELECT unnest(t) AS word FROM toks), cw AS (SELECT word, count(*) AS n FROM ct GROUP BY word)
  SELECT (SELECT count(*) FROM toks) AS total_samples,
    (SELECT count(*) FILTER (WHERE label = 0) FROM toks) AS label_0, (SELECT count(*) FILTER (WHERE label = 1) FROM toks) AS label_1,
    (SELECT round(avg(CAST(label = 0 AS INTEGER)) * 100, 4) FROM toks) AS pct_0, (SELECT round(avg(CAST(label = 1 AS INTEGER)) * 100, 4) FROM toks) AS pct_1,
    (SELECT round(avg(len(t)), 4) FROM toks) AS avg_tokens, (SELECT CAST(min(len(t)) AS INTEGER) FROM toks) AS min_tokens,
    (SELECT CAST(max(len(t)) AS INTEGER) FROM toks) AS max_tokens, (SELECT round(avg(length(text)), 4) FROM toks) AS avg_chars,
    (SELECT CAST(min(length(text)) AS INTEGER) FROM toks) AS min_chars, (SELECT CAST(max(length(text)) AS INTEGER) FROM toks) AS max_chars,
    (SELECT count(*) FILTER (WHERE trim(text) = '') FROM toks) AS empty_texts,
    (SELECT count(*) FILTER (WHERE trim(text) <> '') - count(DISTINCT CASE WHEN trim(text) <> '' THEN {match_key_sql('text')} END) FROM toks) AS duplicate_texts,
    (SELECT round(avg(CAST({PLAIN_SQL} AS INTEGER)) * 100, 4) FROM toks) AS pct_no_diacritics,
    (SELECT round(avg(CAST(regexp_matches(text, '{EMOJI}') AS INTEGER)) * 100, 4) FROM toks) AS pct_emoji,
    (SELECT round(avg(CAST(regexp_matches(text, '{HAS_URL}') AS INTEGER)) * 100, 4) FROM toks) AS pct_url,
    (SELECT round(avg(CAST({SLANG_SQL} AS INTEGER)), 6) FROM toks) AS slang_ratio,
    (SELECT count(*) FROM cw) AS unique_words,
    (SELECT CAST(coalesce(sum(n) FILTER (WHERE word IN {STOP_SQL}), 0) AS BIGINT) FROM cw) AS stopword_tokens,
    (SELECT round(coalesce(sum(n) FILTER (WHERE word IN {STOP_SQL}), 0) / CAST(sum(n) AS DOUBLE), 6) FROM cw) AS stopword_ratio,
    (SELECT array_to_string(list(word || ':' || n ORDER BY n DESC, word), ' ') FROM (SELECT * FROM cw ORDER BY n DESC, word LIMIT 30)) AS top_words""",
)
def corpus_profile_query(spark, sf_dir):
    nested = corpus_profile(corpus(spark, sf_dir), [0, 1], STOPWORDS)
    words = F.transform("vocabulary.top_frequent_words", lambda w: F.concat_ws(":", w["word"], w["count"]))
    return nested.select(
        "total_samples",
        *[F.col("samples_per_label")[str(v)].alias(f"label_{v}") for v in (0, 1)],
        *[F.col("class_distribution_percent")[str(v)].alias(f"pct_{v}") for v in (0, 1)],
        "length.*",
        "text_properties.*",
        "vocabulary.slang_ratio",
        "vocabulary.unique_words",
        "vocabulary.stopword_tokens",
        "vocabulary.stopword_ratio",
        F.array_join(words, " ").alias("top_words"),
    )


@query(
    "two_label_profile",
    f"""WITH {CORPUS} SELECT split, count(*) AS total_samples,
        count(*) FILTER (WHERE quality = 0) AS quality_0, count(*) FILTER (WHERE quality = 1) AS quality_1,
        count(*) FILTER (WHERE label = 0) AS label_0, count(*) FILTER (WHERE label = 1) AS label_1,
        count(*) FILTER (WHERE label = 2) AS label_2, count(*) FILTER (WHERE label = 3) AS label_3
      FROM corpus GROUP BY split""",
)
def two_label_profile_query(spark, sf_dir):
    return two_label_profile(corpus(spark, sf_dir), {"quality": [0, 1], "label": [0, 1, 2, 3]})
