"""Queries for text and label functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textloom.functions import clean, labels, ngrams, profile
from textloom.functions.patterns import (
    EMOJI,
    HAS_URL,
    HASHTAG,
    NOT_LETTER,
    SLANG_KEY_LAUGHS,
    SLANG_KEY_WORDS,
    SLANG_MARKS,
    SLANG_WORDS,
    SPECIAL,
    URL_RUN,
)
from textloom.operators import phrases
from textloom.queries.registry import (
    INJECTED,
    clean_sql,
    collapse_sql,
    documents,
    emoticons_sql,
    injected,
    match_key_sql,
    query,
    replace_sql,
    slang_frame,
    slang_sql,
    table,
    tokens_sql,
)
from textloom.session import stored_root
from textloom.sources.readers import read_csv, read_splits


# Language stands in for a string label with several classes.
LANG_MAP = {"en": 0, "fr": 0, "de": 1}
# Display names of labels.
QUALITY_NAMES = {0: "Non-Constructive", 1: "Constructive"}
TOXIC_NAMES = {0: "Non-toxic", 1: "Quite toxic"}


@query(
    "read_splits",
    """SELECT 'train' AS split, text FROM documents UNION ALL SELECT 'dev', text FROM conversations
       UNION ALL SELECT 'test', text FROM benchmark""",
)
def read_splits_query(spark, sf_dir):
    files = {"train": "documents", "dev": "conversations", "test": "benchmark"}
    paths = {split: f"{sf_dir}/{name}.parquet" for split, name in files.items()}
    return read_splits(spark, paths, required=["text"]).select("split", "text")


@query(
    "read_csv_blocks",
    """SELECT doc_id, '"' || lang || '"' || chr(10) || text || chr(10) || chr(10) || 'a, ""b' AS text, source FROM documents""",
)
def read_csv_blocks_query(spark, sf_dir):
    """All documents, with quotes and line breaks added, through CSV files in the shared folder."""
    lines = F.concat(F.lit('"'), "lang", F.lit('"\n'), "text", F.lit('\n\na, ""b'))
    path = f"{stored_root(spark)}/csv-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir).select("doc_id", lines.alias("text"), "source")
    docs.write.options(header=True, quoteAll=True, quote='"', escape='"').csv(path)
    return read_csv(spark, path, "doc_id long, text string, source string")


@query(
    "label_map",
    """SELECT doc_id, CASE upper(trim(lang)) WHEN 'EN' THEN 0 WHEN 'FR' THEN 0 WHEN 'DE' THEN 1 END AS binary
       FROM documents""",
)
def label_map(spark, sf_dir):
    mapping = {name.upper(): value for name, value in LANG_MAP.items()}
    label = labels.map_label(labels.clean_raw_label(F.col("lang")), mapping)
    return table(spark, sf_dir, "documents").select("doc_id", label.alias("binary"))


RAW_LABEL_SQL = """CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'x' || toxic
       WHEN doc_id % 5 = 2 THEN quality || '.7' ELSE CAST(toxic AS VARCHAR) END"""


def raw_label():
    """A label column as text files hold it: some empty, some no number, some with decimals."""
    toxic, quality = F.col("toxic").cast("string"), F.col("quality").cast("string")
    return (
        F.when(F.col("doc_id") % 5 == 0, F.lit(None))
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit("x"), toxic))
        .when(F.col("doc_id") % 5 == 2, F.concat(quality, F.lit(".7")))
        .otherwise(toxic)
    )


@query(
    "coerce_label",
    f"""SELECT doc_id, coalesce(CAST(trunc(TRY_CAST({RAW_LABEL_SQL} AS DOUBLE)) AS INTEGER), -1) AS label FROM labels""",
)
def coerce_label(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", labels.coerce_label(raw_label()).alias("label"))


@query(
    "drop_missing",
    f"""SELECT doc_id, raw_label, text FROM (
         SELECT d.doc_id, {RAW_LABEL_SQL.replace('doc_id', 'd.doc_id')} AS raw_label, d.text
         FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       WHERE raw_label IS NOT NULL AND text IS NOT NULL AND raw_label <> '' AND text <> ''""",
)
def drop_missing(spark, sf_dir):
    joined = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    raw = joined.select("doc_id", raw_label().alias("raw_label"), "text")
    return labels.keep_complete(labels.drop_missing(raw, ["raw_label", "text"]), label="raw_label")


@query(
    "label_names",
    """SELECT doc_id, CASE quality WHEN 0 THEN 'Non-Constructive' WHEN 1 THEN 'Constructive' END AS quality_name,
         CASE toxic WHEN 0 THEN 'Non-toxic' WHEN 1 THEN 'Quite toxic' END AS toxic_name FROM labels""",
)
def label_names(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        labels.label_name(F.col("quality"), QUALITY_NAMES).alias("quality_name"),
        labels.label_name(F.col("toxic"), TOXIC_NAMES).alias("toxic_name"),
    )


def _text_query(name, sql, fn):
    """Register a Column to Column step over the injected documents."""

    @query(name, f"WITH {INJECTED} SELECT doc_id, {sql} AS text FROM injected")
    def run(spark, sf_dir):
        return injected(spark, sf_dir).select("doc_id", fn(F.col("text")).alias("text"))


_text_query("nfc", "nfc_normalize(text)", clean.nfc)
_text_query("strip_urls", replace_sql("lower(text)", URL_RUN, ""), lambda t: clean.strip_urls(F.lower(t)))
_text_query("strip_hashtags", replace_sql("text", HASHTAG, ""), clean.strip_hashtags)
_text_query("demojize", "replace(text, '\U0001f600', ' grinning_face ')", clean.demojize)
_text_query("emoticons", emoticons_sql("text"), clean.replace_emoticons)
_text_query("strip_special", replace_sql("text", SPECIAL, " "), clean.strip_special)
_text_query("collapse_repeats", collapse_sql("lower(text)"), lambda t: clean.collapse_repeats(F.lower(t)))
_text_query("strip_accents", "strip_accents(text)", profile.strip_accents)
_text_query("match_key", match_key_sql("text"), profile.match_key)


@query("expand_slang", f"WITH {INJECTED} SELECT doc_id, {slang_sql('lower(text)')} AS text FROM injected")
def expand_slang(spark, sf_dir):
    lowered = injected(spark, sf_dir).withColumn("text", F.lower("text"))
    return clean.expand_slang(lowered, slang_frame(spark))


@query("clean_text", f"WITH {INJECTED}, {clean_sql('injected')} SELECT doc_id, text FROM cleaned")
def clean_text(spark, sf_dir):
    return clean.clean_text(injected(spark, sf_dir), slang_frame(spark))


MINE = f"""
  toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
  mine_words AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks),
  mine_pairs AS (SELECT w, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS nw FROM mine_words),
  singles AS (SELECT w, count(*) AS n FROM mine_words GROUP BY w),
  mined AS (
    SELECT p.w AS first, p.nw AS second, p.n AS n_pair,
      ln(p.n * CAST((SELECT sum(n) FROM singles) AS DOUBLE) / (a.n * CAST(b.n AS DOUBLE))) AS pmi
    FROM (SELECT w, nw, count(*) AS n FROM mine_pairs WHERE nw IS NOT NULL GROUP BY ALL HAVING count(*) >= 5) p
    JOIN singles a ON a.w = p.w JOIN singles b ON b.w = p.nw
    WHERE pmi >= 3.0)"""


@query("phrase_mine", f"WITH {MINE} SELECT first, second, n_pair, round(pmi, 6) AS pmi FROM mined")
def phrase_mine(spark, sf_dir):
    return phrases.mine_phrases(documents(spark, sf_dir)).withColumn("pmi", F.round("pmi", 6))


@query(
    "phrase_join",
    f"""WITH {MINE},
  flagged AS (SELECT m.doc_id, m.w, m.pos, CASE WHEN k.first IS NULL THEN '0' ELSE '1' END AS flag
    FROM (SELECT *, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS nw FROM mine_words) m
    LEFT JOIN mined k ON k.first = m.w AND k.second = m.nw),
  taken AS (SELECT doc_id, list(w ORDER BY pos) AS ws,
      regexp_replace(string_agg(flag, '' ORDER BY pos), '1.', '10', 'g') AS f FROM flagged GROUP BY doc_id)
  SELECT d.doc_id, coalesce(trim(array_to_string(list_transform(list_zip(ws, string_split(f, '')),
      lambda p: p[1] || CASE WHEN p[2] = '1' THEN '_' ELSE ' ' END), '')), '') AS text
  FROM documents d LEFT JOIN taken t ON d.doc_id = t.doc_id""",
)
def phrase_join(spark, sf_dir):
    docs = documents(spark, sf_dir)
    words = docs.select("doc_id", F.array_join(profile.tokens(F.col("text")), " ").alias("text"))
    return phrases.join_phrases(words, phrases.mine_phrases(docs))


@query(
    "tokens",
    f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)""",
)
def tokens(spark, sf_dir):
    found = documents(spark, sf_dir).select("doc_id", profile.tokens(F.col("text")).alias("t"))
    return found.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


def _words(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


SLANG_SQL = f"(list_has_any({tokens_sql('text')}, {_words(SLANG_WORDS)}) OR regexp_matches(text, '{SLANG_MARKS}'))"
SLANG_KEY_SQL = f"""(list_has_any(string_split({match_key_sql('text')}, ' '), {_words(SLANG_KEY_WORDS)})
    OR regexp_matches({match_key_sql('text')}, '{SLANG_KEY_LAUGHS}'))"""
LETTERS_SQL = replace_sql("text", NOT_LETTER, "")
PLAIN_SQL = f"({LETTERS_SQL} <> '' AND lower(strip_accents({LETTERS_SQL})) = lower({LETTERS_SQL}))"


@query(
    "text_flags",
    f"""WITH {INJECTED} SELECT doc_id, regexp_matches(text, '{EMOJI}') AS has_emoji,
         regexp_matches(text, '{HAS_URL}') AS has_url, {PLAIN_SQL} AS no_diacritics FROM injected""",
)
def text_flags(spark, sf_dir):
    t = F.col("text")
    return injected(spark, sf_dir).select(
        "doc_id",
        profile.has_emoji(t).alias("has_emoji"),
        profile.has_url(t).alias("has_url"),
        profile.no_diacritics(t).alias("no_diacritics"),
    )


@query("slang_flag", f"WITH {INJECTED} SELECT doc_id, {SLANG_SQL} AS has_slang FROM injected")
def slang_flag(spark, sf_dir):
    return injected(spark, sf_dir).select("doc_id", profile.has_slang(F.col("text")).alias("has_slang"))


@query("slang_flag_norm", f"WITH {INJECTED} SELECT doc_id, {SLANG_KEY_SQL} AS has_slang FROM injected")
def slang_flag_norm(spark, sf_dir):
    return injected(spark, sf_dir).select("doc_id", profile.has_slang_norm(F.col("text")).alias("has_slang"))


@query(
    "doc_lengths",
    f"SELECT doc_id, CAST(len({tokens_sql('text')}) AS INTEGER) AS n_tokens, CAST(length(text) AS INTEGER) AS n_chars FROM documents",
)
def doc_lengths(spark, sf_dir):
    t = F.col("text")
    return documents(spark, sf_dir).select(
        "doc_id", profile.n_tokens(t).alias("n_tokens"), profile.n_chars(t).alias("n_chars")
    )


@query(
    "word_ngrams",
    f"""WITH toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
  grams AS (SELECT doc_id, list_concat(t, list_filter(list_transform(list_zip(t, t[2:]), lambda p: p[1] || ' ' || p[2]),
      lambda g: g IS NOT NULL)) AS g FROM toks)
  SELECT doc_id, len(g) AS n_features, md5(array_to_string(g, '|')) AS digest FROM grams""",
)
def word_ngrams(spark, sf_dir):
    return _digest(documents(spark, sf_dir), ngrams.word_analyzer(1, 2))


@query(
    "char_ngrams",
    f"""WITH units AS (SELECT doc_id, string_split(' ' || trim(regexp_replace(lower(text), '[\\t-\\r\\x{{1c}}-\\x{{20}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')) || ' ', '') AS c FROM documents),
  g3 AS (SELECT doc_id, c, list_filter(list_transform(list_zip(c, c[2:], c[3:]), lambda p: p[1] || p[2] || p[3]), lambda g: g IS NOT NULL) AS a FROM units),
  g4 AS (SELECT doc_id, c, a, list_filter(list_transform(list_zip(a, c[4:]), lambda p: p[1] || p[2]), lambda g: g IS NOT NULL) AS b FROM g3),
  g5 AS (SELECT doc_id, list_concat(list_concat(a, b), list_filter(list_transform(list_zip(b, c[5:]), lambda p: p[1] || p[2]), lambda g: g IS NOT NULL)) AS g FROM g4)
  SELECT doc_id, len(g) AS n_features, md5(array_to_string(g, '|')) AS digest FROM g5""",
)
def char_ngrams(spark, sf_dir):
    return _digest(documents(spark, sf_dir), ngrams.char_analyzer(3, 5))


def _digest(docs, analyzer):
    """Number of features and a hash of all of them in order."""
    features = docs.select("doc_id", analyzer(F.col("text")).alias("g"))
    return features.select(
        "doc_id", F.size("g").cast("long").alias("n_features"), F.md5(F.array_join("g", "|")).alias("digest")
    )
