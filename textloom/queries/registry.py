"""Query registry, working frames, and the SQL fragments that mirror them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.patterns import (
    COLLAPSIBLE_LETTERS,
    EMOTICON_RULES,
    HASHTAG,
    SPACES,
    SPECIAL,
    URL_RUN,
    WORD,
)
from textloom.session import broadcasts, by_doc, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


# Letters followed by combining marks.
DECOMPOSED = " e\u0301 a\u0323\u0302"


# ---- working frames -------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(key: Column) -> Column:
    """Split by the first hex digit of the md5 of the key: 0-1 test, 2-3 valid, else train."""
    digit = F.substring(F.md5(key.cast("string")), 1, 1)
    return F.when(digit.isin("0", "1"), "test").when(digit.isin("2", "3"), "valid").otherwise("train")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a link, hashtag, emoticon, emoji or decomposed letter appended by doc_id."""
    suffix = (
        F.when(F.col("doc_id") % 5 == 0, " https://ex.org/a?b=1")
        .when(F.col("doc_id") % 5 == 1, " #tag_1 sooo")
        .when(F.col("doc_id") % 5 == 2, " :) =( ko")
        .when(F.col("doc_id") % 5 == 3, " \U0001f600 www.ex.org")
        .otherwise("")
    )
    accent = F.when(F.col("doc_id") % 7 == 0, DECOMPOSED).otherwise("")
    return documents(spark, sf_dir).select("doc_id", F.concat("text", suffix, accent).alias("text"))


def labelled(df: DataFrame, labels: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(labels, "doc_id", how).select(
        "doc_id", "text", "lang", "source", "quality", F.col("toxic").alias("label"), split_of(F.col("doc_id")).alias("split")
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with split, for row-local work and small aggregates."""
    return labelled(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def feature_corpus(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """Labelled documents partitioned by doc_id, ready to be exploded into features; ``how="left"``: all documents.

    Documents without a label stay behind before the shuffle while the labels can be broadcast. Labels too large for that
    are dealt like the documents and hashed, so that the join needs neither a second shuffle of the texts nor a sort.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    if broadcasts(labels):
        return by_doc(labelled(docs, labels, how), scan=docs)
    return labelled(by_doc(docs), by_doc(labels, scan=docs).hint("shuffle_hash"), how)


def train_rows(docs: DataFrame) -> DataFrame:
    """What models and vocabularies are fitted on: labelled rows of the train split."""
    return docs.filter((F.col("split") == "train") & F.col("label").isNotNull())


# ---- the same frames in SQL -----------------------------------------------------------------


def split_sql(key: str) -> str:
    digit = f"substr(md5(CAST({key} AS VARCHAR)), 1, 1)"
    return f"CASE WHEN {digit} IN ('0','1') THEN 'test' WHEN {digit} IN ('2','3') THEN 'valid' ELSE 'train' END"


CORPUS = f"""corpus AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic AS label, {split_sql('d.doc_id')} AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

# All documents; those without a label have null there.
ALL_DOCS = CORPUS.replace("JOIN labels", "LEFT JOIN labels")
TRAIN_ROWS = "split = 'train' AND label IS NOT NULL"

INJECTED = f"""injected AS (
  SELECT doc_id, text || CASE doc_id % 5
      WHEN 0 THEN ' https://ex.org/a?b=1' WHEN 1 THEN ' #tag_1 sooo' WHEN 2 THEN ' :) =( ko'
      WHEN 3 THEN ' \U0001f600 www.ex.org' ELSE '' END
    || CASE WHEN doc_id % 7 = 0 THEN '{DECOMPOSED}' ELSE '' END AS text
  FROM documents)"""


def replace_sql(x: str, pattern: str, word: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{word}', 'g')"


def squash_sql(x: str) -> str:
    return f"trim({replace_sql(x, SPACES, ' ')})"


def tokens_sql(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}')"


def emoticons_sql(x: str) -> str:
    for pattern, word in EMOTICON_RULES:
        x = replace_sql(x, pattern, word)
    return x


def collapse_sql(x: str) -> str:
    """Drop a character equal to the one before it, when it is a collapsible letter."""
    chars = f"string_split({x}, '')"
    return f"""array_to_string(list_transform(list_filter(
      list_zip({chars}, list_concat([''], {chars})),
      lambda p: NOT (p[1] = p[2] AND regexp_matches(p[1], '^[{COLLAPSIBLE_LETTERS}]$'))), lambda p: p[1]), '')"""


def match_key_sql(x: str) -> str:
    return squash_sql(replace_sql(f"strip_accents(lower({x}))", SPECIAL, " "))


# A small slang lexicon for the queries, with words that the generated languages hold.
SLANG_LEXICON = (
    ("ko", "không"), ("k", "không"), ("dc", "được"), ("bít", "biết"), ("so", "so very"), ("thn", "than"),
    ("the", "da"), ("und", "and"), ("que", "k"), ("eau", "water"), ("der", "the"), ("of", "ov"),
)


def slang_frame(spark: SparkSession) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(e).alias("expansion")) for t, e in SLANG_LEXICON])
    return spark.range(1).select(F.inline(pairs))


def slang_sql(x: str) -> str:
    cases = " ".join(f"WHEN '{t}' THEN '{e}'" for t, e in SLANG_LEXICON)
    return f"array_to_string(list_transform(string_split({squash_sql(x)}, ' '), lambda t: CASE t {cases} ELSE t END), ' ')"


def clean_sql(source: str) -> str:
    """CTEs that clean ``text`` of a relation step by step; the last one is ``cleaned``."""
    return f"""
  c1 AS (SELECT * REPLACE (lower(nfc_normalize(coalesce(text, ''))) AS text) FROM {source}),
  c2 AS (SELECT * REPLACE ({replace_sql(replace_sql('text', URL_RUN, ''), HASHTAG, '')} AS text) FROM c1),
  c3 AS (SELECT * REPLACE (replace(text, '\U0001f600', ' grinning_face ') AS text) FROM c2),
  c4 AS (SELECT * REPLACE ({replace_sql(emoticons_sql('text'), SPECIAL, ' ')} AS text) FROM c3),
  c5 AS (SELECT * REPLACE ({collapse_sql('text')} AS text) FROM c4),
  c6 AS (SELECT * REPLACE ({slang_sql('text')} AS text) FROM c5),
  cleaned AS (SELECT * REPLACE ({squash_sql('text')} AS text) FROM c6)"""


# Term counts of word (1,2)-grams of the labelled corpus: tc(doc_id, label, split, feature, tf).
WORD_TERMS = f"""{CORPUS},
  words AS (SELECT doc_id, label, split, unnest(t) AS w, generate_subscripts(t, 1) AS pos
            FROM (SELECT *, {tokens_sql('text')} AS t FROM corpus)),
  pairs AS (SELECT *, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS nw FROM words),
  feats AS (SELECT doc_id, label, split, w AS feature FROM pairs
            UNION ALL SELECT doc_id, label, split, w || ' ' || nw FROM pairs WHERE nw IS NOT NULL),
  tc AS (SELECT doc_id, label, split, feature, count(*) AS tf FROM feats GROUP BY ALL)"""

ALL_TERMS = WORD_TERMS.replace(CORPUS, ALL_DOCS)

# The same for character (3,5)-grams.
CHAR_TERMS = f"""{CORPUS},
  chars AS (SELECT doc_id, label, split,
              string_split(' ' || {squash_sql('lower(text)')} || ' ', '') AS c FROM corpus),
  units AS (SELECT doc_id, label, split, unnest(c) AS u, generate_subscripts(c, 1) AS pos FROM chars),
  runs AS (SELECT doc_id, label, split, u, lead(u, 1) OVER w AS u1, lead(u, 2) OVER w AS u2,
              lead(u, 3) OVER w AS u3, lead(u, 4) OVER w AS u4
           FROM units WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
  feats AS (SELECT doc_id, label, split, u || u1 || u2 AS feature FROM runs WHERE u2 IS NOT NULL
            UNION ALL SELECT doc_id, label, split, u || u1 || u2 || u3 FROM runs WHERE u3 IS NOT NULL
            UNION ALL SELECT doc_id, label, split, u || u1 || u2 || u3 || u4 FROM runs WHERE u4 IS NOT NULL),
  tc AS (SELECT doc_id, label, split, feature, count(*) AS tf FROM feats GROUP BY ALL)"""


def vocabulary_sql(name: str, min_df: int, size: int, rows: str = "split = 'train'") -> str:
    """CTE ``name``: vocabulary with class counts from the training part of ``tc``."""
    return f"""
  {name} AS (
    SELECT *, row_number() OVER (ORDER BY df DESC, feature) - 1 AS idx FROM (
      SELECT feature, count(*) AS df, sum(tf) AS cf,
        count(*) FILTER (WHERE label = 0) AS df0, count(*) FILTER (WHERE label = 1) AS df1,
        coalesce(sum(tf) FILTER (WHERE label = 0), 0) AS cf0, coalesce(sum(tf) FILTER (WHERE label = 1), 0) AS cf1
      FROM tc WHERE {rows} GROUP BY feature HAVING count(*) >= {min_df})
    QUALIFY idx < {size})"""


CLASS_ROWS = """class_rows AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
            FROM corpus WHERE split = 'train')"""
