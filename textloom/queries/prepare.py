"""Queries that build a corpus: union, dedup, split, training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import ranking, splitting
from textloom.plans.corpus_build import Source, build_corpus
from textloom.queries.registry import (
    CORPUS,
    clean_sql,
    corpus,
    documents,
    query,
    slang_frame,
    table,
)

CORPORA = """corpora AS (
  SELECT 0 AS source_rank, doc_id, text FROM documents
  UNION ALL SELECT 1, conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT 2, item_id, text FROM benchmark)"""


def corpora(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return splitting.union_corpora([table(spark, sf_dir, "documents").select("doc_id", "text"), chats, items])


@query("union_corpora", f"WITH {CORPORA} SELECT source_rank, doc_id, text FROM corpora")
def union_corpora(spark, sf_dir):
    return corpora(spark, sf_dir)


@query(
    "dedup_first",
    f"""WITH {CORPORA} SELECT source_rank, doc_id, text FROM corpora
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, doc_id) = 1""",
)
def dedup_first(spark, sf_dir):
    return ranking.dedup_first(corpora(spark, sf_dir), "text", ["source_rank", "doc_id"])


def split_sql(source: str, key: str) -> str:
    return f"""(SELECT * EXCLUDE (r, n), CASE WHEN 10 * r <= n THEN 'test' WHEN 10 * r <= 2 * n THEN 'valid' ELSE 'train' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST({key} AS VARCHAR))) AS r,
              count(*) OVER (PARTITION BY label) AS n FROM {source}))"""


@query(
    "stratified_split",
    f"""WITH docs AS (SELECT doc_id, lang AS label FROM documents)
        SELECT doc_id, label AS lang, split FROM {split_sql('docs', 'doc_id')}""",
)
def stratified_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return splitting.stratified_split(docs, label="lang")


MAIN_SOURCES = [f"src{i}" for i in range(15)]
MAIN_SQL = "(" + ", ".join(f"'{s}'" for s in MAIN_SOURCES) + ")"


@query(
    "build_training_set",
    f"""WITH {CORPUS},
  main AS (SELECT * FROM (SELECT doc_id, text, label, 0 AS source_rank, split FROM corpus WHERE source IN {MAIN_SQL})),
  evals AS (SELECT * FROM main WHERE split <> 'train'),
  trains AS (SELECT * FROM main WHERE split = 'train' UNION ALL
             SELECT doc_id, text, label, 1, 'train' FROM corpus WHERE source NOT IN {MAIN_SQL})
  SELECT * FROM evals UNION ALL
  (SELECT * FROM trains WHERE text NOT IN (SELECT text FROM evals)
   QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, doc_id) = 1)""",
)
def build_training_set(spark, sf_dir):
    docs = corpus(spark, sf_dir).select("doc_id", "text", "label", "source", "split")
    main, auxiliary = splitting.by_source(docs, MAIN_SOURCES)
    main = main.withColumn("source_rank", F.lit(0)).drop("source")
    auxiliary = auxiliary.withColumn("source_rank", F.lit(1)).drop("source", "split")
    return splitting.build_training_set(main, auxiliary)


@query(
    "build_corpus",
    f"""WITH stacked AS (
    SELECT 0 AS source_rank, 'forum' AS source, d.doc_id, d.text, l.toxic AS label, false AS auxiliary
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.source IN {MAIN_SQL}
    UNION ALL SELECT 1, 'chat', conv_id * 1000 + turn, text, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 END, false
    FROM conversations WHERE role <> 'system'
    UNION ALL SELECT 2, 'review', d.doc_id, d.text, l.toxic, true
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.source NOT IN {MAIN_SQL}),
  {clean_sql('stacked')},
  firsts AS (SELECT * FROM cleaned WHERE text <> ''
             QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, doc_id) = 1),
  mains AS (SELECT * FROM firsts WHERE NOT auxiliary)
  SELECT source_rank, source, doc_id, text, label, split FROM {split_sql('mains', "source_rank || '/' || doc_id")}
  UNION ALL SELECT source_rank, source, doc_id, text, label, 'train' FROM firsts WHERE auxiliary""",
)
def build_corpus_query(spark, sf_dir):
    docs = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    is_main = F.col("source").isin(MAIN_SOURCES)
    chats = table(spark, sf_dir, "conversations").withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn"))
    binary = {0: 0, 1: 1}
    sources = [
        Source("forum", docs.filter(is_main), "text", "toxic", "doc_id", binary),
        Source("chat", chats, "text", "role", "doc_id", {"user": 0, "assistant": 1}),
        Source("review", docs.filter(~is_main), "text", "toxic", "doc_id", binary, auxiliary=True),
    ]
    return build_corpus(sources, slang_frame(spark)).drop("row_id")
