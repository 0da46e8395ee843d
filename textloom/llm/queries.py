"""The registered queries of the operators, over whole tables, and their oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontaminate, embedding_dedup, fill_in_middle, filter_audit, langid, lm, ngram_join, oracles, packing
from textloom.llm import secret_scan, suffix_dedup, token_files, toxicity, warc
from textloom.llm.common import remainder, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


TOKENIZER = "byte_bpe_50k.json"


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    """Trained on the labelled rows outside the held-out fold."""
    return toxicity.fit(docs.where(remainder("doc_id", 4) != 2), table(spark, sf_dir, "labels"))


@query("op1_toxicity")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.report(docs, toxicity_model(spark, sf_dir, docs), remainder("doc_id", 4) == 2)


@query("op2_ngram_jaccard_join")
def op2(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_best_fit_packing")
def op3(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op4_warc", oracles.WARC)
def op4(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op5_lm_scoring")
def op5(spark, sf_dir):
    return lm.report(table(spark, sf_dir, "documents"), remainder("doc_id", 10) == 0)


@query("op6_embedding_near_dedup", oracles.VECTORS)
def op6(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_benchmark_decontamination", oracles.BENCHMARK)
def op7(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_language_id")
def op8(spark, sf_dir):
    return langid.report(table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2)


@query("op9_token_files")
def op9(spark, sf_dir):
    import public_tokenizers

    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2)


@query("op10_suffix_array_dedup")
def op10(spark, sf_dir):
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


@query("op11_filter_audit", oracles.FILTERS)
def op11(spark, sf_dir):
    audited = filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audited.drop("potential")


@query("op12_fill_in_middle", oracles.FILL_IN_MIDDLE)
def op12(spark, sf_dir):
    return fill_in_middle.report(table(spark, sf_dir, "documents"))


@query("op13_secret_scan", oracles.SECRETS)
def op13(spark, sf_dir):
    return secret_scan.report(table(spark, sf_dir, "documents"))
