"""The registered queries against their SQL, and the pipeline's stages on the smallest tables."""

import os

import pytest

from tests.conftest import SMALL_DIR
from textloom.llm.queries import ORACLES, QUERIES
from tools.check import oracle_connection, rows_of

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_DIR), reason="test tables are absent")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    df = QUERIES[name](spark, SMALL_DIR)
    result = oracle_connection(SMALL_DIR).execute(ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    names, n = docs.columns, docs.count()
    for step, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL_DIR)
        if step != "best_fit_packing":
            assert out.columns == names
            assert out.count() <= n
            docs = corpus_pipeline.stored(out, "test-stage")
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
