"""Work per task and per pass at any size of the input."""

from pyspark.sql import functions as F

from textloom.functions.profile import tokens
from textloom.operators.features import mean_pool


def test_mean_pool_keeps_vectors_out_of_sorts(spark):
    docs = spark.createDataFrame([(1, "a b a z"), (2, "z"), (3, None), (4, "b")], "doc_id long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 5.0])], "word string, vec array<float>")
    pooled = mean_pool(docs, vectors, tokens)
    got = {r.doc_id: (r.n_words, r.vec) for r in pooled.collect()}
    assert got == {1: (3, [2.0, 3.0]), 2: (0, None), 3: (0, None), 4: (1, [4.0, 5.0])}
    plan = pooled._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    none = mean_pool(docs, vectors.filter("false"), tokens).agg(F.sum("n_words"), F.count("vec")).first()
    assert tuple(none) == (0, 0)


def test_partitions_follow_the_size_of_the_documents(spark, tmp_path):
    from textloom import session

    wide = spark.range(300, numPartitions=40).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 400).alias("text"))
    wide.write.parquet(f"{tmp_path}/d")
    stored = spark.read.parquet(f"{tmp_path}/d")
    cores = spark.sparkContext.defaultParallelism
    size = session.estimated_bytes(stored)
    assert session.by_doc(stored).rdd.getNumPartitions() == max(cores, -(-size // session.TASK_BYTES))
    buckets = session.store_by_doc(stored, "scale", bytes_per_bucket=200_000)
    assert buckets.groupBy("doc_id").agg(F.max("text")).rdd.getNumPartitions() == -(-300 * 64 * 400 // 200_000)


def test_log_probabilities_are_those_of_the_c_library(spark):
    import math

    from textloom.operators.classifiers import fit_multinomial_nb

    # With the logarithm of the JVM some of these differ in the last bit, and so do ties between words.
    rows = [(f"w{i}", i, 2 * i + 1) for i in range(2000)]
    params = fit_multinomial_nb(spark.createDataFrame(rows, "feature string, cf0 long, cf1 long"), (3, 4), tokens).params.collect()
    totals = [sum(r[k] for r in rows) + len(rows) for k in (1, 2)]
    got = {r.feature: (r.log_prob_0, r.log_prob_1) for r in params}
    assert got == {f: (math.log((a + 1.0) / totals[0]), math.log((b + 1.0) / totals[1])) for f, a, b in rows}


def test_labels_too_large_to_broadcast_shuffle_texts_once(spark):
    from tests.conftest import SMALL_DIR
    from textloom.functions.ngrams import word_analyzer
    from textloom.operators.features import term_counts
    from textloom.queries.registry import feature_corpus

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for how in ("inner", "left"):
        want = feature_corpus(spark, SMALL_DIR, how).collect()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            docs = feature_corpus(spark, SMALL_DIR, how)
            counts = term_counts(docs, word_analyzer())
            plan = counts._jdf.queryExecution().executedPlan().toString()
            got = docs.collect()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in plan  # texts and labels, once each
        assert sorted(got) == sorted(want)
