"""Invariants of dedup, ranks and splits, with hot keys."""

from pyspark.sql import functions as F

from textloom.operators import ranking, splitting


def test_stratified_split_is_exact_and_repeatable(spark):
    docs = spark.range(1003).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    split = splitting.stratified_split(docs)
    sizes = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert sizes == {(0, "test"): 90, (0, "valid"): 90, (0, "train"): 722, (1, "test"): 10, (1, "valid"): 10, (1, "train"): 81}
    again = splitting.stratified_split(docs.repartition(1))
    assert split.exceptAll(again).count() == 0
    assert splitting.stratified_split(docs, seed=7).exceptAll(split).count() > 0


def test_split_of_many_labels(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), (F.col("id") % 1500).alias("label"))
    docs = docs.unionByName(spark.sql("SELECT 30000L AS doc_id, CAST(NULL AS long) AS label"))
    split = splitting.stratified_split(docs)
    assert split.columns == ["doc_id", "label", "split"]
    sizes = split.groupBy("label", "split").count().groupBy("split", "count").agg(F.count("*").alias("labels"))
    assert {tuple(r) for r in sizes.collect()} == {("test", 2, 1500), ("valid", 2, 1500), ("train", 16, 1500), ("train", 1, 1)}


def test_tiny_labels_go_to_train(spark):
    docs = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, label int")
    assert [r.split for r in splitting.stratified_split(docs).collect()] == ["train"] * 3


def test_hash_split_covers_everything(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("label"))
    sizes = {r.split: r["count"] for r in splitting.stratified_split(docs, exact=False).groupBy("split").count().collect()}
    assert sum(sizes.values()) == 2000 and 120 < sizes["test"] < 280 and 120 < sizes["valid"] < 280


def test_dedup_keeps_first_with_a_hot_text(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("text"),
    )
    kept = ranking.dedup_first(docs)
    want = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")
    assert kept.exceptAll(want).count() == 0 and want.exceptAll(kept).count() == 0


def test_training_set_has_no_eval_text(spark):
    main = spark.createDataFrame(
        [(1, "a", "train"), (2, "b", "test"), (3, "b", "train"), (4, "a", "train"), (5, "c", "valid")],
        "doc_id long, text string, split string",
    ).withColumn("source_rank", F.lit(0))
    auxiliary = spark.createDataFrame([(1, "c"), (2, "a"), (3, "d")], "doc_id long, text string").withColumn("source_rank", F.lit(1))
    built = splitting.build_training_set(main, auxiliary).collect()
    assert sorted((r.source_rank, r.doc_id, r.text, r.split) for r in built) == [
        (0, 1, "a", "train"), (0, 2, "b", "test"), (0, 5, "c", "valid"), (1, 3, "d", "train"),
    ]


def test_bucketed_rank_is_exact_on_skewed_values(spark):
    values = spark.range(5000).select(
        (F.col("id") % 2).alias("g"), F.when(F.col("id") < 4000, F.col("id") / 1e6).otherwise(F.col("id").cast("double")).alias("v")
    )
    ranked = ranking.bucketed_rank(values, ["g"], "v", 16)
    got = {(r.g, r.v): r["rank"] for r in ranked.collect()}
    for g in (0, 1):
        ordered = sorted(v for gg, v in got if gg == g)
        assert [got[(g, v)] for v in ordered] == list(range(1, 2501))


def test_top_features_with_ties(spark):
    stats = spark.createDataFrame([(f"f{i:03d}", 5 if i < 3 else 2) for i in range(100)], "feature string, df long")
    top = ranking.top_features(stats, 10).orderBy("idx").collect()
    assert [r.feature for r in top] == [f"f{i:03d}" for i in range(10)] and [r.idx for r in top] == list(range(10))
    assert ranking.top_features(stats, 1000).count() == 100
