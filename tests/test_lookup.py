import pytest
from pyspark.sql import functions as F

from textloom.operators.lookup import attach_scores, common_keys, lookup
from textloom.session import materialize


def test_attach_scores_matches_by_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, feature string")
    scores = spark.createDataFrame([(2, 1.0)], "doc_id int, score double")
    assert [(r.feature, r.score) for r in attach_scores(df, scores).collect()] == [("b", 1.0)]


def skewed(spark, n=20_000):
    """A third of the rows ask for one key, a tenth have none, the others spread over 5,000 keys."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(n).select("id", key.alias("k"))


def table(spark):
    rows = spark.range(4000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    return rows.unionByName(spark.range(1).select(F.lit("hot").alias("k"), F.lit(-1).cast("long").alias("v")))


@pytest.mark.parametrize("small", [0, 1 << 26])
def test_lookup_equals_a_join(spark, small):
    probe, dim = skewed(spark), materialize(table(spark), "dim")
    got = lookup(probe, dim, "k", heavy=50, small=small)
    want = probe.join(dim, "k", "left")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert lookup(probe.limit(0), dim, "k", small=small).count() == 0
    assert lookup(probe, dim.limit(0), "k", small=small).where("v is not null").count() == 0


def test_common_keys_are_found(spark):
    assert common_keys(skewed(spark), "k", 5)[0] == "hot"
    assert common_keys(skewed(spark).limit(0), "k", 5) == []


def shares(spark, light):
    """Rows of each of eight tasks when rows are shuffled by key."""
    parts = light.repartition(8, "k").groupBy(F.spark_partition_id()).count().collect()
    return sorted(r["count"] for r in parts)


def test_no_task_gathers_a_common_key(spark):
    probe, dim = skewed(spark), materialize(table(spark), "dim")
    keys = common_keys(probe, "k", 50)
    before, after = shares(spark, probe), shares(spark, probe.where(F.col("k").isNotNull() & ~F.col("k").isin(keys)))
    assert before[-1] > 2 * before[4]
    assert after[-1] < 2 * after[4]
    plan = lookup(probe, dim, "k", heavy=50, small=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and "broadcast" in plan


def test_large_lexicons_and_phrases_with_one_word_in_every_text(spark, monkeypatch):
    """Slang and phrases above the in-row bound, one word in each row, against the in-row result."""
    from textloom.functions import clean
    from textloom.operators import lookup as module
    from textloom.operators import phrases

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("the the cat"), F.concat(F.lit("w"), (F.col("id") % 37).cast("string")), F.lit("sat the")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(900, ""), (901, None), (902, " the  cat ")], "doc_id long, text string"))
    lexicon = spark.createDataFrame([("the", "da"), ("w3", "three")] + [(f"t{i}", "x") for i in range(50)], "term string, expansion string")
    pairs = spark.createDataFrame([("the", "cat"), ("sat", "the"), ("cat", "w5")] + [(f"t{i}", "x") for i in range(50)], "first string, second string")
    want = [clean.expand_slang(docs, lexicon), phrases.join_phrases(docs, pairs)]
    monkeypatch.setattr(clean, "INLINE_LEXICON", 2)
    monkeypatch.setattr(phrases, "INLINE_PHRASES", 2)
    monkeypatch.setattr(module.lookup, "__defaults__", (3, 0))
    got = [clean.expand_slang(docs, lexicon), phrases.join_phrases(docs, pairs)]
    for w, g in zip(want, got):
        assert sorted(map(tuple, g.collect()), key=repr) == sorted(map(tuple, w.collect()), key=repr)
