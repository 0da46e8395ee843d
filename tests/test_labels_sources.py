"""Label functions, readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import labels
from textloom.operators import aggregates, ranking
from textloom.plans.corpus_profile import corpus_profile
from textloom.sources import readers, writers


def column(spark, values, fn, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in frame.orderBy("i").select(fn(F.col("v")).alias("r")).collect()]


def test_map_and_coerce(spark):
    assert column(spark, [0, 1, 2, 9], lambda c: labels.map_label(c, {0: 0, 1: 1, 2: 1}), "int") == [0, 1, 1, None]
    assert column(spark, ["2", "1.7", "x", None, "nan"], labels.coerce_label) == [2, 1, -1, -1, -1]
    assert column(spark, [" ﻿a b ", None], labels.clean_raw_text) == ["a b", ""]
    assert column(spark, [" neg ", None], labels.clean_raw_label) == ["NEG", ""]
    assert column(spark, [" ", None, "1"], labels.label_or_missing) == ["<missing>", "<missing>", "1"]


def test_label_order(spark):
    frame = spark.createDataFrame([("b",), ("10",), ("2",), ("<missing>",)], "label string")
    ordered = ranking.order_labels(frame).orderBy("position")
    assert [r.label for r in ordered.collect()] == ["2", "10", "<missing>", "b"]


def test_histogram_edges(spark):
    frame = spark.createDataFrame([(v,) for v in (0, 9, 10, 500, 501)], "v int")
    bins = {r.bin: (r.label, r.n) for r in aggregates.histogram(frame, "v", 10, 500).collect()}
    assert len(bins) == 51
    assert bins[0] == ("0-9", 2) and bins[1] == ("10-19", 1) and bins[49] == ("490-500", 1) and bins[50] == ("omitted", 1)
    assert sum(n for _, n in bins.values()) == 5


def test_histogram_auto_covers_all(spark):
    frame = spark.createDataFrame([(v,) for v in [3, 3, 4, 90]], "v int")
    rows = aggregates.histogram_auto(frame, "v").collect()
    assert len(rows) == 40 and sum(r.n for r in rows) == 4
    single = aggregates.histogram_auto(spark.createDataFrame([(7,), (7,)], "v int"), "v").collect()
    assert [(r.label, r.n) for r in single] == [("7", 2)]


def test_csv_fallback_and_splits(spark, tmp_path):
    (tmp_path / "utf8.csv").write_bytes('﻿text,label\n"a, ""đ""\nline",1\n'.encode())
    (tmp_path / "latin.csv").write_bytes("text,label\ncafé,0\n".encode("latin-1"))
    row = readers.read_csv_fallback(spark, str(tmp_path / "utf8.csv")).first()
    assert row.text == 'a, "đ"\nline' and row.label == "1"
    assert readers.read_csv_fallback(spark, str(tmp_path / "latin.csv")).first().text == "café"
    (tmp_path / "lines.csv").write_text("text\n" + "a line\n" * 5000)
    lines = readers.read_splits(spark, {"train": str(tmp_path / "lines.csv")}, line_breaks=False)
    assert lines.count() == 5000 and lines.filter("text = 'a line'").count() == 5000
    both = readers.read_splits(
        spark,
        {"train": [str(tmp_path / "none.csv"), str(tmp_path / "utf8.csv")], "test": str(tmp_path / "latin.csv")},
        required=["text", "label"],
    )
    assert sorted(r.split for r in both.collect()) == ["test", "train"]
    with pytest.raises(ValueError, match="found"):
        readers.require_columns(both, ["nope"])
    with pytest.raises(FileNotFoundError):
        readers.resolve_path(spark, [str(tmp_path / "none.csv")])


def test_gbk(spark, tmp_path):
    (tmp_path / "gbk.csv").write_bytes("content\n你好\n".encode("gbk"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        assert readers.read_csv(spark, str(tmp_path / "gbk.csv"), encoding="gbk").first().content == "你好"
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_lexicon_and_vectors(spark, tmp_path):
    (tmp_path / "slang.txt").write_text("KO\tKhông\nko\tkhong\nbad\n", encoding="utf-8")
    found = readers.read_lexicon(spark, str(tmp_path / "slang.txt")).collect()
    assert [(r.term, r.expansion) for r in found] == [("ko", "khong")]
    assert readers.read_lexicon(spark, str(tmp_path / "absent.txt")).count() == 0
    (tmp_path / "v.vec").write_text("2 3\na 1 2 3\nb 1 2\nc 1 x 3\nd 0.5 0 -1 \n", encoding="utf-8")
    rows = {r.word: list(r.vec) for r in readers.read_word_vectors(spark, str(tmp_path / "v.vec"), 3).collect()}
    assert rows == {"a": [1, 2, 3], "d": [0.5, 0, -1]}


def test_writers(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "ko biết :)", 0, "train"), (2, "ko biết", 1, "test"), (3, "", None, "train")],
        "doc_id int, text string, label int, split string",
    )
    writers.write_table(docs, str(tmp_path / "splits"), ["text", "label", "split"], by=["split"])
    back = spark.read.options(header=True).csv(str(tmp_path / "splits"))
    assert back.count() == 3 and set(back.columns) == {"text", "label", "split"}
    profile = corpus_profile(docs.na.fill({"label": 0}), [0, 1], ["ko"])
    writers.write_summary(profile, str(tmp_path / "summary"))
    text = next((tmp_path / "summary" / "json").glob("*.json")).read_text()
    assert json.loads(text)["vocabulary"]["stopword_tokens"] == 2
    assert spark.read.text(str(tmp_path / "summary" / "text")).count() == len(profile.columns)
    results = spark.createDataFrame(
        [("m", 0.5, 0.4, 0.3, 0.5, 0.1, 0.6)],
        "model string, accuracy double, macro_f1 double, f1_clean double, f1_toxic double, threshold double, valid_macro_f1 double",
    )
    for _ in range(2):
        writers.write_results(results, str(tmp_path / "results"), log=str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    assert spark.read.options(header=True).csv(str(tmp_path / "results" / "csv")).columns == list(writers.RESULT_COLUMNS)
