"""Block-parallel CSV against Python's csv module, with quotes and line breaks in fields."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from textloom.sources import csv_blocks
from textloom.sources.csv_blocks import block_session, open_blocks, read_csv_blocks, read_lines
from textloom.sources.readers import read_csv, read_csv_fallback

HEAD = ["id", "text", "x y"]


def some_rows(n, seed=4):
    rng = random.Random(seed)
    parts = ["a", "b ", "\n", '"', ",", "é", "\r\n", "x" * 30, "\n\n"]
    return [(str(i), "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))), rng.choice(["", 'q"q', "p\nq"])) for i in range(n)]


def written(rows, head=HEAD, end="\n", encoding="utf-8"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(head)
    writer.writerows(rows)
    return out.getvalue().encode(encoding)


def same(frame, rows):
    """Empty fields are null, as everywhere in Spark's CSV."""
    got = sorted((tuple(r) for r in frame.collect()), key=repr)
    return got == sorted((tuple(v or None for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("size", [None, 20_000, 700])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_csv_module(spark, tmp_path, size, end):
    rows = some_rows(600)
    (tmp_path / "a.csv").write_bytes(written(rows, end=end))
    frame = read_csv_blocks(spark, str(tmp_path / "a.csv"), block_bytes=size)
    assert frame.columns == HEAD
    assert same(frame, rows)


def test_records_longer_than_blocks(spark, tmp_path):
    rows = [("1", "a\n" * 900, ""), ("2", 'say "x"\n' * 500, "z"), ("3", "b", "c")]
    (tmp_path / "a.csv").write_bytes(written(rows))
    assert same(read_csv_blocks(spark, str(tmp_path / "a.csv"), block_bytes=97), rows)


def test_one_file_is_many_tasks(spark, tmp_path):
    rows = some_rows(4000)
    (tmp_path / "a.csv").write_bytes(written(rows))
    whole = (tmp_path / "a.csv").stat().st_size
    frame = read_csv(spark, str(tmp_path / "a.csv"))
    assert frame.rdd.getNumPartitions() >= 4
    session = block_session(spark, str(tmp_path / "a.csv"), None)
    lines = read_lines(session, str(tmp_path / "a.csv"))
    share = lines.groupBy(F.spark_partition_id()).agg(F.sum(F.length("value") + 1).alias("n")).collect()
    assert len(share) >= 4 and max(r.n for r in share) < whole / 3
    assert open_blocks(lines) <= {(f, b) for f, b in lines.select("file", "block").distinct().collect()}


def test_blocks_do_not_follow_later_settings(spark, tmp_path):
    rows = some_rows(300)
    (tmp_path / "a.csv").write_bytes(written(rows))
    frame = read_csv_blocks(spark, str(tmp_path / "a.csv"), block_bytes=5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1234")
        assert same(frame, rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_folder_schema_and_mark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"\xef\xbb\xbf" + written([("1", "x\ny", "")]))
    (tmp_path / "in" / "b.csv").write_bytes(written([("2", "z", "w"), ("oops", "t", "u")]).rstrip(b"\n"))
    (tmp_path / "in" / "c.csv").write_bytes(written([]))
    (tmp_path / "in" / "d.csv").write_bytes(b"id,text,x y\n\n   \n3,only\n")
    plain = read_csv_blocks(spark, str(tmp_path / "in"))
    assert plain.columns == HEAD
    typed = read_csv_blocks(spark, str(tmp_path / "in"), "n long, text string, rest string")
    got = sorted((tuple(r) for r in typed.collect()), key=repr)
    assert got == sorted([(1, "x\ny", None), (2, "z", "w"), (None, "t", "u"), (3, "only", None)], key=repr)


def test_quoted_header_and_unclosed_quote(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,"two\nlines"\n1,x\n2,"never closed\nand more\n')
    frame = read_csv_blocks(spark, str(tmp_path / "a.csv"), block_bytes=6)
    assert frame.columns == ["id", "two\nlines"]
    assert [r[0] for r in frame.orderBy("id").collect()] == ["1", "2"]


def test_encodings(spark, tmp_path):
    rows = [("1", "café\ncrème", "ñ"), ("2", "ü", "")]
    (tmp_path / "l.csv").write_bytes(written(rows, encoding="latin-1"))
    path = str(tmp_path / "l.csv")
    assert same(read_csv(spark, path, encoding="iso-8859-1"), rows)
    assert "�" in "".join(str(r) for r in read_csv(spark, path).collect())
    assert same(read_csv_fallback(spark, path, ("utf-8", "iso-8859-1")), rows)
    (tmp_path / "w.csv").write_bytes(written(rows, encoding="utf-16"))
    assert same(read_csv(spark, str(tmp_path / "w.csv"), encoding="utf-16"), rows)


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"")
    assert read_csv_blocks(spark, str(tmp_path / "e.csv"), "a string").collect() == []
    assert csv_blocks.LEAST_BLOCK > 0
