"""Boundary sets against sorted lists, and fill-in-the-middle against Python strings."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import boundaries, fill_in_middle, words

rng = random.Random(5)


def mask_of(kind, n):
    gen = np.random.default_rng(7)
    return {
        "none": np.zeros(n, bool), "all": np.ones(n, bool), "sparse": gen.random(n) < 0.001, "dense": gen.random(n) < 0.6,
        "runs": np.repeat(gen.random(n // 97 + 1) < 0.5, 97)[:n],
    }[kind]


@pytest.mark.parametrize("kind", ["none", "all", "sparse", "dense", "runs"])
@pytest.mark.parametrize("n", [0, 1, 65536, 65537, 200_000])
def test_select_finds_every_member(kind, n):
    inside = mask_of(kind, n)
    bounds = boundaries.BoundarySet(inside)
    members = np.flatnonzero(inside)
    assert len(bounds) == len(members)
    assert (bounds.select(np.arange(len(members))) == members).all()
    with pytest.raises(IndexError):
        bounds.select([len(members)])


def test_each_kind_of_container_is_used():
    kinds = {type(c).__name__ for k in ("all", "sparse", "dense") for c in boundaries.BoundarySet(mask_of(k, 65536)).containers}
    assert kinds == {"RunContainer", "ArrayContainer", "BitmapContainer"}


def by_hand(doc_id, text):
    t = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in fill_in_middle.MARKERS) or h[2] % 100 >= 90:
        return doc_id, "plain", n, None, None, t
    if h[3] % 100 < 20:
        return doc_id, "spm", n, a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return doc_id, "psm", n, a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def cases():
    letters = "abc é ∂ 語 \U0001f600 \n<>PSM"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "a<P>b", "<S>", "x<M>", "<", "<<P", "P>", "é", "\U0001f600" * 70_000, "ab" * 400_000]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "again"), (3, "again"), (-5, "minus")]


def test_equals_strings(spark, monkeypatch):
    rows = cases()
    docs = spark.createDataFrame([(d, t, "old", 1) for d, t in rows], "doc_id long, text string, FORM string, keep int")
    done = fill_in_middle.transform(docs)
    assert done.columns == ["doc_id", "text", "keep", *fill_in_middle.ADDED]
    got = done.withColumn("back", fill_in_middle.restored()).collect()
    assert [(r.doc_id, r.form, r.n, r.prefix_chars, r.middle_chars, r.fim_text) for r in got] == [by_hand(*r) for r in rows]
    assert [r.back for r in got] == [t or "" for _, t in rows]
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_small_pieces_give_the_same_cuts():
    import pyarrow as pa

    texts = pa.array([t for _, t in cases() if t is None or len(t) < 1000])
    rows = np.arange(len(texts)) * 7919
    wanted = None
    for limit in (1, 100, words.PIECE):
        found = []
        for part in words.pieces(texts, limit):
            a = rows[part.first : part.first + len(part)]
            units, low, middle, cut, end = fill_in_middle.cut_places(part, a, a * 31)
            found += list(zip(units, low, middle, cut - part.offsets[:-1], end - part.offsets[:-1]))
        wanted = wanted or found
        assert found == wanted


def test_empty_table_and_other_markers(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle.report(none).collect() == []
    docs = spark.createDataFrame([(i, f"text <P> {i}") for i in range(50)], "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    done = fill_in_middle.transform(docs, seed=2, share=100, spm=50, markers=marks)
    got = done.withColumn("back", fill_in_middle.restored(markers=marks)).where(F.col("back") != F.col("text"))
    assert got.count() == 0
    assert {r.form for r in done.select("form").distinct().collect()} == {"psm", "spm"}
