"""Segmentation by a lattice against an exhaustive search over all segmentations."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from textloom.operators.lattice import Lattice, PhraseModel, Stretches, fit_phrases

PIECES = {"a": 900, "b": 1200, "c": 1500, "a b": 1700, "b c": 2500, "a b c": 3000, "c a": 2000, "a a": 1799, "b c a b": 2900, "x y": 10}
UNKNOWN = 4000


def segmentations(words):
    """All ways to cut words into pieces of the model; single words are always allowed."""
    if not words:
        yield []
        return
    for n in range(1, min(4, len(words)) + 1):
        piece = " ".join(words[:n])
        if n == 1 or piece in PIECES:
            for rest in segmentations(words[n:]):
                yield [piece, *rest]


def cost(path):
    return sum(PIECES.get(p, UNKNOWN) for p in path)


def lattice():
    return Lattice(list(PIECES), np.array(list(PIECES.values())), UNKNOWN)


def flat(texts):
    words = [w for t in texts for w in t]
    return pa.array(words, pa.string()), np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def sentences(n, size, letters="abcxyz"):
    rng = random.Random(n)
    return [[rng.choice(letters) for _ in range(rng.randint(0, size))] for _ in range(n)]


def test_best_path_is_the_cheapest_of_all():
    texts = sentences(300, 9)
    starts = Stretches(lattice(), *flat(texts)).piece_starts()
    at = 0
    for words in texts:
        mine = starts[at : at + len(words)]
        at += len(words)
        cuts = [i for i, s in enumerate(mine) if s] + [len(words)]
        path = [" ".join(words[i:j]) for i, j in itertools.pairwise(cuts)]
        best = min(segmentations(words), key=lambda p: (cost(p), [-len(x.split()) for x in reversed(p)]))
        assert path == best


def test_expected_counts_are_those_of_all_paths():
    texts = sentences(120, 8)
    want = dict.fromkeys(PIECES, 0.0)
    for words in texts:
        paths = [(p, math.exp(-cost(p) / 1000)) for p in segmentations(words)]
        whole = sum(w for _, w in paths)
        for path, weight in paths:
            for piece in path:
                if piece in want:
                    want[piece] += weight / whole
    got = Stretches(lattice(), *flat(texts)).expected()
    assert got == pytest.approx(list(want.values()), abs=1e-9)


def test_long_stretches_do_not_underflow():
    words, owner = flat([["a", "b", "c"] * 20_000])
    got = Stretches(lattice(), words, owner)
    assert got.length.max() == 60_000
    expected = got.expected()
    lengths = [len(p.split()) for p in PIECES]
    assert float(np.dot(expected, lengths)) == pytest.approx(60_000, rel=1e-6)


@pytest.mark.parametrize("texts", [[], [[]], [[], ["x"], []], [["q", "q"]]])
def test_empty_and_unknown(texts):
    found = Stretches(lattice(), *flat(texts))
    assert found.piece_starts().all()
    assert found.expected().shape == (len(PIECES),)


def test_a_model_without_phrases_keeps_words_apart():
    found = Stretches(Lattice([], np.zeros(0), 7), *flat([["a", "b"]]))
    assert found.piece_starts().tolist() == [True, True]


def test_fit_and_segment(spark, tmp_path):
    rng = random.Random(2)
    filler = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = rng.choices(filler, k=12)
        words[3:3] = ["new", "york", "city", "hall"] if i % 2 else ["ice", "cream"]
        rows.append((i, " ".join(words), "kept"))
    rows += [(900, None, "kept"), (901, "", "kept"), (902, "  new   york ", "kept"), (903, "never seen", "kept"), (3, rows[3][1], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, phrase string")
    model = fit_phrases(docs)
    phrases = {r.phrase: r for r in model.pieces.where("n_words > 1").collect()}
    assert "new york city hall" in phrases and "ice cream" in phrases
    assert phrases["new york city hall"].expected > 55
    assert "new york" not in phrases and "york city hall" not in phrases
    got = model.segment(docs)
    assert got.columns == docs.columns
    texts = {(r.doc_id, r.phrase): r.text for r in got.collect()}
    assert "new_york_city_hall" in texts[1, "kept"] and "ice_cream" in texts[0, "kept"]
    assert all(texts[i, "kept"].replace("_", " ") == rows[i][1] for i in range(120))
    assert texts[900, "kept"] is None and texts[901, "kept"] == "" and texts[3, "again"] == texts[3, "kept"]
    assert texts[902, "kept"] == "new york" and texts[903, "kept"] == "never seen"
    model.save(f"{tmp_path}/model")
    again = PhraseModel.load(spark, f"{tmp_path}/model").segment(docs)
    assert {(r.doc_id, r.phrase): r.text for r in again.collect()} == texts


def test_bounds_keep_the_commonest(spark):
    docs = spark.createDataFrame([(" ".join(["a b c d"] * 9 + ["e f"] * 6),)], "text string")
    model = fit_phrases(docs, max_phrases=1, min_pmi=0.0, rounds=0)
    kept = {r.phrase for r in model.pieces.where("n_words > 1").collect()}
    assert len(kept) <= 3 and "e f" not in kept


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "text string")
    model = fit_phrases(docs)
    assert model.pieces.count() == 0
    assert model.segment(docs).collect() == []
    some = spark.createDataFrame([("a b",)], "text string")
    assert [r.text for r in model.segment(some).collect()] == ["a b"]


def test_model_holds_every_word_but_sends_only_those_of_phrases(spark, monkeypatch):
    texts = [" ".join(f"new york word{i}_{j}" for j in range(3)) for i in range(40)] + [" ".join(f"york z{j}" for j in range(9))]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = fit_phrases(docs, min_pmi=0.5)
    pieces = {r.phrase: r for r in model.pieces.collect()}
    assert len(pieces) == 120 + 9 + 3 and pieces["word7_2"].expected == 1
    assert sorted(model.edges()["phrase"].to_pylist()) == ["new", "new york", "york"]
    # A phrase that leaves the model gives its words their whole count back.
    bare = fit_phrases(docs, min_pmi=0.5, min_expected=1e9)
    assert {r.phrase: r.expected for r in bare.pieces.collect()}["york"] == 129


def test_a_lattice_takes_some_bytes_for_each_piece():
    """No list, string or row of Python's for a phrase, which is what filled the driver."""
    import tracemalloc

    pieces = [f"w{i % 5000} v{i // 5000} u{i % 7}" for i in range(60_000)]
    tracemalloc.start()
    built = Lattice(pieces, np.arange(60_000), 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(pieces) and built.longest == 3
    words, owner = flat([p.split(" ") for p in pieces[:50]])
    assert built.edges(words, owner)[2][1].tolist() == list(range(50))


def test_expected_counts_stay_out_of_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([("new york is new and york is york and new york " * 9,)], "text string")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *args, **named: pytest.fail("a table came from the driver"))
    model = fit_phrases(docs, min_pmi=0.1)
    kept = {r.phrase: r.expected for r in model.pieces.collect()}
    assert sum(n * len(p.split()) for p, n in kept.items()) == pytest.approx(99, abs=0.01)
