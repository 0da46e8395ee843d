"""The registered language model: its order, its blocks, and its scores against counts by hand."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import lm, queries

rng = random.Random(3)
VOCAB = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(40)]
TEXTS = [" ".join(rng.choice(VOCAB) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", "the " * 700]


def scores_by_hand(texts, held, order):
    """log10 probability of each text by interpolated modified Kneser-Ney of the texts not held out."""
    streams = [re.findall(r"[^ ]+", t or "") + ["\n"] for t in texts]
    levels = {order: collections.Counter()}
    for t, h in zip(streams, held):
        padded = ["\t"] * (order - 1) + t
        if not h:
            levels[order].update(tuple(padded[i : i + order]) for i in range(len(t)))
    for k in range(order - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    facts = {}
    for k, c in levels.items():
        by = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, n in c.items():
            by[g[:-1]][0] += n
            by[g[:-1]][min(n, 3)] += 1
        of = collections.Counter(c.values())
        facts[k] = by, lm.discounts(of[1], of[2], of[3], of[4])
    known = {w for t, h in zip(streams, held) for w in t if not h}
    out = []
    for t in streams:
        padded, score = ["\t"] * (order - 1) + t, 0.0
        for i in range(len(t)):
            p, gram = 1 / (len(known) + 1), tuple(padded[i : i + order])
            for k in range(1, order + 1):
                by, d = facts[k]
                g = gram[-k:]
                if by[g[:-1]][0]:
                    total, *n = by[g[:-1]]
                    c = levels[k][g]
                    p = (max(c - (0, *d)[min(c, 3)], 0) + sum(x * y for x, y in zip(d, n)) * p) / total
            score += math.log10(p)
        out.append(score)
    return out


def test_registered_query_scores_with_contexts_of_two_words(spark, tmp_path):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op5_lm_scoring"](spark, str(tmp_path)).orderBy("doc_id").collect()
    held = [r.held_out for r in got]
    assert any(held) and not all(held)
    assert [r.score for r in got] == pytest.approx(scores_by_hand(TEXTS, held, 3))


@pytest.mark.parametrize("order", [1, 2, 4])
def test_other_orders(spark, order):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = lm.report(frame, F.col("doc_id") % 4 == 0, order).orderBy("doc_id").collect()
    assert [r.score for r in got] == pytest.approx(scores_by_hand(TEXTS, [i % 4 == 0 for i in range(len(TEXTS))], order))


@pytest.mark.parametrize("names", [50, 70_000])
def test_blocks_keep_words_and_counts(names):
    some = np.random.default_rng(1)
    words = some.integers(0, 1 << 63, names).astype(np.uint64)
    heavy = np.sort(words[:20])
    rows = lm.combine([lm.grams(words[some.integers(0, names, (90_000, 3))], some.integers(1, 1 << 24, 90_000), heavy)])
    again = lm.combine([lm.from_block(lm.to_block(rows), heavy)])
    for name in ("words", "ctx", "spread", "count"):
        assert np.array_equal(getattr(again, name), getattr(rows, name))


def test_only_heavy_words_reach_the_driver(spark, monkeypatch):
    """Rows of words are kept for the raw counts alone, and those that are no quarter of a share are not collected."""
    merged, levels = [], []
    merge, level = lm.merge, lm._level
    monkeypatch.setattr(lm, "merge", lambda *a, **k: merged.append(merge(*a, **k)) or merged[-1])
    monkeypatch.setattr(lm, "_level", lambda m: levels.append(level(m)) or levels[-1])
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    model = lm.fit(frame)
    words = [m.where("word is not null").count() for m in merged]
    counts = collections.Counter(w for t in TEXTS for w in re.findall(r"[^ ]+", t or "") + ["\n"])
    want = [n for n in counts.values() if n * 4 * model.parts > sum(counts.values())]
    assert len(model.heavy) == len(want) + 1 and 0 < len(want) < len(counts)
    assert len(want) <= words[0] <= 4 * model.parts * model.parts and words[1:] == [0, 0, 0]
    assert not any(hasattr(x, "heavy") for x in levels)


def test_blocks_hold_numbers_of_words(tmp_path):
    """Words are sent as places in the raw arrays: under two bytes a distinct word, where a hash takes eight."""
    some = np.random.default_rng(2)
    words = np.unique(np.append(some.integers(0, 1 << 63, 30_000).astype(np.uint64), lm.END))
    assert np.array_equal(lm.unmix(lm.mix(words)), words)
    zero, parts, prefixes, sizes = np.zeros(len(words), np.uint64), 5, {}, [0]
    part = lm.part_of(zero, words, np.ones(len(words), bool), parts)
    known = words[part != 3]  # one partition is empty, and its words are unknown
    for p in range(parts):
        mine = np.sort(lm.pair_key(zero, words)[part == p]) if p != 3 else zero[:0]
        sizes.append(len(mine))
        if len(mine):
            prefixes[p] = f"{tmp_path}/{p}"
            for kind in ("keys", "contexts", *(f"{k}{e}" for k in ("counts", "facts") for e in ("", "-large", "-exact"))):
                lm._write(f"{prefixes[p]}.{kind}", mine if kind == "keys" else mine[:0])
    vocabulary = lm.Vocabulary(prefixes, np.cumsum(sizes).astype(np.uint64))
    named = np.append(known, lm.BEGIN)
    assert sorted(vocabulary.numbers(named)) == list(range(len(named)))
    assert np.array_equal(vocabulary.words(vocabulary.numbers(named)), named)
    with pytest.raises(RuntimeError):
        vocabulary.numbers(words)

    rows = lm.combine([lm.grams(named[:, None], np.ones(len(named), np.int64), np.array([lm.BEGIN]))])
    block = lm.to_block(rows, vocabulary)
    assert len(block) < 2 * len(named)
    again = lm.combine([lm.from_block(block, np.array([lm.BEGIN]), vocabulary)])
    assert np.array_equal(again.words, rows.words) and np.array_equal(again.count, rows.count)


def folder_size(path):
    return sum(f.stat().st_size for f in path.iterdir())


def test_files_of_hashes_leave_out_the_first_bits(tmp_path):
    """Six bytes a hash and an index; hashes with equal first or all but last bits, and unknown ones, are told apart."""
    some = np.random.default_rng(3)
    hashes = some.integers(0, 1 << 64, 400_000, np.uint64, endpoint=False)
    near = hashes[:50, None] ^ np.arange(7, dtype=np.uint64)
    edges = np.array([0, 1, (1 << 64) - 1, 5 << 48], np.uint64)
    hashes = np.unique(np.concatenate([hashes, near.ravel(), edges]))
    lm._write_hashes(f"{tmp_path}/a", "keys", hashes, whole=False)
    assert folder_size(tmp_path) < 7 * len(hashes)
    files = lm.Files(f"{tmp_path}/a")
    unknown = np.setdiff1d(np.concatenate([hashes[::3] + np.uint64(1), near.ravel() ^ np.uint64(1 << 20), near.ravel() + np.uint64(9)]), hashes)
    asked = some.permutation(np.concatenate([hashes, unknown]))
    where, ok = lm._search(files, "keys", asked)
    assert np.array_equal(ok, np.isin(asked, hashes))
    assert np.array_equal(hashes[where[ok]], asked[ok])
    assert len(lm._search(files, "keys", asked[:0])[1]) == 0

    lm._write_hashes(f"{tmp_path}/b", "keys", hashes[:0], whole=False)
    assert not lm._search(lm.Files(f"{tmp_path}/b"), "keys", asked)[1].any()


def test_facts_of_a_context_are_one_byte(tmp_path):
    some = np.random.default_rng(4)
    ones, twos, more = some.geometric(0.7, (3, 300_000)) - 1
    facts = np.stack([ones + 2 * twos + 3 * more, ones, twos, more], axis=1)[ones + twos + more > 0]
    facts[::50_000] = some.integers(1 << 14, 1 << 40, (len(facts[::50_000]), 4))
    facts[1] = [(1 << 16) - 1] * 4
    facts[2] = [1 << 16, 0, 0, 1]
    lm._write_facts(f"{tmp_path}/a", facts)
    assert folder_size(tmp_path) < 1.2 * len(facts)
    at = some.permutation(len(facts))
    assert np.array_equal(lm._facts(lm.Files(f"{tmp_path}/a"), at, np.eye(4)), facts[at])
    lm._write_facts(f"{tmp_path}/b", facts[:0])
    assert lm._facts(lm.Files(f"{tmp_path}/b"), at[:0], np.eye(4)).shape == (0, 4)


@pytest.mark.parametrize("order, names", [(1, 9), (3, 200_000), (4, 200_000), (3, 1 << 23)])
def test_counts_of_equal_rows_are_summed(order, names):
    """Also where the places of a row need more than one number of 64 bits."""
    some = np.random.default_rng(5)
    rows = some.integers(0, names, (900, order))[some.integers(0, 900, 5_000)]
    count = some.integers(1, 1000, len(rows))
    want = collections.Counter()
    for row, n in zip(rows.tolist(), count.tolist()):
        want[tuple(row)] += n
    columns, found = lm.summed(rows.T.astype(np.int32), count, names)
    assert list(zip(map(tuple, columns.T.tolist()), found.tolist())) == sorted(want.items())
    columns, found = lm.summed(rows.T.astype(np.int32), None, names)
    assert dict(zip(map(tuple, columns.T.tolist()), found.tolist())) == collections.Counter(map(tuple, rows.tolist()))


def test_each_partition_of_blocks_is_a_task(spark, monkeypatch):
    """Numbers of partitions are not hashed: two would meet in one task."""
    plans = []
    monkeypatch.setattr(lm, "stored", lambda df, name: plans.append(df) or df)
    blocks = spark.createDataFrame([(i % 31, b"") for i in range(310)], lm.BLOCKS)
    lm.merge(blocks, "", 1, 31, np.array([lm.BEGIN]))
    dealt = blocks.repartitionById(31, F.col("part")).groupBy("part", F.spark_partition_id().alias("task")).count().collect()
    assert sorted((r.part, r.task) for r in dealt) == [(i, i) for i in range(31)]
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partitionidpassthrough" in plan.lower()
