"""The pipeline's stages against brute force on planted rows."""

import collections
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from textloom.llm import suffix_dedup
from textloom.llm.queries import QUERIES

rng = random.Random(11)


def fresh(n, size=5):
    """n words that occur nowhere else (26^8 choices), some with a character beyond ASCII."""
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size + 3)) + rng.choice(["", "", "é"]) for _ in range(n)]


def cut_by_hand(texts, n):
    """Bytes that no ``n`` words cover that also start elsewhere, byte for byte."""
    raws = [t.encode() if t is not None else b"" for t in texts]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)] for raw in raws]
    seen = collections.Counter(raw[w[i][0] : w[i + n - 1][1]] for raw, w in zip(raws, spans) for i in range(len(w) - n + 1))
    out = []
    for t, raw, w in zip(texts, raws, spans):
        gone = bytearray(len(raw))
        for i in range(len(w) - n + 1):
            a, b = w[i][0], w[i + n - 1][1]
            if seen[raw[a:b]] > 1:
                gone[a:b] = b"\x01" * (b - a)
        out.append(t if t is None else bytes(c for c, g in zip(raw, gone) if not g).decode())
    return out


def cut(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    run = suffix_dedup.trimmed(frame, **options) if options else corpus_pipeline.repeated_passages(spark, frame, "")
    return [r.text for r in run.orderBy("doc_id").collect()]


def test_passages_just_over_50_words_go(spark):
    short = [w[:4] for w in fresh(51)]  # 51 words of about 280 bytes and less
    tiny = [c for c in "abcdefghijklmnopqrstuvwxyz" * 2][:51]  # 101 bytes
    fifty, long_words = fresh(50, 9), fresh(50, 40)  # the last has over 400 bytes in 50 words
    around = [fresh(30) for _ in range(9)]

    def text(i, passage):
        return " ".join(around[i][:15] + passage + around[i][15:])

    texts = [text(0, short), text(1, short), text(2, tiny), text(3, tiny), text(4, fifty), text(5, fifty)]
    texts += [text(6, long_words), text(7, long_words), text(8, []), None, "", " \n", " ".join(fresh(300))]
    got = cut(spark, texts)
    assert got == cut_by_hand(texts, 51)
    assert got[0].split() == around[0] and got[2].split() == around[2]
    assert got[4:9] == texts[4:9]


def test_op10_counts_bytes_and_the_stage_words(spark, tmp_path):
    """The query cuts repeats of 400 bytes and none of 399, although both have 80 words; the stage cuts both by their words."""
    many, more = (" ".join(w[:4] for w in fresh(80)) for _ in range(2))
    more += "x"
    assert (len(many), len(more)) == (399, 400)
    # A digit on either side ends the repeat.
    texts = [" ".join(fresh(20)) + f"{i}{p}{i}" + " ".join(fresh(20)) for i, p in enumerate([many, many, more, more])]
    texts += [" ".join(fresh(200)), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op10_suffix_array_dedup"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r.n_removed, r.n_spans) for r in got] == [(0, 0), (0, 0), (400, 1), (400, 1), (0, 0), (0, 0)]
    assert [r.n_bytes for r in got] == [len((t or "").encode()) for t in texts]
    left = cut(spark, texts)
    assert left == cut_by_hand(texts, 51) and all(len(a) < len(b) - 300 for a, b in zip(left[:4], texts[:4]))


def test_two_short_repeats_side_by_side_stay(spark):
    """Neighbouring repeats of 30 words from two other texts are no repeat of 60."""
    a, b = fresh(30), fresh(30)
    texts = [" ".join(a + b), " ".join(fresh(9) + a + fresh(9)), " ".join(fresh(9) + b + fresh(9))]
    assert cut(spark, texts) == texts


@pytest.mark.parametrize("options", [{}, {"split": 3, "shard_bytes": 2000}])
def test_word_windows_equal_brute_force(spark, monkeypatch, options):
    vocab = fresh(40, 1)

    def some(n):
        return "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\n", "  "]) for _ in range(n))

    passages = [some(rng.randint(5, 14)) for _ in range(5)]
    texts = ["".join(rng.choice([some(8), rng.choice(passages)]) for _ in range(rng.randint(1, 7))) for _ in range(80)]
    texts += [None, "", "a " * 500, texts[0], some(3000)]
    want = cut_by_hand(texts, 7)
    assert sum(len(t) for t in texts if t) - sum(len(t) for t in want if t) > 1000
    assert cut(spark, texts, length=7, gram=3, words=True, **options) == want


def test_segments_of_a_long_text(monkeypatch):
    """Cutting a text's windows into segments loses none."""
    import numpy as np

    from textloom.llm.words import Texts

    raw = np.frombuffer((" ".join(fresh(500))).encode(), np.uint8)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 70)
    ranges = []
    for _, _, _, n, _, start in suffix_dedup._word_contexts(Texts(0, raw, np.array([0, len(raw)])), 51, 25):
        ranges += [len(bytes(raw[a : a + k]).split()) - 50 for a, k in zip(start, n)]
    assert sum(ranges) == 450


def test_near_copies_keep_every_different_text(spark):
    """Rows that share a doc_id are judged by their texts; one row of each group stays, with its columns."""
    from textloom.llm import ngram_join

    a, z, q, r, s = (" ".join(fresh(40)) for _ in range(5))
    near = a.replace(" ", "  ", 3) + " tail"  # 36 of 37 shingles
    rows = [(2, a, 1), (2, z, 1), (3, q, 1), (3, r, 1), (4, near, 1), (5, z, 1), (6, s, 2), (6, s, 1), (6, s, 2), (7, None, 1), (7, None, 1)]
    rows += [(8, "", 1), (None, a, 1), (None, a, 1), (1, r + " end", 1), (9, "...", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _doc_extra int")
    got = sorted((tuple(x) for x in ngram_join.keep_one(docs).collect()), key=repr)
    want = [(2, a, 1), (2, z, 1), (3, q, 1), (6, s, 1), (7, None, 1), (7, None, 1), (8, "", 1), (None, a, 1), (None, a, 1), (1, r + " end", 1), (9, "...", 1)]
    assert got == sorted(want, key=repr)
    assert ngram_join.keep_one(docs.limit(0)).collect() == []


def groups_by_hand(rows, size=5, threshold=0.8):
    """Connected groups of near copies by comparing all pairs of shingle sets."""
    def shingles(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_near_copies_stage_equals_brute_force(spark):
    base = [fresh(rng.randint(8, 60)) for _ in range(25)]
    rows = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = fresh(1)[0]
        rows.append((rng.randint(0, 90), " ".join(words)))
    rows = list(dict.fromkeys(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {tuple(r) for r in corpus_pipeline.near_copies(spark, frame, "").collect()}
    groups = groups_by_hand(rows)
    for g in set(groups):
        members = [r for r, h in zip(rows, groups) if h == g]
        stays = [m for m in members if m in kept]
        assert len(stays) == 1
        assert stays[0][0] == min(d for d, _ in members)
    assert len(kept) == len(set(groups))


def test_shards_are_dealt_over_tasks_and_hot_contexts_are_not_shuffled(spark, monkeypatch):
    """Small shards do not meet in one task, and the many rows of a context that repeats often do not either."""
    kept, stored = {}, suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name: kept.setdefault(name, df) and stored(df, name))
    some = np.random.default_rng(8)
    hot = bytes(some.integers(97, 123, 60, np.uint8)).decode()
    texts = [bytes(some.integers(97, 123, int(n), np.uint8)).decode() + hot * (i % 3 > 0) for i, n in enumerate(some.integers(0, 200, 300))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    options = {"length": 40, "gram": 20, "shard_bytes": 1 << 10}
    ranges = suffix_dedup.repeated_ranges(frame, **options)
    dealt = kept["shards"]._jdf.queryExecution().executedPlan().toString().lower()
    assert int(re.search(r"direct_shuffle_partition_id\(task#\d+\), (\d+)\)", dealt)[1]) > 1
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan
    seen = collections.Counter(t[i : i + 40] for t in texts for i in range(len(t) - 39))
    gone = [{j for i in range(len(t) - 39) if seen[t[i : i + 40]] > 1 for j in range(i, i + 40)} for t in texts]
    got = suffix_dedup.report(frame, **options).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [len(g) for g in gone] and sum(map(len, gone)) >= 60 * 199
