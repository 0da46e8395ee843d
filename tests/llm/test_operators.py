"""Operators against brute force on small frames with nulls, empty and long texts, ties, copies and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import decontaminate, embedding_dedup, langid, lm, ngram_join, packing, suffix_array, suffix_dedup, token_files, toxicity, warc

random.seed(5)
VOCAB = ["".join(random.choice("abcdeé") for _ in range(random.randint(1, 7))) for _ in range(60)]


def words(n):
    return " ".join(random.choice(VOCAB) for _ in range(n))


PASSAGES = [words(25) for _ in range(4)]
TEXTS = [" ".join(random.choice([words(8), random.choice(PASSAGES)]) for _ in range(random.randint(1, 6))) for _ in range(60)]
TEXTS += [TEXTS[0], TEXTS[0].upper(), TEXTS[1] + " tail", TEXTS[2], None, "", "a", "a", " \n ", "x" * 50_000, words(6000), "İé Z"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}", 1.5, "kept") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s0", 1.5, "kept"), (None, TEXTS[4], None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, n_links string")


def lower(text):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())


def alnum(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def by_row(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_near_duplicates_equal_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [frozenset(tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))) if (w := alnum(t)) else None for _, t in rows]
    links = collections.defaultdict(set)
    for i, (a, x) in enumerate(zip(rows, sets)):
        for j, (b, y) in enumerate(zip(rows, sets)):
            if i != j and a[0] is not None and b[0] is not None and x and y and len(x & y) / len(x | y) >= 0.8:
                links[i].add(j)
    got = {}
    for r in ngram_join.near_duplicates(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, (doc, _) in enumerate(rows):
        if doc is None:
            assert got[None][0].component_id is None and not got[None][0].kept
            continue
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        for r in got[doc]:
            assert r.n_links == len(links[i]) and r.component_id == min(rows[j][0] for j in reach)


def test_keep_one_keeps_columns_and_rows_without_id(docs):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and ids.count(3) == 1 and 60 not in ids and 0 in ids and 64 in ids


def test_blocks_of_a_large_bucket_lose_no_link(spark):
    base = words(60).split()
    rows = [(i, " ".join(base + [f"t{i}"])) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from textloom.llm import buckets

    full = buckets.link.__defaults__
    try:
        buckets.link.__defaults__ = (16, 1 << 20)
        assert {(r.n_links, r.component_id) for r in ngram_join.near_duplicates(df).collect()} == {(89, 0)}
    finally:
        buckets.link.__defaults__ = full


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 16))
    vectors = [(c + 0.03 * rng.normal(size=16) * (i % 5)).tolist() for i, c in enumerate(np.repeat(centres, 20, axis=0))]
    rows = [(i, v, i // 20 % 2) for i, v in enumerate(vectors)]
    rows += [(500, vectors[0], 0), (501, [0.0] * 16, 0), (502, None, 0), (503, [float("nan")] * 16, 0), (504, [], 0), (505, vectors[1], None)]
    rows += [(506, [2 * x for x in vectors[0]], 0), (507, [1.0, 2.0], 0), (None, vectors[0], 0), (508, [None] + vectors[0][1:], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df).collect()}
    sound = [(i, np.array(v), k) for i, v, k in rows if i is not None and k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = collections.defaultdict(set)
    for i, x, a in sound:
        for j, y, b in sound:
            if i != j and a == b and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[i].add(j)
    assert sum(map(len, links.values())) > 100
    for i, *_ in rows:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        assert got[i].n_links == len(links[i])
        assert got[i].component_id == (min(reach) if i is not None else None)


@pytest.mark.parametrize("block", [200_000, 7])
def test_contamination_equals_brute_force(spark, docs, block):
    items = [(1, PASSAGES[0]), (10, PASSAGES[1][:60]), (2, TEXTS[6]), (3, "a"), (4, None), (5, "..."), (None, PASSAGES[2]), (10, PASSAGES[3].upper())]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = alnum(text)
        for s in range(max(1, len(w) - 9) if w and item is not None else 0):
            windows[tuple(w[s : s + 10])].add(str(item))
    want = []
    for r in docs.collect():
        w, hit, found = alnum(r.text), set(), set()
        for s in range(len(w)):
            for n in range(1, 11):
                if s + n <= len(w) and tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        want.append((r.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert by_row(decontaminate.report(docs, benchmark, block=block)) == sorted(want, key=repr)
    clean = decontaminate.clean(docs, benchmark, block=block)
    assert clean.columns == docs.columns and clean.count() == sum(not x[-1] for x in want)


@pytest.mark.parametrize("options", [{}, {"split": 3, "shard_bytes": 2000}])
def test_repeats_equal_brute_force(docs, options):
    rows = docs.where("doc_id is null or doc_id not in (69, 70)").collect()
    raws = [(r.text or "").encode() for r in rows]
    seen = collections.Counter(raw[p : p + 40] for raw in raws for p in range(len(raw) - 39))
    want = []
    for r, raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 39):
            if seen[raw[p : p + 40]] > 1:
                gone[p : p + 40] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        want.append((r.doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    some = docs.where("doc_id is null or doc_id not in (69, 70)")
    assert sum(w[2] for w in want) > 1000
    assert by_row(suffix_dedup.report(some, length=40, gram=20, **options)) == sorted(want, key=repr)


def test_long_runs_and_segments(spark):
    rows = [(1, "x" * 3000), (2, words(400_000)), (3, None)]
    got = {r.doc_id: r for r in suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 3000 and got[2].n_removed == 0 and got[3].n_bytes == 0


def test_suffix_arrays_and_prefixes():
    for n, k in ((1, 1), (50, 1), (200, 2), (300, 3), (2000, 30)):
        s = [random.randint(1, k) for _ in range(n)] + [0]
        order = suffix_array.suffix_array(np.array(s)).tolist()
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        common = suffix_array.common_prefixes(np.array(s), np.array(order), 40)
        for a, b in zip(order, order[1:]):
            length = next((x for x in range(40) if s[a + x] != s[b + x]), 40)
            assert common[b] == length


def test_model_equals_kneser_ney_by_hand(docs):
    held = F.col("doc_id") % 4 == 0
    some = docs.where("doc_id not in (69, 70)")
    got = lm.report(some, held, 3).collect()
    rows = some.collect()
    streams = {id(r): [w for w in re.findall(rb"[^\x20\x09-\x0D]+", lower(r.text))] + ["end"] for r in rows}
    train = [streams[id(r)] for r in rows if r.doc_id % 4]
    levels = {3: collections.Counter()}
    for t in train:
        padded = ["begin"] * 2 + t
        levels[3].update(tuple(padded[i - 2 : i + 1]) for i in range(2, len(padded)))
    for k in (2, 1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    facts = {}
    for k, c in levels.items():
        by = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, n in c.items():
            by[g[:-1]][0] += n
            by[g[:-1]][min(n, 3)] += 1
        of = collections.Counter(c.values())
        facts[k] = by, lm.discounts(of[1], of[2], of[3], of[4])
    raw = collections.Counter(w for t in train for w in t)
    want = []
    for r in rows:
        t = streams[id(r)]
        padded, score = ["begin"] * 2 + t, 0.0
        for i in range(2, len(padded)):
            p = 1 / (len(raw) + 1)
            for k in (1, 2, 3):
                by, d = facts[k]
                g = tuple(padded[i - k + 1 : i + 1])
                if by[g[:-1]][0]:
                    total, *n = by[g[:-1]]
                    c = levels[k][g]
                    p = (max(c - (0, *d)[min(c, 3)], 0) + sum(x * y for x, y in zip(d, n)) * p) / total
            score += math.log10(p)
        total = sum(raw.values())
        base = sum(math.log10((raw[w] + 0.1) / (total + 0.1 * (len(raw) + 1))) for w in t)
        want.append((r.doc_id, r.doc_id % 4 == 0, len(t), sum(w in raw for w in t), total, pytest.approx(base), pytest.approx(score)))
    for a, b in zip(sorted(map(tuple, got)), sorted(want, key=lambda w: w[:2])):
        assert a == b


def test_token_files_round_trip(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    hard = ["a  b", " x", "it's don't  we'll\n\n x", "1² ab²c x٣", "tab\t x \n", "<|endoftext|> a", "'tis don'there", "a b　c", "\x1c x\xa0 y"]
    encoder = token_files.Encoder(path, 2, limit=50)
    for text in hard + [t for t in TEXTS if t]:
        ids = np.frombuffer(encoder.encode([text])[0], np.uint16).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids + [2]
    got = sorted(token_files.round_trip(docs, path, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x or 0))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        ids = np.array(plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_archives_round_trip(spark):
    long = "<p>" + "é" * 600
    rows = [(1, "http://a", long), (2, "http://b\r\nx", long), (3, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", long), (3, "again", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    from textloom.llm.common import scratch

    got = warc.read_records(warc.write_archives(pages, scratch(spark, "warc"))).collect()
    assert len(got) == len(rows)
    for r in got:
        html = (next(x[2] for x in rows if x[0] == r.page_id) or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(html), hashlib.sha1(html).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 3) if r.page_id in (1, 2, None) else ("response", None)) or r.page_id is None
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_packing_keeps_all_and_breaks_no_rule(spark, docs):
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 2000))
    rows = packing.pack(many, capacity=64, shard=100).collect()
    texts = {r.doc_id: (r.text, r.source) for r in many.collect()}
    tokens = collections.Counter()
    bins = collections.defaultdict(list)
    for r in rows:
        tokens[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
    count = collections.Counter(r.doc_id for r in many.collect())
    for doc, n in tokens.items():
        assert n == count[doc] * (len(re.findall(rb"[^\x20\x09-\x0D]+", (texts[doc][0] or "").encode())) + 1)
    for held in bins.values():
        held.sort(key=lambda r: r.start)
        assert held[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(held, held[1:]))
        assert held[-1].start + held[-1].n_tokens <= 64
        if len(held) > 1:
            sources = collections.Counter(s for r in held if (s := texts[r.doc_id][1]))
            copies = collections.Counter(" ".join(lower(t).decode().split()) for r in held if (t := texts[r.doc_id][0]) is not None)
            assert max(sources.values(), default=0) <= 2 and max(copies.values(), default=0) <= 1


def test_counterfactuals_clear_group_names(spark):
    toxic = [f"{random.choice(['scum', 'idiot'])} {random.choice(['muslims', 'muslims', words(1)])} {words(8)}" for _ in range(150)]
    clean = [words(10) for _ in range(300)] + [f"christians {words(8)}" for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(toxic + clean)] + [(900, None), (901, ""), (None, "scum")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(480)], "doc_id long, toxic int")
    fair, plain = toxicity.fit(df, labels, penalty=50.0), toxicity.fit(df, labels, penalty=0.0)
    import pyarrow as pa

    probe = pa.array(["muslims " + words(6), "scum " + words(6), "", None])
    a, b = fair.scores(probe), plain.scores(probe)
    assert a[0] < 0.3 and a[0] < b[0] and a[1] > 0.5 and a[2] == a[3]
    assert toxicity.report(df, fair, F.lit(False)).count() == len(rows)
    assert toxicity.accepted(df, fair).columns == df.columns
    assert toxicity.fit(df, labels.limit(0)).scores(probe).max() < 0.01


def test_languages(spark):
    stems = {"aa": ["kor", "tam", "vek"], "bb": ["üli", "éso", "ñan"]}
    rows = [(i, " ".join(random.choice(stems[k]) + random.choice("xyz") for _ in range(random.randint(5, 90))), k) for i, k in enumerate(["aa", "bb"] * 60)]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 34 !", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in langid.report(df, F.col("doc_id") % 3 == 0).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert sum(got[i].lang_pred == k for i, _, k in rows[:120]) >= 118
    assert langid.fit(df.limit(0)).languages == []


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert ngram_join.near_duplicates(none).count() == 0
    assert suffix_dedup.report(none).count() == 0
    assert packing.pack(none).count() == 0
    assert lm.report(none, F.lit(False)).count() == 0
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(none, benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(docs, benchmark).collect())
