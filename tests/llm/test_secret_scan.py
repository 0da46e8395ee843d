"""The secret scan against Python's regular expressions and sets of owners."""

import collections
import hashlib
import random
import re

from textloom.llm import secret_scan

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [(ASSIGN, 2, 8, re.I | re.A), ("AKIA[A-Z0-9]+", 0, 16, 0), ("[0-9a-f]+", 0, 32, 0)]
NAMES = ["assign", "access", "hex", "token"]
DOCS = "doc_id long, text string, source string, row long, kind string, hash string"


def looks(v):
    return 16 <= len(v) <= 128 and re.search("[0-9]", v) and re.search("[A-Za-z]", v) and len(set(v)) >= 8


def by_hand(rows, max_owners=1, max_repositories=10):
    found = []
    for row, (doc_id, text, source) in enumerate(rows):
        t = text or ""
        base = [(m.start(), k, m.end(), m.group(g)) for k, (p, g, least, f) in enumerate(BASE) for m in re.finditer(p, t, f) if len(m.group(g)) >= least]
        tokens = [(m.start(), 3, m.end(), m.group()) for m in re.finditer("[A-Za-z0-9_-]+", t) if looks(m.group())]
        tokens = [x for x in tokens if not any(b[0] < x[2] and x[0] < b[2] for b in base)]
        found += [(row, doc_id, source or "", *x) for x in base + tokens]
    owners, homes = collections.defaultdict(set), collections.defaultdict(set)
    for _, doc_id, source, *_, value in found:
        owners[value].add(source)
        homes[value].add("" if doc_id is None else str(doc_id))
    owned = {v: len(owners[v]) <= max_owners and len(homes[v]) <= max_repositories for v in owners}
    out = []
    for row, (doc_id, _, _) in enumerate(rows):
        mine = sorted((a, k, b, v) for r, _, _, a, k, b, v in found if r == row and (k < 3 or owned[v]))
        n = collections.Counter(k for _, k, _, _ in mine)
        text = [",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b, _ in mine if k < limit) for limit in (3, 4)]
        out.append((doc_id, n[0], n[1], n[2], hashlib.sha256(text[0].encode()).hexdigest(), text[1], len(mine), sum(owned[v] for *_, v in mine)))
    return out


def scanned(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "k", "h") for r in rows], DOCS)
    return [tuple(r) for r in secret_scan.report(docs, **options).collect()]


def key(row):
    return tuple((x is not None, x) for x in row)


def test_equals_regular_expressions(spark):
    rng = random.Random(9)
    parts = [
        "password", "Passwd", "SECRET", "token", "api_key", "apikey", "API__KEY", ":", "=", " ", "'", '"', "\n", "é", "語", "\U0001f600",
        "abcdefgh", "12345678", "short", "+/_.=-", "AKIA", "AKIAABCDEFGHIJKL", "AKIAABC", "0123456789abcdef" * 2, "deadbeef" * 4, "dead",
        "sk_live_9f8e7d6c5b4a", "zQ1w2E3r4T5y6U7i8O", "ſecret=abcdefgh1", "toKen=abcdefgh1", "secret=token: abcdefghij",
    ]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))), rng.choice(["a", "b", "c", None])) for i in range(400)]
    rows += [(1000 + i, "see token = AbCdEfGh12345678", f"s{i}") for i in range(30)] + [(1000, "password=only-here-1", "s0")]
    rows += [(None, "password: 12345678a", "x"), (7, None, "x"), (7, "", None), (8, parts[-5], "only"), (8, parts[-5], "only")]
    want, got = by_hand(rows), scanned(spark, rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any("token:" in r[5] for r in got) and any(r[6] > r[7] for r in got)


def test_copied_examples_and_own_credentials(spark):
    rows = [(i, "key zQ1w2E3r4T5y6U7i8O", f"o{i % 5}") for i in range(40)] + [(99, "key pK8s7D6f5G4h3J2k1L", "o1")]
    got = {r[0]: r for r in scanned(spark, rows)}
    assert got[99][5] == "token:4:22" and got[99][7] == 1
    assert all(got[i][5] == "" for i in range(40))
    assert all(r[5] for r in scanned(spark, rows, max_owners=5, max_repositories=40))
    assert {r[0] for r in scanned(spark, rows[::5], max_repositories=8) if r[5]} == {r[0] for r in rows[::5]}


def test_no_python_on_the_path(spark):
    docs = spark.createDataFrame([(1, "password=abcdefgh1", "s")], "doc_id long, text string, source string")
    plan = secret_scan.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_empty_table_and_very_long_text(spark):
    assert scanned(spark, []) == []
    text = "no secret here " * 100_000 + "password=abcdefgh1 " * 3000
    (row,) = scanned(spark, [(1, text, "s")])
    assert row[1] == row[6] == 3000 and row[5].startswith("assign:1500000:1500018,")
