"""The filter audit against a simulation of every order."""

import itertools
import random

import pytest

from textloom.llm import filter_audit

DOCS = "doc_id long, text string, source string, n string, mask string, digest string, part string"


def simulate(rows, labels):
    """Apply the filters one after the other, for every part and order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = [("" if t is None else t, d, "" if s is None else s) for d, t, s in rows]
    fails = []
    for t, d, s in texts:
        w = [x for x in "".join(" " if c in " \t\n\v\f\r" else c for c in t).split(" ") if x]
        caps = sum("A" <= c <= "Z" for c in t)
        copy = d is not None and any(u == t and e is not None and e < d for u, e, _ in texts)
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * caps > 2 * len(t)}
        fails.append((s, d, {k for k, v in {**bad, "D": any(c in "#$%&*|" for c in t), "E": copy}.items() if v}))
    out = {}
    for part in {s for s, _, _ in fails}:
        mine = [(d, f) for s, d, f in fails if s == part]
        removed_of = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [d for d, f in left if c in f]
                left = [(d, f) for d, f in left if c not in f]
                removed_of[c] += len(gone)
                before = sum(c in f and bool(f & set(order[: step - 1])) for _, f in mine)
                out[part, "".join(order), step] = [
                    len(left), len(gone), before, sum(f == {c} for _, f in mine),
                    sum(d in good for d in gone), sum(d in toxic for d in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(removed_of[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, s, "x", "y", "z", "w") for d, t, s in rows], DOCS)
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    collected = found.collect()
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in collected}, collected


def test_equals_simulation(spark):
    rng = random.Random(3)
    many = " ".join(f"w{i}" for i in range(250))
    texts = [many, many + " $", many.upper(), "A b", "x " * 300, "x " * 300 + "#", "", None, "é ü", many + " 1"]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(120)]
    rows += [(5, texts[0], "a"), (5, texts[0], "b"), (7, texts[1], "a"), (None, texts[0], "a"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1)]
    got, collected = audited(spark, rows, labels)
    assert got == simulate(rows, labels)
    assert len(collected) == len(got) == 3 * 600
    for part, order in [("a", "ABCDE"), ("b", "EDCBA"), ("", "CADEB")]:
        steps = sorted((r for r in collected if (r.part, r.filter_order) == (part, order)), key=lambda r: r.step)
        assert steps[-1].kept + sum(r.removed for r in steps) == steps[0].n_docs


def test_shapley_values_share_what_all_remove(spark):
    rows = [(i, t, "a") for i, t in enumerate(["short", "short", "A $", "x " * 300])]
    _, collected = audited(spark, rows, [(0, 1, 1)])
    one = [r for r in collected if r.filter_order == "ABCDE"]
    assert sum(r.shapley for r in one) == 120 * sum(r.removed for r in one) == 120 * 4
    assert {r.filter: r.shapley for r in one} == {"A": 120 + 60 + 40, "B": 120, "C": 40, "D": 40, "E": 60}


def test_empty_tables(spark):
    assert audited(spark, [], [])[1] == []
    got, _ = audited(spark, [(1, None, None)], [])
    assert {k[0] for k in got} == {""} and got["", "ABCDE", 1][:2] == (0, 1)


def test_a_text_of_most_rows_and_a_very_long_one(spark):
    rows = [(i, "copy", "hot") for i in range(3000)] + [(5000, "word " * 400_000, "hot")]
    got, _ = audited(spark, rows, [])
    assert got["hot", "EABCD", 1][:2] == (2, 2999)
    assert got["hot", "BACDE", 1][1] == 1


@pytest.mark.parametrize("n", [1, 3])
def test_potentials_of_other_games(spark, n):
    """The potential's differences are Shapley values of any game, here by orders."""
    from pyspark.sql import functions as F

    rng = random.Random(n)
    worth = [0] + [rng.randint(0, 9) for _ in range((1 << n) - 1)]
    frame = spark.createDataFrame([(worth,)], "worth array<long>")
    p = frame.select(filter_audit.potentials(F.col("worth"), n).alias("p")).first().p
    for i in range(n):
        total = 0
        for order in itertools.permutations(range(n)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += worth[before | 1 << i] - worth[before]
        assert p[-1] - p[((1 << n) - 1) ^ (1 << i)] == total
