"""Queries for segmentation by a lattice. The SQL walks each stretch word by word, forwards and backwards."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.profile import tokens
from textloom.operators import lattice
from textloom.queries.registry import documents, query
from textloom.queries.text import MINE

LENGTHS = (1, 2, 3, 4)
ROUNDS, MIN_COUNT, MIN_EXPECTED = 2, 5, 3

SEEDS = f"""{MINE},
  linked AS (SELECT m.doc_id, m.pos, m.w, k.first IS NOT NULL AS f
             FROM (SELECT *, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS nw FROM mine_words) m
             LEFT JOIN mined k ON k.first = m.w AND k.second = m.nw),
  spread AS (SELECT w, f, lead(w, 1) OVER d AS w1, lead(w, 2) OVER d AS w2, lead(w, 3) OVER d AS w3,
               lead(f, 1) OVER d AS f1, lead(f, 2) OVER d AS f2 FROM linked WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
  seeds AS (
    SELECT w AS phrase, 1 AS n_words, CAST(n AS DOUBLE) AS expected FROM singles
    UNION ALL SELECT first || ' ' || second, 2, n_pair FROM mined
    UNION ALL SELECT w || ' ' || w1 || ' ' || w2, 3, count(*) FROM spread WHERE f AND f1 GROUP BY 1 HAVING count(*) >= {MIN_COUNT}
    UNION ALL SELECT w || ' ' || w1 || ' ' || w2 || ' ' || w3, 4, count(*) FROM spread WHERE f AND f1 AND f2
              GROUP BY 1 HAVING count(*) >= {MIN_COUNT}),
  ends AS MATERIALIZED (
    SELECT doc_id, pos, w AS g1, lag(w, 1) OVER d || ' ' || w AS g2, lag(w, 2) OVER d || ' ' || lag(w, 1) OVER d || ' ' || w AS g3,
      lag(w, 3) OVER d || ' ' || lag(w, 2) OVER d || ' ' || lag(w, 1) OVER d || ' ' || w AS g4
    FROM mine_words WINDOW d AS (PARTITION BY doc_id ORDER BY pos))"""


def _costs(name: str, expected: str) -> str:
    """CTE of pieces with costs."""
    share = "greatest(expected, 0.5) / sum(greatest(expected, 0.5)) OVER ()"
    return f"{name} AS MATERIALIZED (SELECT phrase, n_words, CAST(round(-1000 * ln({share})) AS BIGINT) AS cost FROM {expected})"


def _lattice(name: str, model: str) -> str:
    """CTE of the words of all texts: cost of the piece of each length that ends there, stretch, place and length of the stretch."""
    joins = " ".join(f"LEFT JOIN {model} m{n} ON m{n}.phrase = e.g{n}" for n in LENGTHS)
    costs = ", ".join(f"m{n}.cost AS c{n}" for n in LENGTHS)
    return f"""
  {name}_e AS (SELECT e.*, {costs} FROM ends e {joins}),
  {name}_b AS (SELECT *, coalesce(c2, c3, c4, lead(c3, 1) OVER d, lead(c4, 1) OVER d, lead(c4, 2) OVER d) IS NULL AS fresh
               FROM {name}_e WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
  {name}_s AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS st FROM {name}_b),
  {name} AS MATERIALIZED (SELECT *, row_number() OVER s AS t, count(*) OVER (PARTITION BY doc_id, st) AS size,
      lead(c2, 1) OVER s AS d2, lead(c3, 2) OVER s AS d3, lead(c4, 3) OVER s AS d4
    FROM {name}_s WINDOW s AS (PARTITION BY doc_id, st ORDER BY pos)),
  {name}_m AS MATERIALIZED (SELECT * FROM {name} WHERE size > 1)"""


def _log_sum(terms: list[str]) -> str:
    top = f"greatest({', '.join(terms)})"
    return f"{top} + ln({' + '.join(f'coalesce(exp({x} - {top}), 0)' for x in terms)})"


def _expected(name: str, lat: str, model: str) -> str:
    """CTE of the pieces' expected counts: forward sums a, backward sums b."""
    forward = _log_sum([f"(a{n} - c{n} / 1000.0)" for n in LENGTHS])
    backward = _log_sum(["(b1 - c1 / 1000.0)"] + [f"(b{n} - d{n} / 1000.0)" for n in LENGTHS[1:]])
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {{x}}{n}" for n in LENGTHS[1:])
    shares = " UNION ALL ".join(
        f"""SELECT l.g{n} AS phrase, exp(f.a1 - l.c{n} / 1000.0 + b.b1 - w.a1) AS share FROM {lat}_m l
            JOIN {name}_f f ON f.doc_id = l.doc_id AND f.st = l.st AND f.t = l.t - {n}
            JOIN {name}_f w ON w.doc_id = l.doc_id AND w.st = l.st AND w.t = l.size
            JOIN {name}_r b ON b.doc_id = l.doc_id AND b.st = l.st AND b.t = l.t WHERE l.c{n} IS NOT NULL"""
        for n in LENGTHS
    )
    return f"""
  {name}_f AS (
    SELECT DISTINCT doc_id, st, CAST(0 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS a1, {nulls.format(x='a')} FROM {lat}_m
    UNION ALL SELECT l.doc_id, l.st, l.t, {forward}, a1, a2, a3
    FROM {name}_f f JOIN {lat}_m l ON l.doc_id = f.doc_id AND l.st = f.st AND l.t = f.t + 1),
  {name}_r AS (
    SELECT DISTINCT doc_id, st, size AS t, CAST(0 AS DOUBLE) AS b1, {nulls.format(x='b')} FROM {lat}_m
    UNION ALL SELECT l.doc_id, l.st, l.t - 1, {backward}, b1, b2, b3
    FROM {name}_r r JOIN {lat}_m l ON l.doc_id = r.doc_id AND l.st = r.st AND l.t = r.t),
  {name}_n AS (SELECT phrase, round(sum(share), 6) AS expected FROM (
      SELECT g1 AS phrase, CAST(1 AS DOUBLE) AS share FROM {lat} WHERE size = 1 UNION ALL {shares}) GROUP BY phrase),
  {name} AS (SELECT m.phrase, m.n_words, coalesce(n.expected, 0) AS expected FROM {model} m LEFT JOIN {name}_n n ON n.phrase = m.phrase
             WHERE m.n_words = 1 OR n.expected >= {MIN_EXPECTED})"""


def _fitted() -> str:
    parts = [SEEDS, _costs("m0", "seeds")]
    for r in range(ROUNDS):
        parts += [_lattice(f"l{r}", f"m{r}"), _expected(f"x{r + 1}", f"l{r}", f"m{r}"), _costs(f"m{r + 1}", f"x{r + 1}")]
    return ",\n  ".join(parts)


@query("phrase_model", f"WITH RECURSIVE {_fitted()} SELECT phrase, n_words, cost FROM m{ROUNDS}")
def phrase_model(spark, sf_dir):
    return lattice.fit_phrases(documents(spark, sf_dir)).pieces.select("phrase", "n_words", "cost")


VALUES = [f"(b{n} + c{n})" for n in LENGTHS]
LEAST = f"least({', '.join(VALUES)})"


@query(
    "segment_words",
    f"""WITH RECURSIVE {_fitted()}, {_lattice('lv', f'm{ROUNDS}')},
  best AS (
    SELECT DISTINCT doc_id, st, CAST(0 AS BIGINT) AS t, CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS b1, CAST(NULL AS BIGINT) AS b2,
      CAST(NULL AS BIGINT) AS b3, CAST(NULL AS BIGINT) AS b4, 0 AS back FROM lv_m
    UNION ALL SELECT l.doc_id, l.st, l.t, l.size, {LEAST}, b1, b2, b3,
      CASE {LEAST} {' '.join(f'WHEN {v} THEN {n}' for n, v in reversed(list(zip(LENGTHS, VALUES))))} END
    FROM best b JOIN lv_m l ON l.doc_id = b.doc_id AND l.st = b.st AND l.t = b.t + 1),
  path AS (
    SELECT doc_id, st, t, back FROM best WHERE t > 0 AND t = size
    UNION ALL SELECT b.doc_id, b.st, b.t, b.back FROM path p JOIN best b ON b.doc_id = p.doc_id AND b.st = p.st AND b.t = p.t - p.back
    WHERE p.t > p.back),
  joined AS (SELECT l.doc_id, string_agg(CASE WHEN l.size = 1 OR p.t IS NOT NULL THEN ' ' ELSE '_' END || l.g1, '' ORDER BY l.pos) AS text
    FROM lv l LEFT JOIN path p ON p.doc_id = l.doc_id AND p.st = l.st AND p.t - p.back + 1 = l.t GROUP BY l.doc_id)
  SELECT d.doc_id, coalesce(substr(j.text, 2), '') AS text FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id""",
)
def segment_words(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = lattice.fit_phrases(docs)
    return model.segment(docs.select("doc_id", "text"), words=tokens(F.col("text")))
