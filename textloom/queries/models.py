"""Queries for classifiers, thresholds, evaluation and explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import ngrams
from textloom.operators import classifiers, evaluate, explain, linear, ranking
from textloom.operators.aggregates import score_stats as score_stats_of
from textloom.operators.lookup import attach_scores
from textloom.operators.passive_aggressive import PassiveAggressive
from textloom.plans import model_comparison as comparison
from textloom.queries.features import HASHED_SQL, IDF_SQL, LONG_TERMS
from textloom.queries.registry import (
    ALL_DOCS,
    CHAR_TERMS,
    CLASS_ROWS,
    CORPUS,
    WORD_TERMS,
    feature_corpus,
    query,
    split_of,
    split_sql,
    table,
    train_rows as train_of,
    vocabulary_sql,
)
from textloom.session import materialize

WORDS_12 = ngrams.word_analyzer(1, 2)
CHARS_35 = ngrams.char_analyzer(3, 5)


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def held_out(docs):
    return docs.filter(F.col("split") != "train")


# ---- SQL for the models: each CTE gives (model, doc_id, split, label, score) ----------------


def nb_params_sql(name: str, vocab: str) -> str:
    return f"""{name} AS (SELECT feature,
    ln((cf0 + 1.0::DOUBLE) / (sum(cf0) OVER () + count(*) OVER ())) AS log_prob_0,
    ln((cf1 + 1.0::DOUBLE) / (sum(cf1) OVER () + count(*) OVER ())) AS log_prob_1 FROM {vocab})"""


def bnb_params_sql(name: str, vocab: str) -> str:
    return f"""{name} AS (SELECT feature, ln(1 - p0) AS absent_0, ln(1 - p1) AS absent_1,
    ln(p0) - ln(1 - p0) AS delta_0, ln(p1) - ln(1 - p1) AS delta_1
    FROM (SELECT feature, (df0 + 1.0::DOUBLE) / (n0 + 2) AS p0, (df1 + 1.0::DOUBLE) / (n1 + 2) AS p1 FROM {vocab}, class_rows))"""


ROCCHIO_PARAMS = """
  idf AS (SELECT feature, ln((1.0 + n0 + n1) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM word_vocab, class_rows),
  raw AS (SELECT doc_id, split, label, feature, (1 + ln(tf)) * idf AS v FROM tc JOIN idf USING (feature)),
  unit AS (SELECT *, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS x FROM raw),
  means AS (SELECT feature, coalesce(sum(x) FILTER (WHERE label = 0), 0) / any_value(n0) AS m0,
      coalesce(sum(x) FILTER (WHERE label = 1), 0) / any_value(n1) AS m1
    FROM unit, class_rows WHERE split = 'train' GROUP BY feature),
  rocchio AS (SELECT feature, m0 / sqrt(sum(m0 * m0) OVER ()) AS centroid_0, m1 / sqrt(sum(m1 * m1) OVER ()) AS centroid_1 FROM means)"""

PRIOR = "(SELECT ln(n1 / CAST(n0 AS DOUBLE)) FROM class_rows)"


def count_scores_sql(name: str, params: str, terms: str = "tc") -> str:
    """Scores of a multinomial model; documents without known features keep the prior."""
    return f"""{name} AS (SELECT c.doc_id, c.split, c.label, {PRIOR} + coalesce(s, 0) AS score
    FROM corpus c LEFT JOIN (SELECT doc_id, sum(tf * (log_prob_1 - log_prob_0)) AS s
      FROM {terms} JOIN {params} USING (feature) GROUP BY doc_id) t ON c.doc_id = t.doc_id WHERE c.split <> 'train')"""


BNB_SCORES = f"""bnb_scores AS (SELECT c.doc_id, c.split, c.label,
    {PRIOR} + (SELECT sum(absent_1) - sum(absent_0) FROM bnb) + coalesce(s, 0) AS score
    FROM corpus c LEFT JOIN (SELECT doc_id, sum(delta_1 - delta_0) AS s FROM tc JOIN bnb USING (feature) GROUP BY doc_id) t
      ON c.doc_id = t.doc_id WHERE c.split <> 'train')"""

ROCCHIO_SCORES = """rocchio_scores AS (SELECT c.doc_id, c.split, c.label, coalesce(s, 0) AS score
    FROM corpus c LEFT JOIN (SELECT doc_id, sum(x * (centroid_1 - centroid_0)) AS s FROM unit JOIN rocchio USING (feature) GROUP BY doc_id) t
      ON c.doc_id = t.doc_id WHERE c.split <> 'train')"""

WORD_VOCAB = vocabulary_sql("word_vocab", 2, 60000)
BNB_VOCAB = "bnb_vocab AS (SELECT * FROM word_vocab WHERE idx < 40000)"
WORD_NB_SQL = f"{WORD_TERMS}, {CLASS_ROWS}, {WORD_VOCAB}, {nb_params_sql('nb', 'word_vocab')}"
BNB_SQL = f"{WORD_TERMS}, {CLASS_ROWS}, {WORD_VOCAB}, {BNB_VOCAB}, {bnb_params_sql('bnb', 'bnb_vocab')}"
ROCCHIO_SQL = f"{WORD_TERMS}, {CLASS_ROWS}, {WORD_VOCAB}, {ROCCHIO_PARAMS}"
NB_COLUMNS = "feature, round(log_prob_0, 6) AS log_prob_0, round(log_prob_1, 6) AS log_prob_1"


@query("mnb_fit_word", f"WITH {WORD_NB_SQL} SELECT {NB_COLUMNS} FROM nb")
def mnb_fit_word(spark, sf_dir):
    model = classifiers.MultinomialNB(WORDS_12, 2, 60000).fit(train_of(feature_corpus(spark, sf_dir)))
    return rounded(model.params.drop("w"), "log_prob_0", "log_prob_1")


@query(
    "mnb_fit_char",
    f"""WITH {CHAR_TERMS}, {CLASS_ROWS}, {vocabulary_sql('char_vocab', 3, 80000)}, {nb_params_sql('nb', 'char_vocab')}
        SELECT {NB_COLUMNS} FROM nb""",
)
def mnb_fit_char(spark, sf_dir):
    model = classifiers.MultinomialNB(CHARS_35, 3, 80000).fit(train_of(feature_corpus(spark, sf_dir)))
    return rounded(model.params.drop("w"), "log_prob_0", "log_prob_1")


@query("mnb_score", f"WITH {WORD_NB_SQL}, {count_scores_sql('s', 'nb')} SELECT doc_id, round(score, 6) AS score FROM s")
def mnb_score(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    model = classifiers.MultinomialNB(WORDS_12, 2, 60000).fit(train_of(docs))
    return rounded(model.score(held_out(docs)), "score")


@query(
    "bnb_fit",
    f"""WITH {BNB_SQL} SELECT feature, round(absent_0, 6) AS absent_0, round(absent_1, 6) AS absent_1,
        round(delta_0, 6) AS delta_0, round(delta_1, 6) AS delta_1 FROM bnb""",
)
def bnb_fit(spark, sf_dir):
    model = classifiers.BernoulliNB(WORDS_12, 2, 40000).fit(train_of(feature_corpus(spark, sf_dir)))
    return rounded(model.params.drop("w"), "absent_0", "absent_1", "delta_0", "delta_1")


@query("bnb_score", f"WITH {BNB_SQL}, {BNB_SCORES} SELECT doc_id, round(score, 6) AS score FROM bnb_scores")
def bnb_score(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    model = classifiers.BernoulliNB(WORDS_12, 2, 40000).fit(train_of(docs))
    return rounded(model.score(held_out(docs)), "score")


@query(
    "rocchio_fit",
    f"WITH {ROCCHIO_SQL} SELECT feature, round(centroid_0, 6) AS centroid_0, round(centroid_1, 6) AS centroid_1 FROM rocchio",
)
def rocchio_fit(spark, sf_dir):
    model = classifiers.Rocchio(WORDS_12, 2, 60000).fit(train_of(feature_corpus(spark, sf_dir)))
    return rounded(model.params.select("feature", "centroid_0", "centroid_1"), "centroid_0", "centroid_1")


@query("rocchio_score", f"WITH {ROCCHIO_SQL}, {ROCCHIO_SCORES} SELECT doc_id, round(score, 6) AS score FROM rocchio_scores")
def rocchio_score(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    model = classifiers.Rocchio(WORDS_12, 2, 60000).fit(train_of(docs))
    return rounded(model.score(held_out(docs)), "score")


@query(
    "attach_scores",
    f"""WITH {ROCCHIO_SQL}, {ROCCHIO_SCORES} SELECT c.doc_id, c.lang, c.label, round(s.score, 6) AS score
        FROM corpus c JOIN rocchio_scores s USING (doc_id)""",
)
def attached_scores(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    scores = classifiers.Rocchio(WORDS_12, 2, 60000).fit(train_of(docs)).score(held_out(docs))
    return rounded(attach_scores(held_out(docs).select("doc_id", "lang", "label"), scores), "score")


# The same classifier in the dual: beta holds a factor for each train document, a step changes one of them, and margins are
# products with a row of the Gram matrix. Needs WITH RECURSIVE.
PA_SQL = f"""{HASHED_SQL},
  unit AS (SELECT b.doc_id, split, label, bucket, n / norm AS v FROM buckets b JOIN norms USING (doc_id) JOIN corpus USING (doc_id)),
  learners AS MATERIALIZED (SELECT doc_id, CASE label WHEN 1 THEN 1 ELSE -1 END AS y, row_number() OVER (ORDER BY doc_id) AS i,
      CASE label WHEN 1 THEN (n0 + n1) / (2.0::DOUBLE * n1) ELSE (n0 + n1) / (2.0::DOUBLE * n0) END AS weight
    FROM corpus, class_rows WHERE split = 'train'),
  learnt AS MATERIALIZED (SELECT l.i, u.bucket, u.v FROM learners l JOIN unit u USING (doc_id)),
  gram AS (SELECT a.i, b.i AS j, sum(a.v * b.v) AS k FROM learnt a JOIN learnt b USING (bucket) GROUP BY ALL),
  gram_rows AS MATERIALIZED (SELECT p.i, any_value(p.y) AS y, any_value(p.weight) AS weight, list(coalesce(k, 0) ORDER BY q.i) AS ks
    FROM learners p CROSS JOIN learners q LEFT JOIN gram g ON g.i = p.i AND g.j = q.i GROUP BY p.i),
  turns AS MATERIALIZED (SELECT i, row_number() OVER (ORDER BY epoch, md5('42:' || epoch || ':' || doc_id), doc_id) AS turn
    FROM learners, range(1, 5) AS e(epoch)),
  walk AS (
    SELECT CAST(0 AS BIGINT) AS turn, list_transform(range((SELECT count(*) FROM learners)), lambda i: 0.0::DOUBLE) AS beta
    UNION ALL
    SELECT t.turn, list_concat(list_concat(w.beta[:t.i - 1], [w.beta[t.i] + g.y * g.weight
        * greatest(0, 1 - g.y * list_dot_product(w.beta, g.ks)) / (CASE WHEN g.ks[t.i] > 0 THEN g.ks[t.i] ELSE 1 END + 1)]), w.beta[t.i + 1:])
    FROM walk w JOIN turns t ON t.turn = w.turn + 1 JOIN gram_rows g ON g.i = t.i),
  final AS (SELECT unnest(beta) AS b, generate_subscripts(beta, 1) AS i FROM walk WHERE turn = (SELECT count(*) FROM turns)),
  pa AS (SELECT bucket, sum(b * v) AS w FROM learnt JOIN final USING (i) GROUP BY bucket)"""
PA_SCORES = """pa_scores AS (SELECT c.doc_id, c.split, c.label, coalesce(s, 0) AS score FROM corpus c LEFT JOIN
    (SELECT doc_id, sum(v * w) AS s FROM unit JOIN pa USING (bucket) GROUP BY doc_id) t USING (doc_id) WHERE c.split <> 'train')"""


@query("pa_fit", f"WITH RECURSIVE {WORD_TERMS}, {CLASS_ROWS}, {PA_SQL} SELECT bucket, round(w, 6) AS w FROM pa WHERE abs(w) > 1e-9")
def pa_fit(spark, sf_dir):
    weights = PassiveAggressive(WORDS_12).fit(train_of(feature_corpus(spark, sf_dir))).weights
    return rounded(weights.filter(F.abs("w") > 1e-9), "w")


@query(
    "pa_score", f"WITH RECURSIVE {WORD_TERMS}, {CLASS_ROWS}, {PA_SQL}, {PA_SCORES} SELECT doc_id, round(score, 6) AS score FROM pa_scores"
)
def pa_score(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    model = PassiveAggressive(WORDS_12).fit(train_of(docs))
    return rounded(model.score(held_out(docs)), "score")


# Logistic regression in the dual: alpha holds a factor for each train document, margins are products with the rows of the
# Gram matrix. Accelerated gradient steps of length 1/L; L bounds the curvature, 1/4 is a safe lower bound of it. z is the place ahead.
LOGREG_STEPS = 1200
LOGREG_SQL = f"""{LONG_TERMS.replace(ALL_DOCS, CORPUS)}, {CLASS_ROWS},
  vocab AS (SELECT feature, count(*) AS df, sum(tf) AS cf FROM tc WHERE split = 'train' GROUP BY feature ORDER BY cf DESC, feature LIMIT 15000),
  raw AS (SELECT doc_id, split, label, feature, tf * ({IDF_SQL}) AS v FROM tc JOIN vocab USING (feature)),
  unit AS MATERIALIZED (SELECT *, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS u FROM raw),
  learners AS MATERIALIZED (SELECT doc_id, label AS t, row_number() OVER (ORDER BY doc_id) AS i,
      (n0 + n1) / (2.0::DOUBLE * CASE label WHEN 1 THEN n1 ELSE n0 END) AS weight FROM corpus, class_rows WHERE split = 'train'),
  learnt AS MATERIALIZED (SELECT l.i, feature, u FROM learners l JOIN unit USING (doc_id)),
  gram AS (SELECT a.i, b.i AS j, sum(a.u * b.u) AS k FROM learnt a JOIN learnt b USING (feature) GROUP BY ALL),
  gram_rows AS (SELECT p.i, any_value(p.t) AS t, any_value(p.weight) AS weight, list(coalesce(k, 0) ORDER BY q.i) AS ks
    FROM learners p CROSS JOIN learners q LEFT JOIN gram g ON g.i = p.i AND g.j = q.i GROUP BY p.i),
  known AS MATERIALIZED (SELECT list(ks ORDER BY i) AS kss, list(t ORDER BY i) AS ts, list(weight ORDER BY i) AS ws,
      1 + max(list_sum(ks) + len(ks)) * max(weight) / 4 AS l FROM gram_rows),
  walk AS (
    SELECT 0 AS s, o AS alpha, o AS before, 0.0::DOUBLE AS b, 0.0::DOUBLE AS b_before
    FROM (SELECT list_transform(ts, lambda t: 0.0::DOUBLE) AS o FROM known)
    UNION ALL
    SELECT s + 1, list_transform(list_zip(z, g), lambda e: e[1] - (e[1] + e[2]) / l), alpha, zb - list_sum(g) / l, b
    FROM (SELECT *, list_transform(list_zip(kss, ts, ws), lambda e: e[3] * (1 / (1 + exp(-(list_dot_product(e[1], z) + zb))) - e[2])) AS g
      FROM (SELECT *, list_transform(list_zip(alpha, before), lambda e: e[1] + ahead * (e[1] - e[2])) AS z, b + ahead * (b - b_before) AS zb
        FROM (SELECT *, (sqrt(4 * l) - 1) / (sqrt(4 * l) + 1) AS ahead FROM walk, known WHERE s < {LOGREG_STEPS})))),
  solved AS MATERIALIZED (SELECT alpha, b FROM walk WHERE s = {LOGREG_STEPS}),
  duals AS (SELECT unnest(alpha) AS a, generate_subscripts(alpha, 1) AS i FROM solved),
  logreg AS (SELECT feature, sum(a * u) AS w FROM learnt JOIN duals USING (i) GROUP BY feature),
  logreg_scores AS (SELECT c.doc_id, c.split, c.label, coalesce(m, 0) + b AS score FROM solved, corpus c LEFT JOIN
    (SELECT doc_id, sum(u * w) AS m FROM unit JOIN logreg USING (feature) GROUP BY doc_id) q USING (doc_id) WHERE c.split <> 'train')"""


def logreg_held_out(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    return linear.LogisticRegression().fit(train_of(docs)).score(held_out(docs), comparison.KEYS)


@query(
    "logreg_fit",
    f"""WITH RECURSIVE {LOGREG_SQL} SELECT feature, round(w, 4) AS w FROM logreg
        UNION ALL SELECT '' AS feature, round(b, 4) AS w FROM solved""",
)
def logreg_fit(spark, sf_dir):
    """Weights by feature; the intercept has the empty feature."""
    model = linear.LogisticRegression().fit(train_of(feature_corpus(spark, sf_dir)))
    intercept = spark.range(1).select(F.lit("").alias("feature"), F.lit(model.bias).alias("w"))
    return model.params.select("feature", "w").unionByName(intercept).withColumn("w", F.round("w", 4))


@query(
    "logreg_predict",
    f"WITH RECURSIVE {LOGREG_SQL} SELECT doc_id, label, CAST(score > 0 AS INTEGER) AS predicted FROM logreg_scores",
)
def logreg_predict(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir).select("doc_id", "text", "label", "split")
    return linear.logistic_regression(train_of(docs), held_out(docs)).select("doc_id", "label", "predicted")


@query("logreg_score", f"WITH RECURSIVE {LOGREG_SQL} SELECT doc_id, round(score, 6) AS score FROM logreg_scores")
def logreg_score(spark, sf_dir):
    return rounded(logreg_held_out(spark, sf_dir).select("doc_id", "score"), "score")


def _plus(a: str, b: str, factor: str = "1.0::DOUBLE") -> str:
    return f"list_transform(list_zip({a}, {b}), lambda z: z[1] + {factor} * z[2])"


# Squared hinge by Newton steps, each solved by CG_STEPS conjugate gradients over lists: xs are the standardised train vectors
# with a 1 at the end, columns the same by dimension. q is the place or direction that both products of a step are taken of,
# t the gradient or the turned direction.
CG_STEPS, NEWTON_STEPS = 90, 14
SVC_SQL = f"""
  vecs AS (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS label, {split_sql('vec_id')} AS split, CAST(embedding AS DOUBLE[]) AS e
           FROM embeddings WHERE label IS NOT NULL),
  dims AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM (SELECT unnest(e) AS x, generate_subscripts(e, 1) AS dim
           FROM vecs WHERE split = 'train') GROUP BY dim),
  flat AS (SELECT vec_id, label, split, f.dim, (x - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END AS x
           FROM (SELECT vec_id, label, split, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM vecs) f JOIN dims USING (dim)
           UNION ALL SELECT vec_id, label, split, 1000000, 1.0 FROM vecs),
  points AS (SELECT vec_id, label, split, list(x ORDER BY dim) AS x FROM flat GROUP BY ALL),
  sizes AS (SELECT count(*) AS n, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM points WHERE split = 'train'),
  learned AS MATERIALIZED (SELECT list(x ORDER BY vec_id) AS xs, list(2.0::DOUBLE * label - 1 ORDER BY vec_id) AS ys,
      list(n / (2.0::DOUBLE * CASE label WHEN 1 THEN n1 ELSE n0 END) ORDER BY vec_id) AS cs FROM points, sizes WHERE split = 'train'),
  columns AS MATERIALIZED (SELECT list(c ORDER BY dim) AS xt FROM (SELECT dim, list(x ORDER BY vec_id) AS c FROM flat WHERE split = 'train' GROUP BY dim)),
  walk AS (
    SELECT 0 AS s, o AS w, o AS d, o AS r, o AS p, list_transform(ys, lambda y: 0.0::DOUBLE) AS act
    FROM (SELECT list_transform(xs[1], lambda v: 0.0::DOUBLE) AS o, ys FROM learned)
    UNION ALL
    SELECT s + 1, CASE WHEN fresh THEN q ELSE w END,
      CASE WHEN fresh THEN list_transform(d, lambda v: 0.0::DOUBLE) ELSE {_plus('d', 'p', 'a')} END,
      r2, CASE WHEN fresh THEN r2 ELSE {_plus('r2', 'p', 'CASE WHEN rr > 0 THEN list_dot_product(r2, r2) / rr ELSE 0 END')} END,
      CASE WHEN fresh THEN list_transform(list_zip(ys, xq, cs), lambda z: CASE WHEN z[1] * z[2] < 1 THEN 2 * z[3] ELSE 0 END) ELSE act END
    FROM (SELECT *, CASE WHEN fresh THEN list_transform(t, lambda v: -v) ELSE {_plus('r', 't', '-a')} END AS r2
      FROM (SELECT *, CASE WHEN NOT fresh AND rr > 1e-28 THEN rr / list_dot_product(p, t) ELSE 0 END AS a
        FROM (SELECT *, list_dot_product(r, r) AS rr, {_plus('q', 'list_transform(xt, lambda c: list_dot_product(c, u))')} AS t
          FROM (SELECT *, CASE WHEN fresh
              THEN list_transform(list_zip(ys, xq, cs), lambda z: -2 * z[3] * z[1] * greatest(0, 1 - z[1] * z[2]))
              ELSE list_transform(list_zip(act, xq), lambda z: z[1] * z[2]) END AS u
            FROM (SELECT *, list_transform(xs, lambda x: list_dot_product(x, q)) AS xq
              FROM (SELECT *, s % {CG_STEPS} = 0 AS fresh, CASE WHEN s % {CG_STEPS} = 0 THEN {_plus('w', 'd')} ELSE p END AS q
                FROM walk, learned, columns WHERE s < {CG_STEPS * NEWTON_STEPS} + 1))))))),
  svc AS (SELECT w FROM walk WHERE s = {CG_STEPS * NEWTON_STEPS} + 1)"""


def vector_rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("label"), split_of(F.col("vec_id")).alias("split")
    ).filter("label is not null")


@query(
    "svc_fit",
    f"""WITH RECURSIVE {SVC_SQL} SELECT CAST(CASE WHEN i = len(w) THEN -1 ELSE i - 1 END AS INTEGER) AS dim, round(v, 5) AS w
        FROM (SELECT w, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM svc)""",
)
def svc_fit(spark, sf_dir):
    """Weights by dimension; the intercept is dimension -1."""
    model = linear.SupportVectors.fit(train_of(vector_rows(spark, sf_dir))).model
    intercept = spark.range(1).select(F.lit(-1).alias("dim"), F.lit(model.intercept).alias("w"))
    return model.weights.unionByName(intercept).withColumn("w", F.round("w", 5))


@query(
    "svc_predict",
    f"""WITH RECURSIVE {SVC_SQL} SELECT vec_id, label, CAST(list_dot_product(x, w) > 0 AS INTEGER) AS predicted
        FROM points, svc WHERE split <> 'train'""",
)
def svc_predict(spark, sf_dir):
    vectors = vector_rows(spark, sf_dir)
    return linear.linear_svm(train_of(vectors), held_out(vectors)).select("vec_id", "label", "predicted")


# ---- thresholds and metrics ------------------------------------------------------------------


def f1_sql(tp: str, fp: str, fn: str) -> str:
    return f"CASE WHEN 2 * ({tp}) + ({fp}) + ({fn}) = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * ({tp}) / (2 * ({tp}) + ({fp}) + ({fn})) END"


def tune_sql(scores: str) -> str:
    """CTE ``tuned(model, threshold, valid_macro_f1)`` by trying every candidate on every score."""
    macro = f"({f1_sql('tp', 'fp', 'fn')} + {f1_sql('tn', 'fn', 'fp')}) / 2"
    return f"""valids AS (SELECT model, label, round(score, 6) AS score FROM {scores} WHERE split = 'valid'),
  uniq AS (SELECT model, score, row_number() OVER (PARTITION BY model ORDER BY score) AS r,
             count(*) OVER (PARTITION BY model) AS n FROM (SELECT DISTINCT model, score FROM valids)),
  cands AS (SELECT model, score AS threshold FROM uniq
            WHERE n <= 250 OR (r - 1) % greatest(1, n // 250) = 0 OR r = n),
  cells AS (SELECT c.model, threshold,
      count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
      count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn, count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn
    FROM cands c JOIN valids v ON c.model = v.model GROUP BY ALL),
  tuned AS (SELECT model, threshold, {macro} AS valid_macro_f1 FROM cells
            QUALIFY row_number() OVER (PARTITION BY model ORDER BY {macro} DESC, threshold) = 1)"""


METRIC_COLUMNS = f"""CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
    ({f1_sql('tp', 'fp', 'fn')} + {f1_sql('tn', 'fn', 'fp')}) / 2 AS macro_f1,
    {f1_sql('tn', 'fn', 'fp')} AS f1_clean, {f1_sql('tp', 'fp', 'fn')} AS f1_toxic"""
CELLS = """count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE label = 0 AND predicted = 0) AS tn,
    count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp, count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn"""
NB_MODEL = f"WITH {WORD_NB_SQL}, {count_scores_sql('nb_scores', 'nb')}, long AS (SELECT 'nb' AS model, * FROM nb_scores)"
PREDICTED = """predicted AS (SELECT l.*, CAST(round(score, 6) >= threshold AS INTEGER) AS predicted
    FROM long l JOIN tuned USING (model) WHERE split = 'test')"""


def nb_scores(spark, sf_dir):
    """Word naive Bayes scores of valid and test, under the model name 'nb'."""
    docs = feature_corpus(spark, sf_dir)
    model = classifiers.MultinomialNB(WORDS_12, 2, 60000).fit(train_of(docs))
    scores = model.score(held_out(docs), comparison.KEYS).withColumn("model", F.lit("nb"))
    return materialize(scores, "scores")


def nb_predictions(spark, sf_dir):
    scores = nb_scores(spark, sf_dir)
    tuned = evaluate.tune_threshold(scores.filter(F.col("split") == "valid"))
    return evaluate.predict(scores.filter(F.col("split") == "test"), tuned)


@query(
    "tune_threshold",
    f"{NB_MODEL}, {tune_sql('long')} SELECT model, threshold, round(valid_macro_f1, 6) AS valid_macro_f1 FROM tuned",
)
def tune_threshold(spark, sf_dir):
    valid = nb_scores(spark, sf_dir).filter(F.col("split") == "valid")
    return rounded(evaluate.tune_threshold(valid), "valid_macro_f1")


@query(
    "tune_threshold_grid",
    f"""{NB_MODEL}, probs AS (SELECT label, round(1 / (1 + exp(-score / 100)), 6) AS p FROM long WHERE split = 'valid'),
  grid AS (SELECT t.i / 100.0::DOUBLE AS threshold FROM range(10, 91) AS t(i)),
  cells AS (SELECT threshold, count(*) FILTER (WHERE label = 1 AND p >= threshold) AS tp, count(*) FILTER (WHERE label = 0 AND p >= threshold) AS fp,
      count(*) FILTER (WHERE label = 1 AND p < threshold) AS fn, count(*) FILTER (WHERE label = 0 AND p < threshold) AS tn
    FROM grid, probs GROUP BY threshold),
  tried AS (SELECT threshold, {METRIC_COLUMNS} FROM cells)
  SELECT threshold, round(macro_f1, 6) AS valid_macro_f1 FROM tried ORDER BY macro_f1 DESC, threshold LIMIT 1""",
)
def tune_threshold_grid(spark, sf_dir):
    valid = nb_scores(spark, sf_dir).filter(F.col("split") == "valid")
    probability = F.round(1 / (1 + F.exp(-F.col("score") / 100)), 6)
    return rounded(evaluate.tune_threshold_grid(valid.withColumn("score", probability)), "valid_macro_f1")


@query(
    "score_stats",
    f"""{NB_MODEL} SELECT split, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
        round(avg(score), 6) AS mean_score FROM long GROUP BY split""",
)
def score_stats(spark, sf_dir):
    return rounded(score_stats_of(nb_scores(spark, sf_dir), by=["split"]), "min_score", "max_score", "mean_score")


ROUNDED_METRICS = ", ".join(f"round({c}, 6) AS {c}" for c in ("accuracy", "macro_f1", "f1_clean", "f1_toxic"))


@query(
    "metrics",
    f"""{NB_MODEL}, {tune_sql('long')}, {PREDICTED}, counted AS (SELECT {CELLS} FROM predicted),
        m AS (SELECT tp, tn, fp, fn, {METRIC_COLUMNS} FROM counted) SELECT tp, tn, fp, fn, {ROUNDED_METRICS} FROM m""",
)
def metrics(spark, sf_dir):
    measured = evaluate.metrics(nb_predictions(spark, sf_dir))
    return rounded(measured, "accuracy", "macro_f1", "f1_clean", "f1_toxic")


@query(
    "logreg_metrics",
    f"""WITH RECURSIVE {LOGREG_SQL}, long AS (SELECT 'logreg' AS model, * FROM logreg_scores), {tune_sql('long')}, {PREDICTED},
        counted AS (SELECT {CELLS} FROM predicted), m AS (SELECT tp, tn, fp, fn, {METRIC_COLUMNS} FROM counted)
        SELECT 'logreg' AS model, tp, tn, fp, fn, {ROUNDED_METRICS}, threshold, round(valid_macro_f1, 6) AS valid_macro_f1,
          CAST(1 AS INTEGER) AS rank FROM m, tuned""",
)
def logreg_metrics(spark, sf_dir):
    scores = materialize(logreg_held_out(spark, sf_dir).withColumn("model", F.lit("logreg")), "scores")
    return rounded(evaluate.compare_models(scores), "accuracy", "macro_f1", "f1_clean", "f1_toxic", "valid_macro_f1")


@query(
    "confusion_samples",
    f"""{NB_MODEL}, {tune_sql('long')}, {PREDICTED},
  bucketed AS (SELECT doc_id, label, predicted,
      CASE WHEN label = 1 AND predicted = 1 THEN 'TP' WHEN label = 0 AND predicted = 0 THEN 'TN'
           WHEN label = 0 AND predicted = 1 THEN 'FP' ELSE 'FN' END AS bucket FROM predicted)
  SELECT doc_id, label, predicted, bucket, CAST(row_number() OVER (PARTITION BY bucket ORDER BY doc_id) AS INTEGER) AS position
  FROM bucketed QUALIFY position <= 3""",
)
def confusion_samples(spark, sf_dir):
    samples = ranking.confusion_samples(nb_predictions(spark, sf_dir))
    return samples.select("doc_id", "label", "predicted", "bucket", "position")


ALL_MODELS = f"""WITH {WORD_NB_SQL}, {BNB_VOCAB}, {bnb_params_sql('bnb', 'bnb_vocab')}, {ROCCHIO_PARAMS},
  {count_scores_sql('nb_scores', 'nb')}, {BNB_SCORES}, {ROCCHIO_SCORES}"""

# The character terms under their own names, so that both analyzers fit in one statement.
CHAR_CTES = CHAR_TERMS[CHAR_TERMS.index("chars AS"):]
CHAR_CTES = CHAR_CTES.replace("feats AS", "char_feats AS").replace("FROM feats", "FROM char_feats").replace("tc AS", "char_tc AS")
COMPARED = f"""{ALL_MODELS}, {CHAR_CTES},
  {vocabulary_sql('char_vocab', 3, 80000).replace('FROM tc', 'FROM char_tc')}, {nb_params_sql('char_nb', 'char_vocab')},
  {count_scores_sql('char_scores', 'char_nb', 'char_tc')},
  long AS (SELECT '{comparison.WORD_NB}' AS model, * FROM nb_scores UNION ALL SELECT '{comparison.BERNOULLI}', * FROM bnb_scores
    UNION ALL SELECT '{comparison.ROCCHIO}', * FROM rocchio_scores UNION ALL SELECT '{comparison.CHAR_NB}', * FROM char_scores),
  {tune_sql('long')}, {PREDICTED}, counted AS (SELECT model, {CELLS} FROM predicted GROUP BY model),
  measured AS (SELECT model, tp, tn, fp, fn, {METRIC_COLUMNS} FROM counted)"""


@query(
    "model_comparison",
    f"""{COMPARED} SELECT model, tp, tn, fp, fn, {ROUNDED_METRICS}, threshold, round(valid_macro_f1, 6) AS valid_macro_f1,
        CAST(row_number() OVER (ORDER BY macro_f1 DESC, model) AS INTEGER) AS rank FROM measured JOIN tuned USING (model)""",
)
def model_comparison(spark, sf_dir):
    compared = comparison.model_comparison(feature_corpus(spark, sf_dir))
    return rounded(compared, "accuracy", "macro_f1", "f1_clean", "f1_toxic", "valid_macro_f1")


# All five models; the hashed one keeps its own names for vectors that Rocchio has as well.
PA_APART = PA_SQL.replace("unit ", "pa_unit ")
ALL_COMPARED = (
    COMPARED.replace("WITH ", "WITH RECURSIVE ", 1)
    .replace("  long AS (", f"  {PA_APART}, {PA_SCORES.replace('FROM unit ', 'FROM pa_unit ')},\n  long AS (", 1)
    .replace("SELECT '{0}', * FROM rocchio_scores".format(comparison.ROCCHIO),
             f"SELECT '{comparison.ROCCHIO}', * FROM rocchio_scores UNION ALL SELECT '{comparison.HASHED_PA}', * FROM pa_scores", 1)
)


@query(
    "model_comparison_all",
    f"""{ALL_COMPARED} SELECT model, tp, tn, fp, fn, {ROUNDED_METRICS}, threshold, round(valid_macro_f1, 6) AS valid_macro_f1,
        CAST(row_number() OVER (ORDER BY macro_f1 DESC, model) AS INTEGER) AS rank FROM measured JOIN tuned USING (model)""",
)
def model_comparison_all(spark, sf_dir):
    compared = comparison.model_comparison(feature_corpus(spark, sf_dir), passive_aggressive=True)
    return rounded(compared, "accuracy", "macro_f1", "f1_clean", "f1_toxic", "valid_macro_f1")


@query(
    "model_ranking",
    f"""WITH {WORD_NB_SQL}, {BNB_VOCAB}, {bnb_params_sql('bnb', 'bnb_vocab')}, {ROCCHIO_PARAMS},
  {count_scores_sql('nb_scores', 'nb')}, {BNB_SCORES}, {ROCCHIO_SCORES},
  long AS (SELECT 'nb' AS model, * FROM nb_scores UNION ALL SELECT 'bernoulli', * FROM bnb_scores UNION ALL SELECT 'rocchio', * FROM rocchio_scores),
  predicted AS (SELECT model, label, CAST(round(score, 6) >= 0 AS INTEGER) AS predicted FROM long WHERE split = 'test'),
  counted AS (SELECT model, {CELLS} FROM predicted GROUP BY model), m AS (SELECT model, {METRIC_COLUMNS} FROM counted)
  SELECT model, {ROUNDED_METRICS}, CAST(row_number() OVER (ORDER BY macro_f1 DESC, model) AS INTEGER) AS rank FROM m""",
)
def model_ranking(spark, sf_dir):
    """Models at the untuned threshold 0, ranked by macro F1 on test."""
    docs = feature_corpus(spark, sf_dir)
    train = train_of(docs)
    fitted = comparison.fit_word_models(train, classifiers.class_counts(train))
    names = {comparison.WORD_NB: "nb", comparison.BERNOULLI: "bernoulli", comparison.ROCCHIO: "rocchio"}
    models = {names[name]: model for name, model in fitted.items()}
    test = docs.filter(F.col("split") == "test")
    scores = classifiers.score_together(models, test, comparison.KEYS)
    predicted = scores.withColumn("predicted", (F.round("score", 6) >= 0).cast("int"))
    ranked = ranking.rank_models(evaluate.metrics(predicted, ["model"])).drop("tp", "tn", "fp", "fn")
    return rounded(ranked, "accuracy", "macro_f1", "f1_clean", "f1_toxic")


@query(
    "token_attribution",
    f"""WITH {WORD_NB_SQL},
  tests AS (SELECT doc_id, w, CAST(pos - 1 AS INTEGER) AS pos FROM words WHERE split = 'test'),
  parts AS (SELECT doc_id, w, count(*) * coalesce(any_value(log_prob_1 - log_prob_0), 0) AS part
            FROM tests LEFT JOIN nb ON nb.feature = w GROUP BY doc_id, w),
  placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(part) DESC, w) AS place FROM parts)
  SELECT t.doc_id, t.pos, t.w AS token, round(CASE WHEN place <= 20 THEN part ELSE 0 END, 6) AS weight
  FROM tests t JOIN placed p ON t.doc_id = p.doc_id AND t.w = p.w""",
)
def token_attribution(spark, sf_dir):
    docs = feature_corpus(spark, sf_dir)
    model = classifiers.MultinomialNB(WORDS_12, 2, 60000).fit(train_of(docs))
    test = docs.filter(F.col("split") == "test")
    return rounded(explain.token_attribution(test, model), "weight")


@query("explain_perturb")
def explain_perturb(spark, sf_dir):
    """First three test documents of each confusion bucket, explained by perturbation."""
    docs = feature_corpus(spark, sf_dir)
    model = classifiers.MultinomialNB(WORDS_12, 2, 60000).fit(train_of(docs))
    scores = materialize(model.score(held_out(docs), comparison.KEYS).withColumn("model", F.lit("nb")), "scores")
    tuned = evaluate.tune_threshold(scores.filter(F.col("split") == "valid"))
    chosen = ranking.confusion_samples(evaluate.predict(scores.filter(F.col("split") == "test"), tuned))
    picked = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    explained = explain.explain_perturb(picked, lambda copies: model.score(copies, ("doc_id", "sample")))
    return rounded(explained, "weight")
