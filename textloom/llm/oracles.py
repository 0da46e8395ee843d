"""SQL of the operators whose results SQL can state."""

from string import ascii_lowercase, ascii_uppercase

WARC = """
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN newest IS NULL THEN 'response' ELSE 'revisit' END AS record_type, newest AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html,
        CASE WHEN strlen(html) >= 1000 AND page_id < max(page_id) OVER (PARTITION BY html)
             THEN max(page_id) OVER (PARTITION BY html) END AS newest
      FROM pages)"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
  reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
  low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN low l ON e.vec_id = l.a"""


def _words(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


BENCHMARK = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
  windows AS (SELECT DISTINCT item, list_slice(w, s, s + 9) AS k
              FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
  sizes AS (SELECT DISTINCT len(k) AS n FROM windows),
  docs AS (SELECT doc_id, {_words('text')} AS w FROM documents),
  places AS (SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS k
             FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n)),
  hits AS (SELECT doc_id, s, n, item FROM places JOIN windows USING (k)),
  covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
  found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
  sha256(coalesce(f.ids, '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id"""


FILTERS = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  known AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
  failed AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
               + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) THEN 4 ELSE 0 END
               + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
               + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
             FROM texts LEFT JOIN known USING (doc_id)),
  masks AS (SELECT part, mask, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
  letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
  orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, a.b AS b1, b.b AS b2, c.b AS b3, d.b AS b4, e.b AS b5
             FROM letters a, letters b, letters c, letters d, letters e WHERE a.b | b.b | c.b | d.b | e.b = 31),
  steps AS (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step, unnest([b1, b2, b3, b4, b5]) AS bit,
              unnest([0, b1, b1 | b2, b1 | b2 | b3, b1 | b2 | b3 | b4]) AS before FROM orders),
  counted AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, sum(n) AS n_docs,
                sum(n * CAST(mask & (before | bit) = 0 AS INT)) AS kept,
                sum(n * CAST(mask & before = 0 AND mask & bit <> 0 AS INT)) AS removed,
                sum(n * CAST(mask & before <> 0 AND mask & bit <> 0 AS INT)) AS redundant,
                sum(n * CAST(mask = bit AS INT)) AS unique_fails,
                sum(n * CAST(good AND mask & before = 0 AND mask & bit <> 0 AS INT)) AS good_lost,
                sum(n * CAST(toxic AND mask & before = 0 AND mask & bit <> 0 AS INT)) AS toxic_lost
              FROM masks, steps GROUP BY ALL)
SELECT c.part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY c.part, filter) AS BIGINT) AS shapley,
  CAST(n_docs AS BIGINT) AS n_docs
FROM counted c"""

FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
             sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
  r AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
          CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS u, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS v FROM d),
  f AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR u >= 90 THEN 'plain'
               WHEN v < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
  p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""

# (kind, pattern, group of the value, least length); letters of words in either case.
_SECRETS = (
    ("assign", "(" + "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
     + r'''|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)''', 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("token", "[A-Za-z0-9_-]+", 0, 16),
)


def _matches(kind: int) -> str:
    _, pattern, group, least = _SECRETS[kind]
    looks = ""
    if kind == 3:
        looks = """AND length(value) <= 128 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                   AND len(list_distinct(string_split(value, ''))) >= 8"""
    return f"""
SELECT row, owner, repository, {kind} AS kind, stop - length(whole) AS start, stop, value FROM (
  SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY row ORDER BY i) AS stop FROM (
    SELECT row, owner, repository, unnest(gaps) AS gap, unnest(wholes) AS whole, unnest(vals) AS value, unnest(range(len(gaps))) AS i
    FROM (SELECT *, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS wholes,
            regexp_extract_all(t, '{pattern}', {group}) AS vals FROM texts))
  WHERE whole IS NOT NULL) WHERE length(value) >= {least} {looks}"""


SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
                 coalesce(CAST(doc_id AS VARCHAR), '') AS repository FROM documents),
  found AS ({" UNION ALL ".join(_matches(k) for k in range(4))}),
  free AS (SELECT * FROM found f WHERE kind < 3 OR NOT EXISTS
             (SELECT 1 FROM found b WHERE b.kind < 3 AND b.row = f.row AND b.start < f.stop AND f.start < b.stop)),
  judged AS (SELECT *, owners <= 1 AND repositories <= 10 AS owned FROM free JOIN
               (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT repository) AS repositories FROM free GROUP BY value)
             USING (value)),
  spans AS (SELECT row, kind, start, owned, ['assign', 'access', 'hex', 'token'][kind + 1] || ':' || CAST(start AS VARCHAR) || ':'
              || CAST(stop AS VARCHAR) AS span FROM judged WHERE kind < 3 OR owned),
  listed AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
               string_agg(span, ',' ORDER BY start, kind) AS spans, count(*) AS n_spans, count(*) FILTER (owned) AS n_owned
             FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_spans, 0) AS n_spans, coalesce(n_owned, 0) AS n_owned
FROM texts LEFT JOIN listed USING (row)"""
