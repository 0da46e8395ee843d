"""N-gram Jaccard join by MinHash banding.

Documents with equal shingle sets form one class; classes are hashed, banded and compared, copies never are.
Bands and rows follow from the wanted recall (``plan_bands``). What shares a band is compared on its full
shingle sets (``buckets.link``). Words are runs of letters, digits and characters beyond ASCII, A-Z lowered.

Defined results: null texts and texts without words have no shingles and link with nothing; a text of fewer
than ``size`` words is one shingle of all of them; rows without doc_id link with nothing and keep a null
component; rows that repeat a doc_id count as one node; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.buckets import link
from textloom.llm.common import stored
from textloom.llm.graph import components
from textloom.llm.words import ALNUM, PIECE, U, find_words, mix, pieces, seeded, shingle_sets

SIGNATURE = "doc_id long, th long, k1 long, k2 long, n int, keys array<long>"


def plan_bands(threshold: float, recall: float, max_hashes: int = 64) -> tuple[int, int]:
    """(bands, rows): the longest rows whose bands find a pair at the threshold with the wanted recall."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no bands reach this recall within max_hashes")


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Digest of the shingle set, number of shingles and a key for each band, of every document."""
    a, b = seeded(bands * rows, 1), seeded(bands * rows, 2)
    spread = seeded(rows, 3)

    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("th")
            for part in pieces(batch.column("text"), PIECE // 4):
                owner, shingles = shingle_sets(find_words(part, ALNUM), len(part), size)
                n = np.bincount(owner, minlength=len(part))
                full = n > 0
                at = (np.cumsum(n) - n)[full]
                keys = np.zeros((int(full.sum()), bands), U)
                digest = [np.zeros(len(part), U), np.zeros(len(part), U)]
                if full.any():
                    for k in range(bands):
                        total = np.full(len(keys), k, U)
                        for j in range(rows):
                            r = k * rows + j
                            total += np.minimum.reduceat(shingles * a[r] + b[r], at) * spread[j]
                        keys[:, k] = mix(total)
                    for d, seed in zip(digest, (U(0x51), U(0xA7))):
                        d[full] = np.add.reduceat(mix(shingles ^ mix(seed.reshape(1))[0]), at)
                ends = np.append(0, np.cumsum(np.where(full, bands, 0))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(part.first, len(part)),
                        hashes.slice(part.first, len(part)),
                        *(pa.array(d.view(np.int64), pa.int64(), mask=~full) for d in digest),
                        pa.array(n, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "th", "k1", "k2", "n", "keys"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return narrow.mapInArrow(run, SIGNATURE)


def jaccard(size: int, threshold: float):
    """compare() of texts by the Jaccard similarity of their full shingle sets."""

    def compare(texts: pa.Array):
        owners, hashes = [], []
        for part in pieces(texts):
            owner, shingles = shingle_sets(find_words(part, ALNUM), len(part), size)
            owners.append(owner + part.first)
            hashes.append(shingles)
        owner, shingles = np.concatenate(owners), np.concatenate(hashes)
        n = np.bincount(owner, minlength=len(texts))
        at = np.append(0, np.cumsum(n))

        def sets(rows):
            return [shingles[at[r] : at[r + 1]] for r in rows]

        def linked(i, j):
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            yes = low >= threshold * high
            p, q = i[yes], j[yes]
            if not len(p):
                return yes
            (left, pi), (right, qi) = np.unique(p, return_inverse=True), np.unique(q, return_inverse=True)
            if len(p) > 8 * (len(left) + len(right)):
                common = _common_counts(sets(left), sets(right))[pi, qi]
            else:
                common = np.array([_common(shingles[at[x] : at[x + 1]], shingles[at[y] : at[y + 1]]) for x, y in zip(p, q)])
            yes[yes] = common / (n[p] + n[q] - common) >= threshold
            return yes

        return linked

    return compare


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices of ``width`` columns."""
    columns = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)

    def places(group):
        row = np.repeat(np.arange(len(group)), [len(g) for g in group])
        flat = np.concatenate(group)
        at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
        ok = columns[at] == flat
        order = np.argsort(at[ok], kind="stable")
        return row[ok][order], at[ok][order]

    if not len(columns):
        return out
    (lr, lc), (rr, rc) = places(left), places(right)
    for begin in range(0, len(columns), width):
        block = []
        for rows, cols, n in ((lr, lc, len(left)), (rr, rc, len(right))):
            a, b = np.searchsorted(cols, [begin, begin + width])
            dense = np.zeros((n, min(width, len(columns) - begin)), np.float32)
            dense[rows[a:b], cols[a:b] - begin] = 1
            block.append(dense)
        out += block[0] @ block[1].T
    return out


def _judged(docs: DataFrame, size: int, threshold: float, recall: float, by_text: bool) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and one row for each class of equal shingle sets; both stored.

    Classes have (k1, k2, doc, th, node, component, n_links): doc and th name the smallest row of the class, component is
    the smallest node of all linked classes. A node is a doc_id, or with ``by_text`` the number of the class in the order
    of (doc, th), so that texts which share a doc_id stay apart.
    """
    bands, rows = plan_bands(threshold, recall)
    found = stored(signatures(docs, size, bands, rows), "signatures")
    grouped = found.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "th")).alias("rep"), F.count("*").alias("weight"),
        F.any_value("n").cast("long").alias("cost"), F.any_value("keys").alias("keys"),
    )
    named = grouped.select("k1", "k2", F.col("rep.doc_id").alias("doc"), F.col("rep.th").alias("th"), "weight", "cost", "keys")
    if by_text:
        named = named.orderBy("doc", "th")
    row = F.monotonically_increasing_id()
    classes = stored(named.select("*", row.alias("row"), (row if by_text else F.col("doc")).alias("node")), "classes")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("th"), F.col("text").alias("payload"))
    links = stored(link(classes, texts, ["doc", "th"], jaccard(size, threshold)), "links")
    groups = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    partners = links.groupBy("row").agg(F.sum("partners").alias("partners"))
    results = classes.drop("keys").join(partners, "row", "left").join(groups, "node", "left").select(
        "k1", "k2", "doc", "th", "node", F.coalesce("component", "node").alias("component"),
        (F.coalesce("partners", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    return found, stored(results, "classes")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """(doc_id, n_shingles, class_id, n_links, component_id, kept) of every row of ``docs``.

    class_id: smallest doc_id with the same shingle set. n_links: other rows whose similarity reaches the threshold,
    copies included. component_id: smallest doc_id that links lead to, where rows that repeat a doc_id are one node. kept:
    doc_id = component_id.
    """
    found, results = _judged(docs, size, threshold, recall, by_text=False)
    results = results.select("k1", "k2", F.col("doc").alias("class_id"), F.col("component").alias("component_id"), "n_links")
    joined = found.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles")).join(results, ["k1", "k2"], "left").select(
        "doc_id", "n_shingles",
        *(F.when(F.col("doc_id").isNotNull(), F.coalesce(c, "doc_id")).alias(c) for c in ("class_id", "component_id")),
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """``docs`` without the rows that repeat another one, with all columns.

    Of the rows that links and copies join, the one with the smallest (doc_id, hash of text) stays; of rows that agree in
    both, the one with the smallest columns. Rows without doc_id or without words are copies of nothing and all stay.
    """
    found, results = _judged(docs, size, threshold, recall, by_text=True)
    chosen = results.where("node = component").select(F.col("doc").alias("_doc"), F.col("th").alias("_th"))
    wordless = found.where("n = 0 and doc_id is not null").select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).distinct()
    keys = ["_doc", "_th"]
    keyed = docs.where("doc_id is not null").withColumns({"_doc": F.col("doc_id").cast("long"), "_th": F.xxhash64("text")})
    kept = keyed.join(chosen, keys, "left_semi")
    # Rows of one doc_id and text: few, if any; only they are brought together.
    rows = found.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).groupBy(*keys).agg(F.count("*").alias("n"))
    repeated = stored(rows.where("n > 1 and _doc is not null").select(*keys), "repeated")
    names = [f"`{c}`" for c in docs.columns]
    one = kept.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.min(F.struct(*names)).alias("_row")).select("_row.*")
    parts = [kept.join(repeated, keys, "left_anti").select(*names), one, keyed.join(wordless, keys, "left_semi").select(*names)]
    out = docs.where("doc_id is null")
    for part in parts:
        out = out.unionByName(part)
    return out
