"""Conflict-constrained best-fit packing of documents into sequences of ``capacity`` tokens.

Documents longer than a sequence fill whole sequences of their own with all but their last piece. Rests and shorter
documents are packed longest first into the tightest bin that is compatible: bins are kept by residual, a bin holds
at most ``per_source`` documents of one source and one document of a duplicate cluster, and the search goes on to
the next larger residual until a bin has neither conflict. Sources and clusters are bits of integers on the bin;
``per_source`` bitmaps count a source.

Shards of about ``shard`` documents by a hash of id and content are packed alone, so no task grows with the input and
copies are spread. Clusters are the given column, else copies: equal words with A-Z lowered. Tokens are words plus one
end token.

Defined results: null and empty texts are one end token; null sources and clusters never conflict; repeated rows are
packed row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
PACKED = "doc_id long, piece int, bin_id long, start int, n_tokens int"


def token_count(text: str | Column = "text") -> Column:
    """Words plus the end token."""
    words = F.filter(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACES), lambda w: w != "")
    return F.size(words) + 1


class Bins:
    """Open bins by residual, with a bitmap of the residuals in use for the successor search."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.by_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used = 0
        self.residual: list[int] = []
        self.sources: list[list[int]] = []
        self.clusters: list[int] = []
        self._run, self._passed = None, {}

    def place(self, need: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, first token) of a document; source and cluster are single bits, 0 where there is none."""
        run = (need, source, cluster)
        if run != self._run:
            # Bins that refused a document refuse its equals: the next equal one starts behind them.
            self._run, self._passed = run, {}
        left = self.used >> need
        residual = need - 1
        while left:
            step = (left & -left).bit_length()
            residual += step
            left >>= step
            bins = self.by_residual[residual]
            for at in range(self._passed.get(residual, 0), len(bins)):
                b = bins[at]
                if not (self.clusters[b] & cluster or self.sources[b][-1] & source):
                    bins.pop(at)
                    self._passed[residual] = at
                    if not bins:
                        self.used &= ~(1 << residual)
                    return b, self._take(b, need, source, cluster)
            self._passed[residual] = len(bins)
        self.residual.append(self.capacity)
        self.sources.append([0] * self.per_source)
        self.clusters.append(0)
        return len(self.residual) - 1, self._take(len(self.residual) - 1, need, source, cluster)

    def _take(self, b: int, need: int, source: int, cluster: int) -> int:
        start = self.capacity - self.residual[b]
        self.residual[b] -= need
        self.clusters[b] |= cluster
        for plane, held in enumerate(self.sources[b]):
            if not held & source:
                self.sources[b][plane] |= source
                break
        r = self.residual[b]
        if r:
            # At the end: earlier places stay valid for the memory of refused bins.
            self.by_residual[r].append(b)
            self.used |= 1 << r
        return start


def _bits(values: pd.Series) -> list[int]:
    """A bit for each value that occurs more than once; the others and nulls cannot conflict."""
    codes, _ = pd.factorize(values)
    counts = np.bincount(codes[codes >= 0], minlength=1)
    number = np.cumsum(counts > 1) - 1
    return [1 << int(number[c]) if c >= 0 and counts[c] > 1 else 0 for c in codes]


def pack_shard(rows: pd.DataFrame, capacity: int, per_source: int, first_bin: int) -> pd.DataFrame:
    """Pack one shard; rows have doc_id, source, cluster, n_tokens."""
    rows = rows.sort_values(["n_tokens", "cluster", "source", "doc_id"], ascending=[False, True, True, True], kind="stable")
    out, full = [], 0
    rest = []
    for doc, n in zip(rows["doc_id"], rows["n_tokens"]):
        whole = (n - 1) // capacity
        out += [(doc, piece, first_bin + full + piece, 0, capacity) for piece in range(whole)]
        full += whole
        rest.append((n - whole * capacity, whole))
    sources, clusters = _bits(rows["source"]), _bits(rows["cluster"])
    bins = Bins(capacity, per_source)
    ids = rows["doc_id"].tolist()
    order = sorted(range(len(rest)), key=lambda i: (-rest[i][0], clusters[i], sources[i]))
    for i in order:
        need, piece = rest[i]
        b, start = bins.place(need, sources[i], clusters[i])
        out.append((ids[i], piece, first_bin + full + b, start, need))
    packed = pd.DataFrame(out, columns=["doc_id", "piece", "bin_id", "start", "n_tokens"])
    packed["doc_id"] = packed["doc_id"].astype("Int64")
    return packed


def pack(docs: DataFrame, capacity: int = 2048, per_source: int = 2, shard: int = 4096, cluster: str | None = None) -> DataFrame:
    """(doc_id, piece, bin_id, start, n_tokens): a row for each piece of every document.

    bin_id: shard in the upper 31 bits, number within the shard in the lower 32.
    """
    lowered = F.translate(F.trim(F.regexp_replace("text", SPACES, " ")), ascii_uppercase, ascii_lowercase)
    copies = F.xxhash64(lowered) if cluster is None else F.xxhash64(cluster)
    known = F.col("text").isNotNull() if cluster is None else F.col(cluster).isNotNull()
    shards = max(1, -(-docs.count() // shard))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.when(known, copies).alias("cluster"), token_count().alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", F.md5("text")), F.lit(shards)).alias("shard"),
    )

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(rows, capacity, per_source, int(key[0]) << 32)

    return narrow.groupBy("shard").applyInPandas(run, PACKED)
