"""Connected components of links, by alternating stars over stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that links (a, b) lead to, for every node of a link.

    Large-star and small-star steps (Kiveris et al. 2014) until the edges stay the same: the number of
    rounds grows with the logarithm of the longest chain. Smallest neighbours are aggregated before the
    shuffle and stored, so the join that returns them to a hub's edges is one that adaptive execution can
    split. Self-links and nulls are left out; an empty table gives an empty one.
    """
    pair = (F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stored(edges.where("a is not null and b is not null and a != b").select(*pair).distinct(), "edges")
    seen = _fingerprint(current)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = stored(large.distinct(), "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u > v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        current = stored(small, "edges")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
