"""Near duplicates of embeddings by p-stable hashing.

Equal vectors of one label become one class. Normalised class vectors are projected on seeded normal
directions, shifted and cut into steps of ``width``; ``k`` steps make a table's key, and the number of tables follows
from the recall wanted for a pair at the threshold. What shares a key is compared by its cosine in double precision.

Defined results: vectors that are null, empty, zero or hold nulls or non-finite numbers, rows with a null
label and rows with a null vec_id link with nothing; vectors of different lengths are never compared; rows
that repeat a vec_id count as one node; other columns are not read.
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
from textloom.llm.words import U, mix, seeded


def collision(distance: float, width: float) -> float:
    """Probability that two points at this distance fall into one step of a p-stable hash (Datar et al. 2004)."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(threshold: float, width: float, k: int, recall: float) -> int:
    """Tables that find a pair of unit vectors at the cosine threshold with this probability."""
    p = collision(math.sqrt(2 - 2 * threshold), width) ** k
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows padded with zeros to the longest, in double precision, and their lengths."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.asarray(vectors.value_lengths())
    flat = np.asarray(vectors.flatten(), np.float64)
    out = np.zeros((len(lengths), int(lengths.max(initial=1))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out, lengths


def hash_keys(classes: DataFrame, tables: int, k: int, width: float, seed: int) -> DataFrame:
    """Adds the keys of all tables; label and length are part of every key."""
    columns = classes.columns

    def run(batches):
        planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, lengths = _matrix(batch.column("payload"))
            # The largest component becomes 1 first: squares of huge or tiny numbers would leave the range.
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            keys = np.zeros((len(x), tables), U)
            for d in np.unique(lengths):
                if d not in planes:
                    rng = np.random.default_rng([seed, int(d)])
                    planes[d] = rng.standard_normal((int(d), tables * k)), rng.uniform(0, width, tables * k)
                rows = np.flatnonzero(lengths == d)
                a, b = planes[d]
                steps = np.floor((x[rows, :d] @ a + b) / width).astype(np.int64).view(U).reshape(len(rows), tables, k)
                total = (mix(steps + seeded(k, 5)) * seeded(k, 6)).sum(axis=2, dtype=U)
                keys[rows] = mix(total + mix(np.array([d], U)))
            labels = np.asarray(batch.column("lh").to_numpy()).view(U)
            keys = mix(keys ^ labels[:, None]).view(np.int64)
            ends = pa.array(np.arange(0, (len(x) + 1) * tables, tables, dtype=np.int32))
            listed = pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*columns, "keys"])

    from pyspark.sql import types as T

    schema = T.StructType([*classes.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])
    return classes.mapInArrow(run, schema)


def cosine(threshold: float):
    def compare(vectors: pa.Array):
        x, _ = _matrix(vectors)
        x /= np.abs(x).max(axis=1, keepdims=True)
        norms = np.sqrt((x * x).sum(axis=1))

        def linked(i, j):
            return (x[i] * x[j]).sum(axis=1) / (norms[i] * norms[j]) >= threshold

        return linked

    return compare


def near_vectors(
    embeddings: DataFrame, threshold: float = 0.98, width: float = 0.8, k: int = 6, recall: float = 0.999, seed: int = 7
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings``."""
    tables = plan_tables(threshold, width, k, recall)
    vector = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    fit = F.coalesce((F.size("v") > 0) & sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("v")).withColumn("fit", fit)
    # Adding 0.0 turns -0.0 into 0.0, so that equal vectors have equal hashes.
    hashed = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).select(
        "vec_id", "fit", "v", F.xxhash64("label").alias("lh"),
        F.when(F.col("fit"), F.xxhash64("label", "v")).alias("k1"), F.when(F.col("fit"), F.hash("v", "label")).alias("k2"),
    )
    grouped = hashed.where("fit").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.any_value("lh").alias("lh"), F.any_value("v").alias("payload")
    )
    numbered = grouped.withColumn("row", F.monotonically_increasing_id()).withColumn("cost", F.lit(1).cast("long"))
    classes = stored(hash_keys(stored(numbered, "vectors"), tables, k, width, seed), "classes")
    links = stored(link(classes, classes.select("row", "payload"), ["row"], cosine(threshold)), "links")
    groups = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    partners = links.groupBy("row").agg(F.sum("partners").alias("partners"))
    results = (
        classes.select("k1", "k2", "node", "row", "weight").join(partners, "row", "left").join(groups, "node", "left")
        .select("k1", "k2", F.coalesce("component", "node").alias("component_id"),
                (F.coalesce("partners", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    joined = hashed.select("vec_id", "k1", "k2").join(stored(results, "results"), ["k1", "k2"], "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
