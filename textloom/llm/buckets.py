"""Compare what shares a bucket, in blocks: no pair becomes a row and no bucket is one task.

Items carry one key for each hash table. A pair counts in the first table in which its keys agree, so it is
compared once. Buckets with the same members (of copies that agree in many tables) are processed once, in
their first table. A bucket above ``block`` items or ``block_cost`` units of payload is cut into blocks by a hash of the item,
and each pair of blocks is a task of its own; its rows are items, not pairs. A task returns for each item
the summed weight of its partners and one link of a spanning forest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored

# compare(payload: pa.Array) -> linked(i, j) -> bool array, for index arrays into the payload.
Compare = Callable[[pa.Array], Callable[[np.ndarray, np.ndarray], np.ndarray]]

LINKS = "row long, node long, partners long, root long"
CHUNK = 4 << 20
PAIRS = 1 << 18


def candidate_tasks(items: DataFrame, block: int, block_cost: int) -> DataFrame:
    """(task, band, cross, row, part): which items meet in which task."""
    entries = items.select("row", "cost", F.posexplode("keys").alias("band", "key"))
    members = (F.bit_xor(F.xxhash64("row", F.lit(1))), F.bit_xor(F.xxhash64("row", F.lit(2))))
    buckets = entries.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum("cost").alias("cost"), members[0].alias("d1"), members[1].alias("d2")
    )
    kept = buckets.where("n > 1").groupBy("n", "d1", "d2").agg(F.min(F.struct("band", "key", "cost")).alias("b"))
    parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("b.cost") / block_cost)).cast("int")
    kept = stored(kept.select("b.band", "b.key", parts.alias("parts")), "buckets")
    met = entries.select("row", "band", "key").join(kept, ["band", "key"])
    part = F.pmod(F.xxhash64("row", F.lit(3)), F.col("parts")).cast("int")
    met = met.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return met.select(
        F.xxhash64("band", "key", low, high).alias("task"), "band", (low != high).alias("cross"), "row", "part"
    )


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, limit: int = CHUNK) -> Iterator[pa.Table]:
    """Tables that hold whole runs of ``key`` of a sorted stream, of about ``limit`` bytes."""
    held: list[pa.Table] = []

    def cut(table: pa.Table) -> Iterator[pa.Table]:
        starts = np.append(_run_starts(table[key]), len(table))
        per_row = max(1, table.nbytes // max(1, len(table)))
        low = 0
        while low < len(table):
            high = starts[max(np.searchsorted(starts, low, "right"), np.searchsorted(starts, low + limit // per_row, "right") - 1)]
            yield table.slice(low, high - low)
            low = int(high)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        starts = _run_starts(table[key])
        if held and (len(starts) > 1 or held[-1][key][-1] != table[key][0]):
            first = held[-1][key][-1] == table[key][0]
            begin = int(starts[1]) if first else 0
            yield from cut(pa.concat_tables([*held, table.slice(0, begin)]))
            held, table = [], table.slice(begin)
            starts = _run_starts(table[key])
        if len(starts) > 1:
            yield from cut(table.slice(0, int(starts[-1])))
            table = table.slice(int(starts[-1]))
        if len(table):
            held.append(table)
    if held:
        yield from cut(pa.concat_tables(held))


def _run_starts(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_numpy()
    return np.append(0, np.flatnonzero(values[1:] != values[:-1]) + 1) if len(values) else np.zeros(0, int)


def _pairs(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs i < j in bounded pieces."""
    step = max(1, PAIRS // max(1, n))
    for low in range(0, n - 1, step):
        i = np.arange(low, min(low + step, n - 1))
        j = np.arange(n)
        ii, jj = np.nonzero(i[:, None] < j[None, :])
        yield i[ii], jj


def _forest(n: int, i: np.ndarray, j: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The smallest node of each index's component within the task."""
    root = node.copy()
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            return root


def link(
    items: DataFrame, payload: DataFrame, on: list[str], compare: Compare, block: int = 1024, block_cost: int = 1 << 20
) -> DataFrame:
    """(row, node, partners, root) of every item with a partner, one row for each task that found one.

    items (a stored table): row (unique), node (the id that components use), weight, cost, keys, and the
    columns ``on`` that find its ``payload`` in the other table. Only items in a shared bucket fetch theirs.
    """
    tasks = candidate_tasks(items, block, block_cost)
    narrow = tasks.join(items.select(*dict.fromkeys(["row", "node", "weight", "keys", *on])), "row")
    joined = narrow.join(payload.select(*on, "payload"), on)
    joined = joined.select("task", "band", "cross", "row", "part", "node", "weight", "keys", "payload")
    sorted_tasks = joined.repartition("task").sortWithinPartitions("task", "row")

    def run(batches):
        for table in whole_groups(batches, "task"):
            yield from _compare_groups(table, compare)

    return sorted_tasks.mapInArrow(run, LINKS)


def _compare_groups(table: pa.Table, compare: Compare) -> Iterator[pa.RecordBatch]:
    bounds = np.append(_run_starts(table["task"]), len(table))
    rows, nodes, weights, bands, parts = (table[c].to_numpy() for c in ("row", "node", "weight", "band", "part"))
    cross = table["cross"].to_numpy()
    keys = np.array(table["keys"].combine_chunks().flatten()).reshape(len(table), -1)
    linked = compare(table["payload"].combine_chunks())
    for low, high in zip(bounds[:-1], bounds[1:]):
        fresh = np.ones(high - low, bool)
        fresh[1:] = rows[low + 1 : high] != rows[low : high - 1]
        at = low + np.flatnonzero(fresh)
        found_i, found_j = [], []
        for i, j in _pairs(len(at)):
            i, j = at[i], at[j]
            if cross[low]:
                apart = parts[i] != parts[j]
                i, j = i[apart], j[apart]
            # The pair belongs to the first table in which its keys agree.
            ok = keys[i, bands[i]] == keys[j, bands[j]]
            ok &= bands[i] == bands[j]
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            same = (keys[i] == keys[j]).argmax(axis=1) == bands[i]
            i, j = i[same], j[same]
            if len(i):
                yes = linked(i, j)
                found_i.append(i[yes])
                found_j.append(j[yes])
        if not found_i or not sum(map(len, found_i)):
            continue
        i, j = np.concatenate(found_i) - low, np.concatenate(found_j) - low
        n = high - low
        partners = np.zeros(n, np.int64)
        np.add.at(partners, i, weights[low + j])
        np.add.at(partners, j, weights[low + i])
        root = _forest(n, i, j, nodes[low:high])
        hit = np.flatnonzero(partners > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (rows[low + hit], nodes[low + hit], partners[hit], root[hit])],
            ["row", "node", "partners", "root"],
        )
