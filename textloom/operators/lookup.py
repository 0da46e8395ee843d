"""Values of a keyed table next to the rows that ask for them, whatever the size of the table and the skew of the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import BROADCAST_BYTES, estimated_bytes

# Keys that are looked up by broadcast because many rows ask for them.
HEAVY = 1000


def attach_scores(docs: DataFrame, scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with the columns of ``scores``, matched by key and not by position."""
    return docs.join(scores, key)


def common_keys(probe: DataFrame, on: str, limit: int = HEAVY) -> list:
    """The most frequent keys, by a frequent-items sketch of bounded size that is merged over all tasks.

    A key with more than 1 / (6 * limit) of the rows is among them for certain.
    """
    top = probe.where(F.col(on).isNotNull()).agg(F.expr(f"approx_top_k(`{on}`, {limit}, {max(64, 8 * limit)})")).first()[0]
    return [entry.item for entry in top]


def lookup(probe: DataFrame, dim: DataFrame, on: str, heavy: int = HEAVY, small: int = BROADCAST_BYTES) -> DataFrame:
    """``probe`` with the columns of ``dim`` (null where it has none); keys of ``dim`` are unique.

    A table of at most ``small`` bytes goes to all tasks. Of a larger one only the rows of the commonest keys do, at most
    ``heavy``: rows that ask for them stay where they are, the others are shuffled by key, and no key among them is
    frequent. A stream cannot be counted beforehand: use this within ``foreachBatch``.
    """
    if estimated_bytes(dim) <= small:
        return probe.join(F.broadcast(dim), on, "left")
    keys = common_keys(probe, on, heavy)
    is_common = F.col(on).isin(keys) if keys else F.lit(False)
    hot = probe.where(is_common).join(F.broadcast(dim.where(is_common)), on, "left")
    # Without a key there is nothing to find, and all such rows would meet in one task.
    none = probe.where(F.col(on).isNull())
    light = probe.where(~is_common).join(dim, on, "left")
    return hot.unionByName(light).unionByName(none, allowMissingColumns=True)
