"""Top-k, ranks and keep-first selection that stay parallel on large inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_words(counts: DataFrame, k: int = 50) -> DataFrame:
    """The k most frequent words; ties by word, so that shuffles cannot change the result."""
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(k)


def top_features(stats: DataFrame, k: int, by: str = "df") -> DataFrame:
    """First k features by (count descending, feature ascending), with their position ``idx``.

    A plain top-k would send k rows from every partition to one task. The count of the k-th
    feature is found first from the histogram of counts, so that only features at or above it
    are sorted. The windows here see distinct counts or at most k rows.
    """
    histogram = stats.groupBy(by).agg(F.count(F.lit(1)).alias("n_features"))
    running = F.sum("n_features").over(Window.orderBy(F.desc(by)))
    cutoff = (
        histogram.withColumn("running", running)
        .filter(F.col("running") >= k)
        .agg(F.max(by).alias("cutoff"))
        .scalar()
    )
    top = stats.filter(F.col(by) >= F.coalesce(cutoff, F.lit(0)))
    top = top.orderBy(F.desc(by), F.asc("feature")).limit(k)
    return top.withColumn("idx", F.row_number().over(Window.orderBy(F.desc(by), F.asc("feature"))) - 1)


def order_labels(labels: DataFrame, label: str = "label") -> DataFrame:
    """Distinct labels with their position: numbers by value first, then strings."""
    number = F.col(label).try_cast("double")
    order = Window.orderBy(number.isNull(), number, label)
    counted = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("position", F.row_number().over(order))


def text_key(text: Column) -> Column:
    """A 128-bit stand-in for a text, so that grouping by text moves no text; nulls are one text of their own."""
    return F.coalesce(F.md5(text), F.lit(""))


def dedup_first(df: DataFrame, key: str = "text", order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Keep, of all rows with one text, the row that is first in ``order`` (a unique order).

    Only text hashes and the order columns are grouped; copies are combined before the shuffle.
    The winners are joined back on hash and order together, which spreads even a text that a third
    of all rows share. The input is read twice: pass a stored table if it is costly to compute.
    """
    first = F.min(F.struct(*order)) if len(order) > 1 else F.min(order[0])
    keyed = df.withColumn("_key", text_key(F.col(key)))
    winners = keyed.groupBy("_key").agg(first.alias("_first"))
    if len(order) > 1:
        winners = winners.select("_key", *[F.col("_first")[c].alias(c) for c in order])
    else:
        winners = winners.withColumnRenamed("_first", order[0])
    return keyed.join(winners, ["_key", *order], "left_semi").drop("_key")


def confusion_bucket(label: Column, predicted: Column) -> Column:
    return (
        F.when((label == 1) & (predicted == 1), "TP")
        .when((label == 0) & (predicted == 0), "TN")
        .when((label == 0) & (predicted == 1), "FP")
        .when((label == 1) & (predicted == 0), "FN")
    )


def confusion_samples(predictions: DataFrame, n: int = 3, key: str = "doc_id") -> DataFrame:
    """First n documents of each confusion bucket. Each task keeps n per bucket before the shuffle."""
    bucketed = predictions.withColumn("bucket", confusion_bucket(F.col("label"), F.col("predicted")))
    order = Window.partitionBy("bucket").orderBy(key)
    return (
        bucketed.filter(F.col("bucket").isNotNull())
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= n)
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models by macro F1, best first; ties by name."""
    order = Window.orderBy(F.desc("macro_f1"), F.asc("model"))
    return metrics.withColumn("rank", F.row_number().over(order))


def bucketed_rank(df: DataFrame, groups: Sequence[str], value: str, n_buckets: int = 256) -> DataFrame:
    """Exact position (from 1) of each distinct numeric ``value`` in its group, and the group size.

    ``df`` holds one row per (group, value). A window per group would sort a group in one task.
    Approximate quantiles cut each group into even buckets, bucket sizes give each bucket its
    offset, and rows are numbered inside their bucket. The cuts only balance the work: any cuts
    give the same exact ranks.
    """
    if not groups:
        single = df.withColumn("_all", F.lit(0))
        return bucketed_rank(single, ["_all"], value, n_buckets).drop("_all")
    points = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    cuts = df.groupBy(*groups).agg(F.percentile_approx(value, points, F.lit(10 * n_buckets)).alias("_cuts"))
    cut = df.join(F.broadcast(cuts), list(groups)).withColumn(
        "_bucket", F.size(F.filter("_cuts", lambda c: c <= F.col(value)))
    ).drop("_cuts")
    sizes = cut.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy(*groups).orderBy("_bucket")
    offsets = sizes.select(
        *groups,
        "_bucket",
        (F.sum("_size").over(order) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*groups)).alias("group_size"),
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy(value)
    return (
        cut.withColumn("_inside", F.row_number().over(inside))
        .join(F.broadcast(offsets), [*groups, "_bucket"])
        .withColumn("rank", F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before")
    )
