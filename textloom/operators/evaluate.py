"""Thresholds, metrics and model comparison over a long table of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.ranking import bucketed_rank, rank_models


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 from counts: 2tp / (2tp + fp + fn), 0 when undefined."""
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def metric_columns(tp: Column, tn: Column, fp: Column, fn: Column) -> list[Column]:
    clean, toxic = f1(tn, fn, fp), f1(tp, fp, fn)
    return [
        F.coalesce(F.try_divide((tp + tn).cast("double"), tp + tn + fp + fn), F.lit(0.0)).alias("accuracy"),
        ((clean + toxic) / 2).alias("macro_f1"),
        clean.alias("f1_clean"),
        toxic.alias("f1_toxic"),
    ]


def metrics(predictions: DataFrame, by: Sequence[str] = (), label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Confusion counts, accuracy and F1 per class, in one aggregate."""
    y, p = F.col(label), F.col(predicted)
    counted = predictions.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    cells = [F.col(c) for c in ("tp", "tn", "fp", "fn")]
    return counted.select(*by, *cells, *metric_columns(*cells))


def threshold_candidates(scores: DataFrame, by: Sequence[str] = (), cap: int = 250, score: str = "score") -> DataFrame:
    """Distinct scores with their slot; the lowest score of a slot is a candidate threshold.

    Up to ``cap`` distinct scores each is a candidate. With more, every (n // cap)-th in order is,
    and the last one.
    """
    ranked = bucketed_rank(scores, by, score)
    step = F.when(F.col("group_size") > cap, F.floor(F.col("group_size") / cap)).otherwise(F.lit(1))
    last = (F.col("group_size") > cap) & (F.col("rank") == F.col("group_size"))
    regular = F.floor((F.col("rank") - 1) / step)
    return ranked.withColumn("slot", F.when(last, F.col("group_size")).otherwise(regular)).drop("rank", "group_size")


def _best(slots: DataFrame, by: Sequence[str]) -> DataFrame:
    """Best macro F1 over thresholds ``slots(by, threshold, pos, neg)``; the lowest wins ties.

    Every row of a slot scores at or above its threshold, so predictions at a threshold are the
    sums of its slot and the slots above. A group has a few hundred slots.
    """
    above = Window.partitionBy(*by).orderBy(F.desc("threshold"))
    whole = Window.partitionBy(*by)
    cells = slots.select(
        *by,
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("p"),
        F.sum("neg").over(whole).alias("n"),
    )
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "p", "n"))
    macro = (f1(tp, fp, p - tp) + f1(n - fp, p - tp, fp)) / 2
    return cells.select(*by, "threshold", macro.alias("macro_f1"))


def _choose(tried: DataFrame, by: Sequence[str]) -> DataFrame:
    order = F.struct(F.col("macro_f1"), -F.col("threshold"))
    return tried.groupBy(*by).agg(
        F.max_by("threshold", order).alias("threshold"), F.max("macro_f1").alias("valid_macro_f1")
    )


def tune_threshold(
    scores: DataFrame, by: Sequence[str] = ("model",), cap: int = 250, label: str = "label", digits: int = 6
) -> DataFrame:
    """Threshold with the best macro F1 among the candidates, per group, in one pass.

    Scores are rounded first: equal texts must give equal scores whatever the order of summation.
    Rows of one score are combined before anything is ranked.
    """
    score = F.round("score", digits)
    counted = scores.groupBy(*by, score.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    slots = (
        threshold_candidates(counted, by, cap)
        .groupBy(*by, "slot")
        .agg(F.min("score").alias("threshold"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    chosen = _choose(_best(slots, by), by)
    # Without groups an empty input still gives a row: threshold 0, macro F1 0.
    return chosen.select(*by, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("threshold", "valid_macro_f1")))


def tune_threshold_grid(
    scores: DataFrame, by: Sequence[str] = (), lo: int = 10, hi: int = 90, label: str = "label", digits: int = 6
) -> DataFrame:
    """Best threshold among lo/100 ... hi/100; 0.5 with macro F1 0 when none is better than 0.

    Scores are rounded as in ``predict``, so that both put a score on the same side of a threshold.
    """
    group = list(by)
    slot = F.least(F.floor(F.round(F.round("score", digits) * 100, digits)), F.lit(hi))
    counted = scores.groupBy(*group, F.greatest(slot, F.lit(lo - 1)).cast("int").alias("slot")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    # Zero rows for the whole grid, so that a threshold without scores is tried as well.
    groups = counted.select(*group).distinct() if group else scores.sparkSession.range(1).select()
    grid = groups.select(*group, F.explode(F.sequence(F.lit(lo - 1), F.lit(hi))).alias("slot"))
    filled = grid.select("*", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg")).unionByName(counted)
    slots = filled.groupBy(*group, "slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    tried = _best(slots.withColumn("threshold", F.col("slot") / 100.0), group)
    best = _choose(tried.filter(F.col("threshold") >= lo / 100.0), group)
    is_better = F.col("valid_macro_f1") > 0
    return best.withColumn("threshold", F.when(is_better, F.col("threshold")).otherwise(0.5))


def predict(scores: DataFrame, thresholds: DataFrame, by: Sequence[str] = ("model",), digits: int = 6) -> DataFrame:
    """Label 1 where the rounded score reaches the threshold of its model (one row per model)."""
    hit = F.round("score", digits) >= F.col("threshold")
    return scores.join(F.broadcast(thresholds), list(by)).withColumn("predicted", hit.cast("int"))


def compare_models(scores: DataFrame) -> DataFrame:
    """Tune on valid, evaluate on test, rank by macro F1.

    ``scores`` is long: ``(model, doc_id, split, label, score)``. All models go through one plan.
    It is read for both splits, so pass a stored table.
    """
    tuned = tune_threshold(scores.filter(F.col("split") == "valid"))
    tested = metrics(predict(scores.filter(F.col("split") == "test"), tuned), ["model"])
    return rank_models(tested.join(F.broadcast(tuned), "model"))
