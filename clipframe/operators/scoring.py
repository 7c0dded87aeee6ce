"""Macro-F1, best epoch and early stopping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """``(truth, pred, n)``: the only shuffle of the scores, one row per pair per task."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def class_scores(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """``(class, tp, support, predicted, f1)`` over true and predicted classes."""
    pairs = confusion(df, truth, pred)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(zero)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("truth").alias("class"), hit.alias("tp"),
                 F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("pred").alias("class"), zero.alias("tp"),
                 zero.alias("support"), F.col("n").alias("predicted")),
    )).alias("s")).select("s.*")
    totals = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"))
    return totals.withColumn("f1", 2.0 * F.col("tp") / (F.col("support") + F.col("predicted")))


def macro_f1(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """One row ``(macro_f1, n_classes, n_rows)``: the unweighted mean of class F1."""
    return class_scores(df, truth, pred).agg(
        F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("n_classes"),
        F.sum("support").alias("n_rows"))


def best_epoch(history: DataFrame, run: str = "run", epoch: str = "epoch",
               value: str = "value", greater_is_better: bool = True) -> DataFrame:
    """``(run, best_epoch, best_value)``; the earliest epoch wins a tie, NaN loses to any value.

    A map-side combined ``max_by``, no sort of a run.
    """
    rank = F.when(~F.isnan(value), F.col(value) if greater_is_better else -F.col(value))
    order = F.struct(rank, (-F.col(epoch)).alias("earlier"))
    return history.groupBy(run).agg(
        F.max_by(epoch, order).alias("best_epoch"), F.max_by(value, order).alias("best_value"))


def early_stop(history: DataFrame, patience: int, run: str = "run", epoch: str = "epoch",
               value: str = "value", greater_is_better: bool = True) -> DataFrame:
    """``(run, stop_epoch)``: the first epoch with ``patience`` epochs without a
    new best; NULL when training is never stopped. NaN is never a new best.

    The history has one row per epoch of a run, which is all a window holds.
    """
    score = F.when(~F.isnan(value), F.col(value) if greater_is_better else -F.col(value))
    ordered = Window.partitionBy(run).orderBy(epoch)
    earlier = F.max("__score").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    place = F.row_number().over(ordered)
    marked = history.select(run, epoch, score.alias("__score")).select(
        run, epoch, place.alias("__place"),
        (F.col("__score").isNotNull() & (earlier.isNull() | (F.col("__score") > earlier)))
        .alias("__better"))
    last_best = F.max(F.when(F.col("__better"), F.col("__place"))).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    waiting = marked.select(run, epoch, (
        F.col("__place") - F.coalesce(last_best, F.lit(0))).alias("__waited"))
    return waiting.groupBy(run).agg(
        F.min(F.when(F.col("__waited") >= patience, F.col(epoch))).alias("stop_epoch"))
