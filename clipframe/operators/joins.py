"""Clips with annotations, and predictions with ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.functions import labels as L
from clipframe.session import hot_join


def missing_annotations(clips: DataFrame, files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of clips that have no annotation file.

    Both sides are reduced to distinct keys first, so a dialog with very many
    clips is one row in the join.
    """
    wanted = clips.select(*keys).distinct()
    return wanted.join(files.select(*keys).distinct(), list(keys), "left_anti")


def join_annotations(clips: DataFrame, turns: DataFrame, keys: Sequence[str],
                     mode: str = "strict", path_col: str = "wav_file") -> DataFrame:
    """Add ``emotion_raw`` to every clip; ``turns`` has one row per key.

    A clip without annotation raises (``strict``) or keeps NULL (``quarantine``).
    Both sides grow with the corpus, so the join is a shuffle join. Turns that very many
    clips have are found by a sketch first, and spread over tasks.
    """
    joined = hot_join(clips, turns, list(keys))
    return joined.withColumn("emotion_raw", L.required(
        F.col("emotion_raw"), F.col(path_col), "annotated emotion", mode))


def is_usable(emotion: Column, duration: Column,
              bad_labels: Sequence[str] = (L.IEMOCAP_UNDECIDED,),
              max_seconds: float = L.MAX_SECONDS) -> Column:
    """A decided emotion and at most ``max_seconds`` (inclusive)."""
    return ~emotion.isin(*bad_labels) & (duration <= max_seconds)


def usable_clips(clips: DataFrame, emotion: str = "emotion_raw", duration: str = "duration_s",
                 **limits) -> DataFrame:
    return clips.filter(is_usable(F.col(emotion), F.col(duration), **limits))


def pair_predictions(pred: DataFrame, truth: DataFrame, key: str = "wav_file",
                     label: str = "label", how: str = "strict") -> DataFrame:
    """``(key, pred, truth, status)`` matched by key.

    Status: ``both``, ``only_pred``, ``only_truth`` or ``duplicate``. Each side is
    first reduced to one row per key, so repeated keys cannot multiply rows.
    ``how``: ``strict`` raises on anything but ``both``; ``inner`` keeps the
    ``both`` rows; ``report`` keeps all.
    """
    if how not in ("strict", "inner", "report"):
        raise ValueError("how must be 'strict', 'inner' or 'report'")

    def one_per_key(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(F.col(key)).agg(
            F.min(label).alias(side), F.count(F.lit(1)).alias(f"__n_{side}"))

    joined = one_per_key(pred, "pred").join(one_per_key(truth, "truth"), key, "full_outer")
    n_pred, n_truth = F.col("__n_pred"), F.col("__n_truth")
    status = (
        F.when((n_pred > 1) | (n_truth > 1), "duplicate")
        .when(n_truth.isNull(), "only_pred")
        .when(n_pred.isNull(), "only_truth")
        .otherwise("both"))
    paired = joined.select(key, "pred", "truth", status.alias("status"))
    if how == "report":
        return paired
    if how == "inner":
        return paired.filter(F.col("status") == "both")
    problem = F.concat(F.lit("prediction and truth do not match: "), F.col("status"),
                       F.lit(" "), F.col(key).cast("string"))
    return paired.withColumns({
        name: F.when(F.col("status") == "both", F.col(name)).otherwise(F.raise_error(problem))
        for name in ("pred", "truth")})
