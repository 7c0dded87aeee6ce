"""Acoustic feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from clipframe.operators import clips as C
from clipframe.operators.preprocess import ClipSpec


def clip_features(clips: DataFrame, spec: ClipSpec, keep: Sequence[str] = ("path",),
                  path_col: str | None = None) -> DataFrame:
    """WAV bytes -> ``keep, features, error``; no waveform leaves the worker.

    With ``path_col`` the files that the rows name are read there too.
    """
    steps = [*spec.decode_steps(), C.mono(), C.resample_to(spec.sample_rate), C.features()]
    return C.run_steps(clips, steps, keep, ["features", "error"], path_col=path_col)


def wave_features(df: DataFrame, samples_col: str, rate: int, keep: Sequence[str]) -> DataFrame:
    steps = [C.from_samples(samples_col, rate), C.features()]
    return C.run_steps(df, steps, keep, ["features", "error"], inputs=[samples_col])
