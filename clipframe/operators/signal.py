"""One-step forms of the signal operators, for clips and for plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.functions.scores import integer_rms, rms_to_dbfs
from clipframe.operators import clips as C


def decode_clips(clips: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """``keep, sample_rate, num_channels, num_frames, channels, error``."""
    return C.run_steps(clips, C.decode(), keep,
                       ["sample_rate", "num_channels", "num_frames", "channels", "error"])


def decode_pcm(clips: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """Integer samples (channels interleaved): ``keep, sample_rate, ..., pcm, error``."""
    return C.run_steps(clips, [C.decode_pcm()], keep,
                       ["sample_rate", "num_channels", "num_frames", "pcm", "error"])


def clip_loudness(clips: DataFrame, keep: Sequence[str] = ("path",),
                  path_col: str | None = None) -> DataFrame:
    """``keep, dbfs, error``: only one number per clip leaves the Python worker.

    With ``path_col`` the files that the rows name are read there too.
    """
    return C.run_steps(clips, [C.decode_pcm(), C.loudness()], keep, ["dbfs", "error"],
                       path_col=path_col)


def sample_loudness(samples: DataFrame, keys: Sequence[str], sample: Column) -> DataFrame:
    """dBFS of clips stored one 16-bit sample per row.

    A sum and a count per clip: combined on the map side, so one clip may hold
    any share of the rows.
    """
    wide = sample.cast("double")
    sums = samples.groupBy(*keys).agg(
        F.sum(wide * wide).alias("__squares"), F.count(sample).alias("num_samples"))
    rms = integer_rms(F.col("__squares"), F.col("num_samples"))
    return sums.select(*keys, "num_samples", rms_to_dbfs(rms).alias("dbfs"))


def normalise_gain(clips: DataFrame, target_dbfs: float, keep: Sequence[str] = ("path",),
                   on_silence: str = "reject") -> DataFrame:
    steps = [C.decode_pcm(), C.gain_to(target_dbfs, on_silence), C.to_float()]
    return C.run_steps(clips, steps, keep, ["sample_rate", "samples", "error"])


def mono_clips(clips: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    return C.run_steps(clips, [*C.decode(), C.mono()], keep, ["sample_rate", "samples", "error"])


def mono_waves(df: DataFrame, samples_col: str, channels: int, keep: Sequence[str]) -> DataFrame:
    steps = [C.from_samples(samples_col, 1, channels), C.mono()]
    return C.run_steps(df, steps, keep, ["samples", "error"], inputs=[samples_col])


def resample_waves(df: DataFrame, samples_col: str, old: int, new: int,
                   keep: Sequence[str]) -> DataFrame:
    steps = [C.from_samples(samples_col, old), C.resample_to(new)]
    return C.run_steps(df, steps, keep, ["sample_rate", "samples", "error"], inputs=[samples_col])


def standardise_waves(df: DataFrame, samples_col: str, keep: Sequence[str]) -> DataFrame:
    steps = [C.from_samples(samples_col, 1), C.standardise()]
    return C.run_steps(df, steps, keep, ["samples", "error"], inputs=[samples_col])


def augment_waves(df: DataFrame, samples_col: str, rate: int, specs, key_col: str,
                  seed: int = 42, epoch: int = 0, split_col: str | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    from clipframe.operators.augment import compose

    steps = [C.from_samples(samples_col, rate),
             *compose(specs, key_col=key_col, seed=seed, epoch=epoch, split_col=split_col)]
    inputs = [samples_col, key_col, *([split_col] if split_col else [])]
    return C.run_steps(df, steps, list(dict.fromkeys([key_col, *keep])),
                       ["samples", "error"], inputs=inputs)


def standardise_column(samples: Column) -> Column:
    """Expression form of the standardisation, to check the kernel against."""
    from clipframe.functions.kernels import EPSILON
    from clipframe.functions.scores import bind

    wide = samples.cast("array<double>")

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

    return bind(total(wide) / F.size(wide), lambda mean: bind(
        total(F.transform(wide, lambda v: (v - mean) * (v - mean))) / F.size(wide),
        lambda var: F.transform(wide, lambda v: (v - mean) / F.sqrt(var + EPSILON))))
