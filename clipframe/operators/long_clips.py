"""Clips of any length: files are cut into ranges of frames, and no row holds a whole clip.

A range is read by its place in the file. What a job needs of the whole clip (level,
mean, variance) is merged from the states of its ranges, and the resampling filter reads
the frames before and after a range that it reaches for. So the results are those of
the whole clip, however it is cut, and one recording is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipframe.functions import kernels as K
from clipframe.operators.preprocess import ClipSpec
from clipframe.session import hot_join, side_table
from clipframe.sources.files import Files, qualified
from clipframe.sources.manifest import dealt
from clipframe.sources.scan import materialise
from clipframe.sources.wav import FLOAT, WavError, check_format, file_layout, raw_samples

RANGE_BYTES = 8 << 20
RANGES_PER_TASK = 16      # of full length
PARTS_PER_TASK = 50_000   # of any length
PART_BYTES = 2 << 20      # of ranges that are worked on together
LAYOUT = ("path string, codec int, num_frames bigint, sample_rate int, num_channels int, bits int, "
          "data_offset bigint, step bigint, error string")
WAVES = ("path string, part bigint, first_sample bigint, samples array<float>, n bigint, "
         "mean double, spread double")
FULL_SCALE = 2.0 ** 31  # float files are measured as 32-bit integers


def layouts(files: DataFrame, target_rate: int | None = None, path_col: str = "path") -> DataFrame:
    """Where the samples of each file lie, schema ``LAYOUT``; one row for a path.

    ``step``: ranges must begin at a multiple of it, where an output sample of the
    target rate falls on an input frame. Files that cannot be read keep an ``error``.
    """
    base = qualified(files.sparkSession, ".")
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
             pa.string()]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Files(base)
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    with found.open(path) as handle:
                        codec, channels, rate, bits, offset, size = file_layout(handle)
                        check_format(codec, channels, rate, bits)
                        frames = size // (channels * bits // 8)
                        step = rate // math.gcd(rate, target_rate or rate)
                        rows.append((codec, frames, rate, channels, bits, offset, step,
                                     None if frames else "no samples"))
                except WavError as exc:
                    rows.append((None,) * 7 + (str(exc),))
                except FileNotFoundError as exc:
                    rows.append((None,) * 7 + (f"cannot read file: {type(exc).__name__}",))
            columns = zip(*rows) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[c.split()[0] for c in LAYOUT.split(", ")])

    names = files.select(F.col(path_col).cast("string").alias("path")).distinct()
    return dealt(names).mapInArrow(look, LAYOUT)


def ranges(heads: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``LAYOUT`` with ``part, first, last``: frames from first up to last, of good files.

    A range has about ``range_bytes``, at least one step. Ranges are dealt to tasks before
    a byte is read: neighbours of together about ``RANGE_BYTES`` stay side by side, and the
    number of tasks goes by the bytes, however short the ranges are.
    """
    frame = F.col("num_channels") * F.col("bits") / 8
    per = (F.ceil(F.greatest(F.floor(F.lit(range_bytes) / frame), F.lit(1)) / F.col("step"))
           * F.col("step")).cast("bigint")
    good = heads.filter("error is null").withColumn("per", per).withColumns({
        "parts": F.ceil(F.col("num_frames") / F.col("per")).cast("bigint"),
        "run": F.greatest(F.floor(RANGE_BYTES / (F.col("per") * frame)), F.lit(1)).cast("bigint")})
    runs = F.ceil(F.col("parts") / F.col("run")).cast("bigint")
    total = good.agg(F.sum(runs).alias("runs"), F.sum("parts").alias("parts"), F.sum(
        F.greatest(F.col("num_frames") * frame, F.lit(0))).alias("bytes")).first()
    n, cores = total["runs"] or 0, heads.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-(total["bytes"] or 0) // (RANGE_BYTES * RANGES_PER_TASK)),
                -(-(total["parts"] or 0) // PARTS_PER_TASK), min(n, cores), 1)
    dealt_ = good.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), runs - 1))).repartition(
        int(tasks), "path", "at")
    begin = F.col("at") * F.col("run")
    parts = F.sequence(begin, F.least(begin + F.col("run"), "parts") - 1)
    return dealt_.withColumn("part", F.explode(parts)).withColumns({
        "first": F.col("part") * F.col("per"),
        "last": F.least("num_frames", (F.col("part") + 1) * F.col("per"))}).drop(
            "per", "error", "parts", "run", "at")


class Opened:
    """Reads ranges; the file of the last one stays open for those that follow it."""

    def __init__(self, base: str):
        self.files, self.path, self.handle = Files(base), None, None

    def read(self, row: dict, first: int, last: int) -> np.ndarray:
        """Samples of the frames from ``first`` up to ``last``, channels interleaved."""
        if row["path"] != self.path:
            self.close()
            self.handle, self.path = self.files.open(row["path"]), row["path"]
        width = row["num_channels"] * row["bits"] // 8
        data = self.handle.read_at((last - first) * width, row["data_offset"] + first * width)
        return raw_samples(data, row["codec"], row["bits"], (last - first) * row["num_channels"])

    def close(self) -> None:
        if self.handle is not None:
            self.handle.close()
        self.path, self.handle = None, None


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of ranges, as many at a time as have ``PART_BYTES``, or one that alone has more."""
    for batch in batches:
        for low in range(0, batch.num_rows, 1_000):
            part, held = [], 0
            for row in batch.slice(low, 1_000).to_pylist():
                size = (row["last"] - row["first"]) * row["num_channels"] * row["bits"] // 8
                if part and held + size > PART_BYTES:
                    yield part
                    part, held = [], 0
                part.append(row)
                held += size
            yield part


def integers(samples: np.ndarray, row: dict) -> tuple[np.ndarray, int]:
    """Samples as integers and their width."""
    if row["codec"] != FLOAT:
        return samples, row["bits"]
    scaled = np.clip(np.floor(samples * FULL_SCALE), -FULL_SCALE, FULL_SCALE - 1)
    return scaled.astype(np.int32), 32


def sum_of_squares(samples: np.ndarray) -> int:
    """Exact, whatever the width: halves of 16 bits are squared apart."""
    high, low = samples.astype(np.int64) >> 16, samples.astype(np.int64) & 0xFFFF
    total = 0
    for at in range(0, len(samples), 1 << 24):
        h, w = high[at:at + (1 << 24)], low[at:at + (1 << 24)]
        total += (int(h @ h) << 32) + (int(h @ w) << 17) + int(w @ w)
    return total


def clip_levels(cut: DataFrame, mono: bool = False) -> DataFrame:
    """``(path, dbfs)`` from the ranges of files, merged exactly; ``mono`` after the down-mix."""
    base = qualified(cut.sparkSession, ".")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Opened(base)
        for part in in_parts(batches):
            rows = []
            for row in part:
                samples, bits = integers(opened.read(row, row["first"], row["last"]), row)
                if mono:
                    samples = K.pcm_mono(samples, row["num_channels"])
                rows.append((row["path"], len(samples), Decimal(sum_of_squares(samples)), bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.decimal128(38, 0), pa.int32()))],
                names=["path", "n", "squares", "width"])
        opened.close()

    sums = cut.mapInArrow(measure, "path string, n bigint, squares decimal(38,0), width int")
    whole = sums.groupBy("path").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"),
                                     F.max("width").alias("width"))
    rms = F.floor(F.sqrt(F.col("squares").cast("double") / F.col("n")))
    return whole.select("path", F.when(rms == 0, F.lit(float("-inf"))).otherwise(
        20 * F.log10(rms / F.pow(F.lit(2.0), F.col("width") - 1))).alias("dbfs"))


def long_loudness(files: DataFrame, path_col: str = "path", range_bytes: int = RANGE_BYTES
                  ) -> DataFrame:
    """``(path, num_frames, sample_rate, num_channels, bits, dbfs, error)`` of named files."""
    heads = materialise(layouts(files, path_col=path_col), "layouts")
    levels = clip_levels(ranges(heads, range_bytes))
    return heads.join(levels, "path", "left").select(
        "path", "num_frames", "sample_rate", "num_channels", "bits", "dbfs", "error")


def path_join(ranges_: DataFrame, side: DataFrame) -> DataFrame:
    """Ranges with what is known of their files; only paths of very many ranges are spread."""
    side, fits = side_table(side)
    if fits:
        return ranges_.join(F.broadcast(side), "path")
    return hot_join(ranges_, side, ["path"], "inner")


def long_waves(files: DataFrame, spec: ClipSpec, path_col: str = "path",
               range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """The clip chain up to standardising, range by range: ``(waves, rejected)``.

    ``waves (path, part, first_sample, samples)``: mono floats at the target rate, each
    range with its place in the clip; ``rejected (path, error)``. Level, mean and
    variance are those of the whole clip. Nothing is padded or augmented.
    """
    heads = materialise(layouts(files, spec.sample_rate, path_col), "layouts")
    cut = ranges(heads, range_bytes)
    rejected = heads.filter("error is not null").select("path", "error")
    gain = F.lit(0.0)
    if spec.apply_dbfs_norm:
        levels = materialise(clip_levels(cut, mono=True), "levels")
        if spec.on_silence == "reject":
            silent = levels.filter(F.col("dbfs") == float("-inf"))
            rejected = rejected.union(silent.select(
                "path", F.lit("silent clip has no gain").alias("error")))
        gain = F.when(F.col("dbfs") > float("-inf"), F.lit(spec.target_dbfs) - F.col("dbfs"))
        cut = path_join(cut, levels)
        if spec.on_silence == "reject":
            cut = cut.filter(F.col("dbfs") > float("-inf"))
    base, rate, norm = qualified(heads.sparkSession, "."), spec.sample_rate, spec.apply_dbfs_norm

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Opened(base)
        for part in in_parts(batches):
            rows = []
            for row, x, first in range_waves(opened, part, rate, norm):
                mean = float(x.mean(dtype=np.float64)) if len(x) else 0.0
                rows.append((row["path"], row["part"], first, x, len(x), mean,
                             float(((x - mean) ** 2).sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.int64(), pa.list_(pa.float32()), pa.int64(),
                    pa.float64(), pa.float64()))],
                names=[c.split()[0] for c in WAVES.split(", ")])
        opened.close()

    waves = materialise(cut.withColumn("gain", gain).mapInArrow(process, WAVES), "waves")
    shown = ["path", "part", "first_sample", "samples"]
    if not spec.standardise:
        return waves.select(*shown), rejected
    states = waves.select("path", "n", "mean", "spread")
    means = states.groupBy("path").agg(
        F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    whole = materialise(states.join(means, "path").groupBy("path", "centre", "total").agg(F.sum(
        F.col("spread") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("squares")).select(
            "path", "centre", F.sqrt(F.col("squares") / F.col("total") + K.EPSILON).alias("deviation")),
        "moments")
    scaled = F.transform("samples", lambda v: (
        (v - F.col("centre")) / F.col("deviation")).cast("float"))
    return path_join(waves.select(*shown), whole).select(
        "path", "part", "first_sample", scaled.alias("samples")), rejected


def range_waves(opened: Opened, rows: list[dict], rate: int, norm: bool
                ) -> Iterator[tuple[dict, np.ndarray, int]]:
    """``(row, wave, place)``: ranges as mono floats at the target rate, and where they begin.

    Ranges of one rate are resampled together, each beside the zeros the filter reaches for.
    """
    by_rate: dict[int, list[tuple[dict, np.ndarray, int]]] = {}
    for row in rows:
        x, begin = range_floats(opened, row, rate, norm)
        by_rate.setdefault(row["sample_rate"], []).append((row, x, begin))
    for old, found in by_rate.items():
        x, offsets = np.concatenate([x for _, x, _ in found]), K.lengths_to_offsets(
            np.array([len(x) for _, x, _ in found], np.int64))
        x, offsets = K.resample_clips(x, offsets, old, rate)
        up = rate // math.gcd(old, rate)
        for (row, _, begin), start in zip(found, offsets.tolist()):
            step = row["step"]
            first, shift = row["first"] // step * up, begin // step * up
            last = (K.resampled_length(row["num_frames"], old, rate)
                    if row["last"] == row["num_frames"] else row["last"] // step * up)
            yield row, x[start + first - shift:start + last - shift], first


def range_floats(opened: Opened, row: dict, rate: int, norm: bool) -> tuple[np.ndarray, int]:
    """A range and what the filter reaches for around it, as mono floats at the file's rate,
    and the frame they begin at."""
    old, step = row["sample_rate"], row["step"]
    up = rate // math.gcd(old, rate)
    # what the filter reaches for, in whole steps; the zeros around a clip are the filter's own
    reach = 0 if old == rate else math.ceil(
        K.FILTER_WIDTH * step / (K.ROLL_OFF * min(step, up))) + 2
    begin = max(0, row["first"] - -(-reach // step) * step)
    end = min(row["num_frames"], row["last"] + reach)
    samples, channels = opened.read(row, begin, end), row["num_channels"]
    if norm:
        samples, bits = integers(samples, row)
        samples = K.pcm_mono(samples, channels)
        if row["gain"] is not None:
            samples = K.pcm_gain(samples, row["gain"], bits)
        x, channels = (samples / 2.0 ** (bits - 1)).astype(np.float32), 1
    elif row["codec"] == FLOAT:
        x = samples.astype(np.float32)
    else:
        x = (samples / 2.0 ** (row["bits"] - 1)).astype(np.float32)
    return K.mix_down(x, np.array([0, len(x)]), np.array([channels]))[0], begin
