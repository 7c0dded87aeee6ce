"""Run a chain of sample-level steps over clip rows, one Python pass per task.

A step is a function ``ClipBatch -> None`` that changes the batch in place.
Chaining steps inside one ``mapInArrow`` keeps waveforms in the Python worker:
audio crosses the JVM boundary once each way, whatever the number of steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipframe.functions.kernels import (
    acoustic_features,
    lengths_to_offsets,
    mix_down,
    pcm_dbfs,
    pcm_gain,
    pcm_mono,
    position_in_clip,
    resample_clips,
    zero_mean_unit_variance,
)
from clipframe.sources.files import qualified
from clipframe.sources.scan import read_files
from clipframe.sources.wav import WavError, decode_samples

FULL_SCALE_FLOAT = 2.0 ** 31
# Samples are worked on in parts of about this many input bytes, whatever the
# size of the Arrow batch, so a worker's memory does not depend on settings. A byte
# may be a sample, which takes some 60 bytes on its way through a chain.
PART_BYTES = 2 << 20


class ClipBatch:
    """Clips of one Arrow batch: ragged samples plus one entry per clip."""

    def __init__(self, table: pa.RecordBatch):
        self.table = table
        count = table.num_rows
        self.error: list[str | None] = [None] * count
        self.rate = np.zeros(count, np.int64)
        self.channels = np.ones(count, np.int64)
        self.bits = np.full(count, 16, np.int64)
        self.pcm: list[np.ndarray | None] = [None] * count
        self.values = np.empty(0, np.float32)
        self.offsets = np.zeros(count + 1, np.int64)
        self.valid = np.zeros(count, np.int64)
        self.mask = np.empty(0, np.int32)
        self.dbfs: list[float | None] = [None] * count
        self.features: list[np.ndarray | None] = [None] * count

    def __len__(self) -> int:
        return self.table.num_rows

    def column(self, name: str) -> list:
        return self.table.column(self.table.schema.get_field_index(name)).to_pylist()

    def good(self) -> Iterator[int]:
        return (i for i in range(len(self)) if self.error[i] is None)

    def clip(self, i: int) -> np.ndarray:
        return self.values[self.offsets[i]:self.offsets[i + 1]]

    def replace(self, clips: list[np.ndarray]) -> None:
        self.offsets = lengths_to_offsets(np.array([len(c) for c in clips], np.int64))
        self.values = (np.concatenate(clips).astype(np.float32, copy=False)
                       if clips else np.empty(0, np.float32))

    def reject(self, i: int, reason: str) -> None:
        self.error[i] = reason
        self.pcm[i] = None


Step = Callable[[ClipBatch], None]


# --- sources of samples --------------------------------------------------

def decode_pcm(content_col: str = "content") -> Step:
    """WAV bytes -> integer samples of every channel, at the width of the file."""

    def step(batch: ClipBatch) -> None:
        index = batch.table.schema.get_field_index
        if index("load_error") >= 0:
            batch.error = batch.column("load_error")
        for i, item in enumerate(batch.table.column(index(content_col))):
            if batch.error[i] is not None:
                continue
            if not item.is_valid:
                batch.reject(i, "no content")
                continue
            try:
                samples, rate, channels, bits = decode_samples(item.as_buffer())
            except (WavError, ValueError) as exc:
                batch.reject(i, str(exc))
                continue
            if len(samples) == 0:
                batch.reject(i, "no samples")
                continue
            batch.pcm[i] = samples
            batch.rate[i], batch.channels[i], batch.bits[i] = rate, channels, bits

    return step


def _to_int(batch: ClipBatch, i: int) -> np.ndarray:
    """Float files are measured as 32-bit integers."""
    samples = batch.pcm[i]
    if samples.dtype.kind == "f":
        samples = np.clip(np.floor(samples * FULL_SCALE_FLOAT),
                          -FULL_SCALE_FLOAT, FULL_SCALE_FLOAT - 1).astype(np.int32)
        batch.pcm[i], batch.bits[i] = samples, 32
    return samples


def to_float() -> Step:
    """Integer samples -> floats in [-1, 1], divided by the scale of their width."""

    def step(batch: ClipBatch) -> None:
        clips = []
        for i, samples in enumerate(batch.pcm):
            if samples is None:
                clips.append(np.empty(0, np.float32))
            elif samples.dtype.kind == "f":
                clips.append(samples.astype(np.float32))
            else:
                clips.append((samples / 2.0 ** (batch.bits[i] - 1)).astype(np.float32))
        batch.replace(clips)
        batch.pcm = [None] * len(batch)

    return step


def decode() -> list[Step]:
    return [decode_pcm(), to_float()]


def from_samples(samples_col: str, rate: int, channels: int = 1) -> Step:
    """Take waveforms that already are ``array<float>`` (channels interleaved)."""

    def step(batch: ClipBatch) -> None:
        array = batch.table.column(batch.table.schema.get_field_index(samples_col))
        lengths = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        batch.offsets = lengths_to_offsets(lengths.astype(np.int64))
        batch.values = array.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
        batch.rate[:] = rate
        batch.channels[:] = channels
        for i in np.flatnonzero(np.diff(batch.offsets) == 0):
            batch.reject(int(i), "no samples")

    return step


# --- steps ---------------------------------------------------------------

def loudness() -> Step:
    """dBFS over the integer samples of all channels."""

    def step(batch: ClipBatch) -> None:
        for i in batch.good():
            batch.dbfs[i] = pcm_dbfs(_to_int(batch, i), int(batch.bits[i]))

    return step


def gain_to(target_dbfs: float, on_silence: str = "reject") -> Step:
    """Down-mix integers, then scale them to ``target_dbfs``.

    The level is measured after the down-mix. A silent clip has no finite gain:
    it is rejected, or with ``on_silence='keep'`` left as it is.
    """
    if on_silence not in ("reject", "keep"):
        raise ValueError("on_silence must be 'reject' or 'keep'")

    def step(batch: ClipBatch) -> None:
        for i in batch.good():
            bits = int(batch.bits[i]) if batch.pcm[i].dtype.kind != "f" else 32
            samples = pcm_mono(_to_int(batch, i), int(batch.channels[i]))
            batch.channels[i] = 1
            level = pcm_dbfs(samples, bits)
            if math.isinf(level):
                if on_silence == "reject":
                    batch.reject(i, "silent clip has no gain")
                    continue
            else:
                samples = pcm_gain(samples, target_dbfs - level, bits)
            batch.pcm[i] = samples

    return step


def mono() -> Step:
    def step(batch: ClipBatch) -> None:
        batch.values, batch.offsets = mix_down(batch.values, batch.offsets, batch.channels)
        batch.channels[:] = 1

    return step


def resample_to(rate: int) -> Step:
    """Change the rate of the clips that have another one; the rest is untouched."""

    def step(batch: ClipBatch) -> None:
        lengths = np.diff(batch.offsets)
        wrong = [int(r) for r in np.unique(batch.rate[lengths > 0]) if r != rate]
        if not wrong:
            return
        clips = [batch.clip(i) for i in range(len(batch))]
        for old in wrong:
            chosen = np.flatnonzero((batch.rate == old) & (lengths > 0))
            flat = np.concatenate([clips[i] for i in chosen])
            values, offsets = resample_clips(
                flat, lengths_to_offsets(lengths[chosen]), old, rate)
            for at, i in enumerate(chosen):
                clips[i] = values[offsets[at]:offsets[at + 1]]
            batch.rate[chosen] = rate
        batch.replace(clips)

    return step


def standardise() -> Step:
    def step(batch: ClipBatch) -> None:
        batch.values = zero_mean_unit_variance(batch.values, batch.offsets)

    return step


def pad(pad_to_col: str) -> Step:
    """Fill clips with zeros up to the length in ``pad_to_col``; a longer one is kept."""

    def step(batch: ClipBatch) -> None:
        batch.valid = np.diff(batch.offsets)
        wanted = np.array([n or 0 for n in batch.column(pad_to_col)], np.int64)
        wanted[[error is not None for error in batch.error]] = 0
        offsets = lengths_to_offsets(np.maximum(wanted, batch.valid))
        place = np.repeat(offsets[:-1], batch.valid) + position_in_clip(batch.offsets)
        values = np.zeros(offsets[-1], np.float32)
        values[place] = batch.values
        batch.mask = np.zeros(offsets[-1], np.int32)
        batch.mask[place] = 1
        batch.values, batch.offsets = values, offsets

    return step


def features() -> Step:
    def step(batch: ClipBatch) -> None:
        for i in batch.good():
            batch.features[i] = acoustic_features(batch.clip(i), int(batch.rate[i]))

    return step


# --- running a chain -----------------------------------------------------

def _lists(values: np.ndarray, offsets: np.ndarray, valid: list[bool] | None,
           kind: pa.DataType) -> pa.Array:
    mask = None if valid is None else pa.array([not v for v in valid], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind), mask=mask)


def _float_lists(clips: list[np.ndarray], valid: list[bool] | None,
                 kind: pa.DataType) -> pa.Array:
    offsets = lengths_to_offsets(np.array([len(c) for c in clips], np.int64))
    return _lists(np.concatenate(clips) if clips else np.empty(0), offsets, valid, kind)


def _output(batch: ClipBatch, name: str) -> pa.Array:
    valid = [error is None for error in batch.error]
    everyone = range(len(batch))
    if name in ("samples", "input_values"):
        return _lists(batch.values, batch.offsets, valid, pa.float32())
    if name == "attention_mask":
        return _lists(batch.mask, batch.offsets, valid, pa.int32())
    if name == "pcm":
        empty = np.empty(0, np.int32)
        return _float_lists([_to_int(batch, i) if valid[i] else empty for i in everyone],
                            valid, pa.int32())
    if name == "channels":
        rows = [batch.clip(i).reshape(-1, batch.channels[i]).T if valid[i] else []
                for i in everyone]
        inner = _float_lists([channel for row in rows for channel in row], None, pa.float32())
        counts = np.array([len(row) for row in rows], np.int64)
        return pa.ListArray.from_arrays(
            pa.array(lengths_to_offsets(counts), pa.int32()), inner,
            mask=pa.array([not v for v in valid], pa.bool_()))
    if name == "features":
        empty = np.empty(0)
        return _float_lists([batch.features[i] if valid[i] else empty for i in everyone],
                            valid, pa.float64())
    if name == "error":
        return pa.array(batch.error, pa.string())
    if name == "num_frames":
        if batch.offsets[-1]:
            values = np.diff(batch.offsets) // batch.channels
        else:
            values = [0 if p is None else len(p) // c for p, c in zip(batch.pcm, batch.channels)]
        kind = pa.int64()
    elif name == "dbfs":
        values, kind = batch.dbfs, pa.float64()
    else:
        values = {"sample_rate": batch.rate, "num_channels": batch.channels,
                  "n_valid": batch.valid}[name]
        kind = pa.int32()
    number = float if name == "dbfs" else int
    return pa.array([number(values[i]) if valid[i] else None for i in everyone], kind)


OUTPUT_TYPES = {
    "samples": "array<float>",
    "input_values": "array<float>",
    "attention_mask": "array<int>",
    "n_valid": "int",
    "channels": "array<array<float>>",
    "pcm": "array<int>",
    "features": "array<double>",
    "sample_rate": "int",
    "num_channels": "int",
    "num_frames": "bigint",
    "dbfs": "double",
    "error": "string",
}


def _parts(table: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``PART_BYTES`` in ``column``."""
    array = table.column(table.schema.get_field_index(column))
    if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type):
        sizes = pc.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False)
    else:
        sizes = 4 * pc.list_value_length(array).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > PART_BYTES:
            yield table.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield table.slice(start)


def run_steps(df: DataFrame, steps: Sequence[Step], keep: Sequence[str],
              outputs: Sequence[str], inputs: Sequence[str] = ("content",),
              path_col: str | None = None) -> DataFrame:
    """Apply ``steps`` in order to every row.

    With ``path_col`` the bytes are read in the same pass, from the files the rows
    name. Only ``keep`` and ``inputs`` are sent to Python. The result has the ``keep``
    columns and the named ``outputs``; a row that fails keeps its ``error``.
    """
    steps = list(steps)
    wanted = list(dict.fromkeys([*keep, *inputs]))
    opened = None
    if path_col:
        wanted = [c for c in dict.fromkeys([*wanted, path_col]) if c != "content"]
        opened = read_files(qualified(df.sparkSession, "."), path_col, part_bytes=PART_BYTES)
    elif "load_error" in df.columns and "load_error" not in wanted:
        wanted.append("load_error")
    narrow = df.select(*wanted)
    schema = T.StructType([narrow.schema[c] for c in keep])
    for name in outputs:
        schema.add(name, T.DataType.fromDDL(OUTPUT_TYPES[name]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in opened(batches) if opened else batches:
            for table in _parts(whole, inputs[0]):
                batch = ClipBatch(table)
                for step in steps:
                    step(batch)
                kept = [table.column(table.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    kept + [_output(batch, name) for name in outputs], names=[*keep, *outputs])

    return narrow.mapInArrow(run, schema)


def split_rejects(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``. The two halves run the plan of ``df`` each: write a
    costly ``df`` first (``sources.scan.materialise``) when both are needed."""
    bad = F.col(error_col).isNotNull()
    return df.filter(~bad).drop(error_col), df.filter(bad)
