"""WAV headers and samples.

A header job sends 44 bytes per plain PCM file to Python, and the first 512 of files of
another layout, to have their chunks walked.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipframe.sources.files import Files, qualified

HEADER_FIELDS = (
    T.StructField("num_frames", T.LongType()),
    T.StructField("sample_rate", T.IntegerType()),
    T.StructField("num_channels", T.IntegerType()),
    T.StructField("bits", T.IntegerType()),
    T.StructField("error", T.StringType()),
)

# Fixed values of the WAV format.
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE
PCM_BITS = (8, 16, 24, 32)
FLOAT_BITS = (32, 64)
PLAIN_HEADER_BYTES = 44
# The 64-bit forms keep the sizes that do not fit 32 bits in a chunk of their own.
CONTAINERS = (b"RIFF", b"RF64", b"BW64")
SIZE_ELSEWHERE = 0xFFFFFFFF
# Chunks before the samples that are walked without sending a file to Python.
MOST_CHUNKS = 16
PLAIN_FORMAT = b"WAVEfmt \x10\x00\x00\x00\x01\x00"
# What is read of a file at first; the head of a usual file is shorter.
FIRST_BYTES = 512


class WavError(ValueError):
    """The bytes are not a WAV file this package can decode."""


def walk_chunks(data: bytes | memoryview, file_bytes: int | None = None
                ) -> tuple[int, int, int, int, int, int]:
    """``(codec, channels, rate, bits, data_offset, data_bytes)`` of a WAV file.

    ``file_bytes`` is the size of the file when ``data`` is only its beginning.
    """
    data = memoryview(data)
    return _walk(lambda at, count: data[at:at + count], len(data),
                 len(data) if file_bytes is None else file_bytes)


def _walk(read: Callable[[int, int], bytes | memoryview], known_bytes: int, file_bytes: int
          ) -> tuple[int, int, int, int, int, int]:
    """``walk_chunks`` over ``read(offset, count)``, which reaches ``known_bytes``."""
    head = bytes(read(0, 12))
    if len(head) < 12 or head[:4] not in CONTAINERS or head[8:] != b"WAVE":
        raise WavError("not a RIFF/WAVE file")
    fmt, at, large = None, 12, None
    while at + 8 <= known_bytes:
        name, size = struct.unpack("<4sI", read(at, 8))
        body = at + 8
        if name == b"ds64" and head[:4] != b"RIFF":
            if size < 24 or body + size > known_bytes:
                raise WavError("bad ds64 chunk")
            large = struct.unpack("<Q", read(body + 8, 8))[0]
        elif name == b"data" and size == SIZE_ELSEWHERE and large is not None:
            size = large
        if name == b"fmt ":
            if size < 16 or body + size > known_bytes:
                raise WavError("bad fmt chunk")
            fields = read(body, min(size, 26))
            codec, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", fields)
            if codec == EXTENSIBLE and size >= 26:
                codec = struct.unpack_from("<H", fields, 24)[0]
            fmt = codec, channels, rate, bits
        elif name == b"data":
            if fmt is None:
                raise WavError("data chunk before fmt chunk")
            return (*fmt, body, min(size, file_bytes - body))
        at = body + size + (size & 1)
    raise WavError("no data chunk" if fmt else "no fmt chunk")


def check_format(codec: int, channels: int, rate: int, bits: int) -> None:
    supported = (codec == PCM and bits in PCM_BITS) or (codec == FLOAT and bits in FLOAT_BITS)
    if not supported:
        raise WavError(f"unsupported codec {codec} with {bits} bits")
    if channels < 1 or rate < 1:
        raise WavError("bad channel count or sample rate")


def parse_header(data: bytes | memoryview, file_bytes: int | None = None
                 ) -> tuple[int, int, int, int]:
    """``(frames, rate, channels, bits)``; raises :class:`WavError`."""
    return _summary(*walk_chunks(data, file_bytes))


def _summary(codec: int, channels: int, rate: int, bits: int, _: int, size: int
             ) -> tuple[int, int, int, int]:
    check_format(codec, channels, rate, bits)
    return size // (channels * bits // 8), rate, channels, bits


def file_header(handle) -> tuple[int, int, int, int]:
    """As :func:`parse_header`, from an open file (``size()``, ``read_at(count, offset)``).

    Reads the first bytes, then the heads of further chunks; never the samples.
    """
    return _summary(*file_layout(handle))


def file_layout(handle) -> tuple[int, int, int, int, int, int]:
    """As :func:`walk_chunks`, from an open file."""
    size = handle.size()
    first = handle.read_at(min(size, FIRST_BYTES), 0)

    def read(at: int, count: int) -> bytes:
        return first[at:at + count] if at + count <= len(first) else handle.read_at(count, at)

    return _walk(read, size, size)


def decode_samples(data: bytes) -> tuple[np.ndarray, int, int, int]:
    """``(samples, rate, channels, bits)``, channels interleaved.

    Integer PCM gives int32 in the range of its width (8-bit is centred on 0);
    float files give float64.
    """
    codec, channels, rate, bits, offset, size = walk_chunks(data)
    check_format(codec, channels, rate, bits)
    count = size // (channels * bits // 8) * channels
    return raw_samples(data, codec, bits, count, offset), rate, channels, bits


def raw_samples(data: bytes, codec: int, bits: int, count: int, offset: int = 0) -> np.ndarray:
    """``count`` samples from a place in the bytes on; see :func:`decode_samples`."""
    width = bits // 8
    if codec == FLOAT:
        raw = np.frombuffer(data, "<f4" if bits == 32 else "<f8", count, offset)
        return raw.astype(np.float64)
    if bits == 8:
        samples = np.frombuffer(data, np.uint8, count, offset).astype(np.int32) - 128
    elif bits == 24:
        raw = np.frombuffer(data, np.uint8, count * 3, offset).reshape(-1, 3)
        wide = np.zeros((count, 4), np.uint8)
        wide[:, 1:] = raw
        samples = wide.view("<i4").ravel() >> 8
    else:
        samples = np.frombuffer(data, f"<i{width}", count, offset).astype(np.int32)
    return samples


def _is_plain(content: Column) -> Column:
    """A PCM file whose data chunk starts right after a 16-byte fmt chunk."""
    def at(offset: int, value: bytes) -> Column:
        return F.substring(content, offset + 1, len(value)) == F.lit(bytearray(value))

    return (at(0, b"RIFF") & at(8, PLAIN_FORMAT) & at(36, b"data")
            & (F.octet_length(content) >= PLAIN_HEADER_BYTES))


def _number(content: Column, at: Column) -> Column:
    """The little-endian 32-bit number at a place of the bytes."""
    digits = F.hex(F.substring(content, at + 1, F.lit(4)))
    return F.conv(F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("bigint")


def _is_short(content: Column) -> Column:
    """Whether the samples' chunk is found within the first bytes, by the sizes of those before."""
    here = F.struct(F.lit(12).cast("bigint").alias("at"), F.lit(False).alias("found"))

    def step(state: Column, _: Column) -> Column:
        size = _number(content, state["at"] + 4)
        found = F.substring(content, state["at"] + 1, F.lit(4)) == F.lit(bytearray(b"data"))
        after = state["at"] + 8 + size + size % 2
        return F.when(state["found"] | (state["at"] + 8 > FIRST_BYTES), state).otherwise(F.struct(
            F.when(found, state["at"]).otherwise(F.coalesce(after, F.lit(FIRST_BYTES).cast("bigint")))
            .alias("at"), F.coalesce(found, F.lit(False)).alias("found")))

    walked = F.aggregate(F.array_repeat(F.lit(0), MOST_CHUNKS), here, step)
    return walked["found"]


def _parse_headers(heads: pa.Array, sizes: list[int | None]) -> list[pa.Array]:
    rows = []
    for head, size in zip(heads, sizes):
        try:
            if not head.is_valid:
                raise WavError("no content")
            rows.append((*parse_header(head.as_buffer(), size), None))
        except WavError as exc:
            rows.append((None, None, None, None, str(exc)))
    return _header_arrays(rows)


def _header_arrays(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]


def _head(content: Column) -> Column:
    """What of a file is sent to Python: all of it only where its header is a long one."""
    return (F.when(_is_plain(content), F.substring(content, 1, PLAIN_HEADER_BYTES))
            .when(_is_short(content), F.substring(content, 1, FIRST_BYTES)).otherwise(content))


def scan_headers(clips: DataFrame, keep: Sequence[str] = ("path",),
                 content_col: str = "content") -> DataFrame:
    """``keep, num_frames, sample_rate, num_channels, bits, error`` of WAV bytes."""
    content = F.col(content_col)
    heads = clips.select(*keep, F.octet_length(content).alias("__size"),
                         _head(content).alias("__head"))
    schema = T.StructType([*heads.select(*keep).schema.fields, *HEADER_FIELDS])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, sizes, head = batch.columns
            yield pa.RecordBatch.from_arrays(
                [*kept, *_parse_headers(head, sizes.to_pylist())], names=schema.names)

    return heads.mapInArrow(parse, schema)


def scan_header_files(files: DataFrame, path_col: str = "path",
                      keep: Sequence[str] = ("path",)) -> DataFrame:
    """As :func:`scan_headers`, for files named by path: opened in the tasks, read by range.

    A missing file and one without a header keep their rows and get an ``error``; other
    read faults fail the task, so it is retried.
    """
    narrow = files.select(*dict.fromkeys([*keep, path_col]))
    schema = T.StructType([*[narrow.schema[c] for c in keep], *HEADER_FIELDS])
    base = qualified(files.sparkSession, ".")
    place = narrow.columns.index(path_col)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Files(base)
        for batch in batches:
            rows = []
            for path in batch.column(place).to_pylist():
                try:
                    with found.open(path) as handle:
                        rows.append((*file_header(handle), None))
                except WavError as exc:
                    rows.append((None, None, None, None, str(exc)))
                except FileNotFoundError as exc:
                    reason = f"cannot read file: {type(exc).__name__}"
                    rows.append((None, None, None, None, reason))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *_header_arrays(rows)], names=schema.names)

    return narrow.mapInArrow(parse, schema)


@F.arrow_udf(T.StructType(list(HEADER_FIELDS)))
def _header(head: pa.Array, size: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(
        _parse_headers(head, size.to_pylist()), names=[f.name for f in HEADER_FIELDS])


def with_headers(clips: DataFrame, content_col: str = "content") -> DataFrame:
    """Add the header columns; the audio itself stays in the JVM."""
    content = F.col(content_col)
    added = clips.withColumn("__h", _header(_head(content), F.octet_length(content)))
    return added.select(*clips.columns, *[f"__h.{f.name}" for f in HEADER_FIELDS])


def _hex_le(value: Column, size: int) -> Column:
    text = F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")
    return F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(size))])


def wav_bytes(pcm: Column, rate: Column, channels: Column, bits: Column) -> Column:
    """A canonical WAV file around little-endian PCM bytes (binary column)."""
    size = F.octet_length(pcm)
    frame_bytes = (channels * bits / 8).cast("int")
    header = F.concat(
        F.lit("52494646"), _hex_le(size + 36, 4), F.lit("57415645666D7420100000000100"),
        _hex_le(channels, 2), _hex_le(rate, 4), _hex_le(rate * frame_bytes, 4),
        _hex_le(frame_bytes, 2), _hex_le(bits, 2), F.lit("64617461"), _hex_le(size, 4))
    return F.concat(F.unhex(header), pcm)
