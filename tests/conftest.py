import io
import struct
import sys
import wave
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clipframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


def wav(samples, rate=16_000, channels=1, bits=16) -> bytes:
    """A PCM file by the standard library; ``samples`` are signed, interleaved."""
    samples = np.asarray(samples, np.int64)
    if bits == 8:
        data = (samples + 128).astype(np.uint8).tobytes()
    elif bits == 24:
        data = b"".join(struct.pack("<i", int(v))[:3] for v in samples)
    else:
        data = samples.astype(f"<i{bits // 8}").tobytes()
    out = io.BytesIO()
    with wave.open(out, "wb") as handle:
        handle.setnchannels(channels)
        handle.setsampwidth(bits // 8)
        handle.setframerate(rate)
        handle.writeframes(data)
    return out.getvalue()


def with_list_chunk(data: bytes) -> bytes:
    """The same file with a LIST chunk (odd size, so padded) before the data."""
    return data[:36] + b"LIST" + struct.pack("<I", 5) + b"INFOx\0" + data[36:]


def float_wav(values, rate=16_000, width=4) -> bytes:
    data = np.asarray(values, f"<f{width}").tobytes()
    fmt = struct.pack("<HHIIHH", 3, 1, rate, rate * width, width, width * 8)
    return (b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<I", 16)
            + fmt + b"data" + struct.pack("<I", len(data)) + data)


def extensible_wav(samples, rate=16_000) -> bytes:
    data = np.asarray(samples, "<i2").tobytes()
    guid = struct.pack("<H", 1) + b"\x00\x00\x00\x00\x10\x00\x80\x00\x00\xaa\x00\x38\x9b\x71"
    fmt = struct.pack("<HHIIHHHHI", 0xFFFE, 1, rate, rate * 2, 2, 16, 22, 16, 0) + guid
    return (b"RIFF" + struct.pack("<I", 60 + len(data)) + b"WAVEfmt "
            + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data)


def tone(frequency, seconds=0.5, rate=16_000, level=0.5):
    t = np.arange(int(seconds * rate)) / rate
    return np.round(level * 32767 * np.sin(2 * np.pi * frequency * t)).astype(np.int64)


@pytest.fixture(scope="session")
def wav_cases():
    rng = np.random.default_rng(7)
    mono = rng.integers(-20_000, 20_000, 4_000)
    return {
        "mono16": wav(mono),
        "stereo8k": wav(rng.integers(-20_000, 20_000, 2_400), 8_000, 2),
        "mono22k": wav(tone(500, rate=22_050), 22_050),
        "bits8": wav(rng.integers(-128, 128, 900), bits=8),
        "bits24": wav(rng.integers(-(2**23), 2**23, 900), bits=24),
        "bits32": wav(rng.integers(-(2**31), 2**31, 900), bits=32),
        "list_chunk": with_list_chunk(wav(mono)),
        "extensible": extensible_wav(mono),
        "float32": float_wav([0.25, -0.5, 0.125]),
        "float64": float_wav([0.25, -0.5], width=8),
        "silence": wav(np.zeros(500)),
        "one_sample": wav([123]),
        "no_samples": wav([]),
        "junk": b"this is not audio at all",
        "empty": b"",
        "truncated": wav(mono)[:1_044],
        "cut_header": wav(mono)[:30],
        "three_channels": wav(rng.integers(-9_000, 9_000, 900), channels=3),
    }
