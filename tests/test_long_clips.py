"""Clips cut into ranges next to the whole clips, at every cut."""

import os
import struct

import numpy as np
import pytest

from clipframe.operators import clips as C
from clipframe.operators import long_clips, signal
from clipframe.operators.preprocess import ClipSpec
from clipframe.sources import scan
from clipframe.sources.wav import scan_header_files, scan_headers, walk_chunks
from conftest import wav


def rf64(data: bytes, name=b"RF64", size=0xFFFFFFFF) -> bytes:
    """A plain file in the 64-bit form: sizes in a ds64 chunk."""
    body = data[44:]
    ds64 = b"ds64" + struct.pack("<IQQQI", 28, len(data) + 28, len(body), 0, 0)
    return (name + struct.pack("<I", 0xFFFFFFFF) + b"WAVE" + ds64 + data[12:36] + b"data"
            + struct.pack("<I", size) + body)


@pytest.fixture(scope="module")
def folder(tmp_path_factory, wav_cases):
    path = tmp_path_factory.mktemp("long")
    rng = np.random.default_rng(8)
    more = {"stereo44k": wav(rng.integers(-9_000, 9_000, 8_000), 44_100, 2),
            "rf64": rf64(wav_cases["mono22k"]), "bw64": rf64(wav_cases["stereo8k"], b"BW64"),
            "rf64_plain_size": rf64(wav_cases["mono16"], size=len(wav_cases["mono16"]) - 44),
            "rf64_no_ds64": b"RF64" + wav_cases["mono16"][4:]}
    for name, data in {**wav_cases, **more}.items():
        (path / f"{name}.wav").write_bytes(data)
    return path


def names(spark, folder):
    rows = [(str(p),) for p in sorted(folder.iterdir())]
    return spark.createDataFrame([*rows, (f"{folder}/none.wav",)], "path string")


def test_64_bit_form(wav_cases):
    plain, large = wav_cases["mono22k"], rf64(wav_cases["mono22k"])
    assert walk_chunks(large) == (*walk_chunks(plain)[:4], 80, len(plain) - 44)
    assert walk_chunks(large[:100], 6 << 30)[5] == len(plain) - 44
    far = large[:20] + struct.pack("<QQ", 0, 5 << 30) + large[36:]  # more than 32 bits hold
    assert walk_chunks(far[:100], 6 << 30)[5] == 5 << 30
    assert walk_chunks(far[:100], 4 << 30)[5] == (4 << 30) - 80  # a file that was cut off


def test_headers_of_64_bit_files(spark, folder):
    by_path = {r.path: tuple(r)[1:] for r in scan_header_files(names(spark, folder)).collect()}
    by_bytes = {r.path: tuple(r)[1:] for r in scan_headers(
        scan.load_clips(names(spark, folder), "path").filter("content is not null")).collect()}
    assert all(by_path[p] == h for p, h in by_bytes.items())
    assert by_path[f"{folder}/rf64.wav"] == by_path[f"{folder}/mono22k.wav"]


@pytest.mark.parametrize("range_bytes", [1, 100, 1 << 20])
def test_levels_at_every_cut(spark, folder, range_bytes):
    given = names(spark, folder)
    if range_bytes == 1:
        given = given.filter("path rlike '(bits8|float|sample|junk|none)'")
    whole = {r.path: (r.dbfs, r.error) for r in signal.clip_loudness(given, path_col="path").collect()}
    got = long_clips.long_loudness(given, range_bytes=range_bytes).collect()
    assert len(got) == len(whole) and {r.path: r.error for r in got} == {
        p: e for p, (_, e) in whole.items()}
    assert all(r.dbfs is whole[r.path][0] or r.dbfs == pytest.approx(whole[r.path][0], rel=1e-14)
               for r in got)


def put_together(waves):
    clips = {}
    for r in sorted(waves.collect(), key=lambda r: (r.path, r.part)):
        clip = clips.setdefault(os.path.basename(r.path), [])
        assert r.first_sample == sum(len(x) for x in clip)
        clip.append(np.array(r.samples, np.float32))
    return {name: np.concatenate(parts) for name, parts in clips.items()}


@pytest.mark.parametrize("spec", [
    ClipSpec(), ClipSpec(standardise=False), ClipSpec(apply_dbfs_norm=True),
    ClipSpec(apply_dbfs_norm=True, on_silence="keep", standardise=False),
    ClipSpec(sample_rate=11_025)], ids=["plain", "raw", "gain", "silence", "11k"])
@pytest.mark.parametrize("range_bytes", [60, 1_300])
def test_chain_at_every_cut(spark, folder, spec, range_bytes):
    steps = [*spec.decode_steps(), C.mono(), C.resample_to(spec.sample_rate)]
    steps += [C.standardise()] if spec.standardise else []
    whole = C.run_steps(names(spark, folder), steps, ["path"], ["input_values", "error"],
                        path_col="path").collect()
    waves, rejected = long_clips.long_waves(names(spark, folder), spec, range_bytes=range_bytes)
    got = put_together(waves)
    assert {r.path: r.error for r in rejected.collect()} == {r.path: r.error for r in whole if r.error}
    assert set(got) == {os.path.basename(r.path) for r in whole if not r.error}
    for r in whole:
        if not r.error:
            mine = got[os.path.basename(r.path)]
            assert len(mine) == len(r.input_values)
            assert np.allclose(mine, r.input_values, atol=2e-5), r.path


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**31), 2**31, 10_000).astype(np.int32)
    assert long_clips.sum_of_squares(x) == sum(int(v) ** 2 for v in x)
    assert long_clips.sum_of_squares(np.array([-(2**31)] * 3, np.int32)) == 3 << 62


def test_no_files(spark):
    none = spark.createDataFrame([], "path string")
    assert long_clips.long_loudness(none).count() == 0
    waves, rejected = long_clips.long_waves(none, ClipSpec())
    assert waves.count() == rejected.count() == 0
