"""Statistics kept with a manifest next to those of a full run."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipframe.operators import kept_stats
from clipframe.operators.kept_stats import CorpusStats
from clipframe.plans import jobs
from clipframe.sources import commits
from clipframe.sources.manifest import Manifest
from conftest import wav


@pytest.fixture
def corpus(spark, tmp_path):
    rng = np.random.default_rng(3)

    def add(*names):
        for i, name in enumerate(names):
            samples = rng.integers(-9_000, 9_000, 100 * int(rng.integers(1, 90)))
            (tmp_path / "clips" / name).write_bytes(wav(samples, (8_000, 16_000)[i % 2]))

    (tmp_path / "clips").mkdir()
    known = Manifest(spark, str(tmp_path / "manifest"))
    return add, known, CorpusStats(spark, str(tmp_path / "stats"), known), str(tmp_path / "clips")


def same(spark, kept, folder):
    full, formats, audit = jobs.dataset_stats(spark, folder)
    full, got = full.first(), kept.durations().first()
    for name in ("n", "min_s", "max_s", "mean_s", "std_s", "total_minutes"):
        assert got[name] == pytest.approx(full[name], rel=1e-9), name
    durations = np.sort([r.num_frames / r.sample_rate for r in jobs.clip_headers(spark, folder).filter(
        "error is null").collect()])
    ranks = np.searchsorted(durations, got.median_s, "left"), np.searchsorted(durations, got.median_s, "right")
    assert ranks[0] - 0.02 * len(durations) - 1 <= len(durations) / 2 <= ranks[1] + 0.02 * len(durations) + 1
    rates = {r.value: r.n_clips for r in formats.filter("attribute = 'sample_rate'").collect()}
    assert {r.sample_rate: r.n_clips for r in kept.formats().collect()} == rates
    assert got.n_rejected == audit.first().no_header


def test_appended_removed_and_changed_files(spark, corpus, monkeypatch):
    add, known, kept, folder = corpus
    read = []
    scan = kept_stats.scan_header_files

    def watched(files):
        read.append(sorted(os.path.basename(r.path) for r in files.collect()))
        return scan(files)

    monkeypatch.setattr(kept_stats, "scan_header_files", watched)
    assert kept.update() == [] and kept.durations().first().n == 0
    add(*[f"a{i}.wav" for i in range(40)])
    open(f"{folder}/junk.wav", "wb").write(b"junk")
    known.refresh(folder)
    assert kept.update() == [1] and kept.update() == []
    same(spark, kept, folder)
    add("b1.wav", "b2.wav", "b3.wav")
    known.refresh(folder)
    add("c1.wav")
    known.refresh(folder)
    assert kept.update() == [2, 3] and read[1:] == [["b1.wav", "b2.wav", "b3.wav"], ["c1.wav"]]
    same(spark, kept, folder)
    os.remove(f"{folder}/a3.wav")
    add("a4.wav")
    known.refresh(folder)
    assert kept.update() == [4] and read[3] == ["a4.wav"]
    same(spark, kept, folder)


def test_an_interrupted_update_is_done_again(spark, corpus, monkeypatch):
    add, known, kept, folder = corpus
    add("a.wav", "b.wav")
    known.refresh(folder)
    finish = commits.finish
    monkeypatch.setattr(commits, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        kept.update()
    monkeypatch.setattr(commits, "finish", finish)
    assert kept.measured() == [] and kept.update() == [1]
    same(spark, kept, folder)
