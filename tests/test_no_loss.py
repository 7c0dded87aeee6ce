"""Rows that cannot be used stay visible, wherever the files lie."""

import math
from types import SimpleNamespace

import numpy as np
import pytest
from conftest import tone, wav

from clipframe.functions.kernels import acoustic_features
from clipframe.operators import scoring
from clipframe.plans import jobs
from clipframe.session import shared_dir
from clipframe.sources import scan
from clipframe.sources.wav import scan_headers


@pytest.fixture
def corpora(tmp_path):
    names = {"BAVED": ["0-M-21-0-1-2.wav", "nonsense.wav"],
             "CORAA": [f"c{i}_neutral.wav" for i in range(6)]}
    for corpus, files in names.items():
        for name in files:
            target = tmp_path / "train" / corpus / name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(wav(tone(200, 0.01)))
    return tmp_path


def test_a_folder_may_be_given_as_a_uri(spark, corpora):
    plain = scan.scan_corpora(spark, str(corpora), ["BAVED", "CORAA"])
    uri = scan.scan_corpora(spark, f"file://{corpora}", ["BAVED", "CORAA"])
    assert sorted(r.corpus for r in uri.collect()) == sorted(r.corpus for r in plain.collect())
    assert {r.corpus for r in uri.collect()} == {"BAVED", "CORAA"}
    assert {r.wav_file.removeprefix("file://") for r in uri.collect()} == {
        r.wav_file for r in plain.collect()}


def test_unlabelled_names_are_counted_or_raise(spark, corpora, tmp_path):
    out = {k: f"{tmp_path}/{k}" for k in ("train_out", "dev_out")}
    with pytest.raises(ValueError, match="rejects_out"):
        jobs.build_metadata(spark, str(corpora), **out, mode="quarantine",
                            corpora=["BAVED", "CORAA"])
    counts = jobs.build_metadata(spark, str(corpora), **out, rejects_out=f"{tmp_path}/r",
                                 mode="quarantine", corpora=["BAVED", "CORAA"])
    got = {r.corpus: r for r in counts.collect()}
    assert got["BAVED"].n == 2 and got["BAVED"].n_rejected == 1
    assert spark.read.csv(f"{tmp_path}/r", header=True).count() == sum(
        r.n_rejected for r in got.values())
    written = sum(spark.read.csv(out[k], header=True).count() for k in out)
    assert written == sum(r.n_train + r.n_dev for r in got.values())


def test_an_unknown_corpus_raises(spark):
    paths = spark.createDataFrame([("ELSE", "x/y.wav")], "corpus string, wav_file string")
    with pytest.raises(Exception, match="no label rule for corpus ELSE"):
        jobs.label_corpora(paths).collect()
    assert jobs.label_corpora(paths, "quarantine").first().label is None


def test_large_files_keep_their_row(spark, corpora):
    clips = scan.scan_clips(spark, str(corpora), max_bytes=10)
    assert clips.count() == 8 and {r.load_error for r in clips.collect()} == {"file too large"}
    assert scan_headers(clips).filter("error is not null").count() == 8


def test_a_store_that_cannot_be_read_fails(spark):
    paths = spark.createDataFrame([("nowhere://bucket/a.wav",)], "input_values string")
    with pytest.raises(Exception, match="nowhere"):
        scan.load_clips(paths).collect()
    missing = spark.createDataFrame([("/no/such/file.wav",), (None,)], "input_values string")
    assert all(r.load_error for r in scan.load_clips(missing).collect())


def test_the_end_of_a_clip_counts_in_its_features():
    x = np.random.default_rng(1).normal(size=1_000).astype(np.float32)
    cut = x.copy()
    cut[-232:] = 0
    assert np.abs(acoustic_features(x, 16_000)[6:] - acoustic_features(cut, 16_000)[6:]).max() > 0.01


def test_nan_is_never_best(spark):
    values = {"a": [1.0, math.nan, 2.0, math.nan, math.nan], "b": [math.nan, 3.0, 1.0, 1.0, 1.0],
              "c": [math.nan] * 5}
    df = spark.createDataFrame([(r, i, v) for r, vs in values.items() for i, v in enumerate(vs)],
                               "run string, epoch int, value double")
    best = {r.run: (r.best_epoch, r.best_value) for r in scoring.best_epoch(df).collect()}
    assert best["a"] == (2, 2.0) and best["b"] == (1, 3.0) and best["c"][0] == 0
    stop = {r.run: r.stop_epoch for r in scoring.early_stop(df, 2).collect()}
    assert stop == {"a": 4, "b": 3, "c": 1}
    low = {r.run: r.best_epoch for r in scoring.best_epoch(df, greater_is_better=False).collect()}
    assert low["a"] == 0 and low["b"] == 2


def test_a_cluster_without_a_shared_folder_raises():
    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                                  setCheckpointDir=lambda folder: None)
        return SimpleNamespace(sparkContext=context,
                               conf=SimpleNamespace(get=lambda key, default=None: default))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("local[4]"))
