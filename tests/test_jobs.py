"""Whole jobs on small folders of generated clips."""

import math
import os
from collections import Counter

import numpy as np
import pytest
from conftest import tone, wav
from pyspark.sql import functions as F

from clipframe.functions import kernels as K
from clipframe.operators import model
from clipframe.operators.preprocess import ClipSpec
from clipframe.plans import jobs
from clipframe.sources import scan, sinks, tables
from clipframe.sources.wav import decode_samples


@pytest.fixture(scope="module")
def corpora(tmp_path_factory):
    """``<base>/train/<corpus>/...`` with 30 + 6 + 4 + 4 clips, pitch by class."""
    base = tmp_path_factory.mktemp("data")
    pitch = {"neutral": 200, "non-neutral-female": 2_500, "non-neutral-male": 900}

    def put(name, label, i):
        path = base / "train" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(wav(tone(pitch[label] + 7 * i, 0.1 + 0.01 * (i % 5)), 16_000))

    for i in range(30):
        label = list(pitch)[i % 3]
        put(f"CORAA_SER/deep/train/clip{i}_{label}.wav", label, i)
    for i in range(6):
        put(f"BAVED/{i}-m-21-0-{i % 3}-{i}.wav", "neutral" if i % 3 == 1 else "non-neutral-male", i)
    for i in range(4):
        put(f"EMOVO/f{i}/rab-f{i}-b{i}.wav", "non-neutral-female", i)
    for i in range(1, 5):
        put(f"RAVDESS/Actor_0{i}/03-01-01-01-01-01-0{i}.wav", "neutral", i)
    return base


@pytest.fixture(scope="module")
def metadata(spark, corpora):
    out = corpora / "metadata"
    counts = jobs.build_metadata(spark, str(corpora), f"{out}/train", f"{out}/dev",
                                 clips_out=f"{out}/dev_clips")
    return out, {r.corpus: r.n for r in counts.collect()}


def test_metadata_files(spark, corpora, metadata):
    out, counts = metadata
    assert counts == {"CORAA_SER": 30, "BAVED": 6, "EMOVO": 4, "RAVDESS": 4}
    train = tables.read_metadata(spark, f"{out}/train").collect()
    dev = tables.read_metadata(spark, f"{out}/dev").collect()
    assert len(dev) == 6 and len(train) == 24 + 14
    assert Counter(r.label for r in dev) == dict.fromkeys(
        ["neutral", "non-neutral-female", "non-neutral-male"], 2)
    paths = {r.wav_file for r in train} | {r.wav_file for r in dev}
    assert len(paths) == 44 and all(os.path.isfile(p) for p in paths)
    assert all("/CORAA_SER/" in r.wav_file for r in dev)
    stored = spark.read.parquet(f"{out}/dev_clips").collect()
    assert {r.wav_file for r in stored} == {r.wav_file for r in dev}
    assert all(bytes(r.content) == open(r.wav_file, "rb").read() for r in stored)


def test_bad_name_goes_to_the_rejects(spark, corpora, tmp_path):
    base = tmp_path
    for name in ("CORAA_SER", "BAVED", "EMOVO", "RAVDESS"):
        os.symlink(corpora / "train" / name, base / name)
    os.makedirs(base / "d" / "train" / "BAVED")
    for i in range(3):
        (base / "d" / "train" / "BAVED" / f"{i}-m-21-0-1-{i}.wav").write_bytes(wav([1]))
    (base / "d" / "train" / "BAVED" / "odd.wav").write_bytes(wav([1]))
    os.makedirs(base / "d" / "train" / "CORAA_SER")
    for i in range(10):
        (base / "d" / "train" / "CORAA_SER" / f"{i}_neutral.wav").write_bytes(wav([1]))
    counts = jobs.build_metadata(
        spark, str(base / "d"), f"{base}/t", f"{base}/v", rejects_out=f"{base}/r",
        mode="quarantine", corpora=("CORAA_SER", "BAVED"))
    assert {r.corpus: r.n for r in counts.collect()} == {"CORAA_SER": 10, "BAVED": 4}
    rejects = tables.read_metadata(spark, f"{base}/r", "corpus string, wav_file string").collect()
    assert [r.wav_file.endswith("BAVED/odd.wav") for r in rejects] == [True]
    assert tables.read_metadata(spark, f"{base}/t").count() == 8 + 3


def test_relative_base(spark, corpora, monkeypatch):
    monkeypatch.chdir(corpora)
    paths = scan.scan_corpora(spark, str(corpora), ["CORAA_SER"]).collect()
    assert {r.corpus for r in paths} == {"CORAA_SER"} and len(paths) == 30


def test_dataset_stats(spark, corpora):
    durations, formats, audit = jobs.dataset_stats(spark, str(corpora / "train"))
    seconds = []
    for folder, _, names in os.walk(corpora / "train"):
        seconds += [len(decode_samples(open(os.path.join(folder, n), "rb").read())[0]) / 16_000
                    for n in names]
    r = durations.first()
    assert r.n == 44
    assert [r.min_s, r.max_s, r.mean_s, r.median_s, r.std_s, r.total_minutes] == pytest.approx(
        [min(seconds), max(seconds), np.mean(seconds), np.median(seconds), np.std(seconds),
         sum(seconds) / 60])
    assert {tuple(r) for r in formats.collect()} == {
        ("sample_rate", 16_000, 44), ("num_channels", 1, 44)}
    assert tuple(audit.first()) == (44, 0, 0, 0, 0)


def test_mean_dbfs(spark, corpora):
    levels = []
    for folder, _, names in os.walk(corpora / "train" / "EMOVO"):
        for n in names:
            data = decode_samples(open(os.path.join(folder, n), "rb").read())[0]
            levels.append(K.pcm_dbfs(data, 16))
    r = jobs.mean_dbfs(spark, str(corpora / "train" / "EMOVO")).first()
    assert r.mean_dbfs == pytest.approx(np.mean(levels)) and r.n_clips == 4


def test_fit_predict_score(spark, corpora, metadata, tmp_path):
    out, _ = metadata
    train = tables.read_metadata(spark, f"{out}/train")
    dev = tables.read_metadata(spark, f"{out}/dev")
    spec = ClipSpec()
    best, history = jobs.fit(train, dev, spec, model_out=f"{tmp_path}/model",
                             metrics_out=f"{tmp_path}/metrics", reg_params=(0.01, 0.1))
    rows = spark.read.parquet(f"{tmp_path}/metrics").collect()
    assert {(r.split, r.value) for r in rows if r.metric == "samples"} == {
        ("train", 38.0), ("dev", 6.0)}
    test_root = tmp_path / "test"
    os.makedirs(test_root)
    for r in dev.collect():
        (test_root / os.path.basename(r.wav_file)).write_bytes(open(r.wav_file, "rb").read())
    (test_root / "broken.wav").write_bytes(b"RIFF")
    predictions, rejected = jobs.predict(spark, str(test_root), f"{tmp_path}/model", spec,
                                         out=f"{tmp_path}/pred")
    assert [r.error for r in rejected.collect()] == ["not a RIFF/WAVE file"]
    stored = tables.read_metadata(spark, f"{tmp_path}/pred")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, predictions.collect()))
    truth = dev.withColumn("wav_file", F.substring_index("wav_file", "/", -1))
    assert jobs.score(stored, truth).first().macro_f1 == 1.0
    assert history.filter("metric = 'macro_f1'").count() == 2


def test_label_out_of_the_dictionary_is_rejected(spark, corpora, metadata):
    out, _ = metadata
    dev = tables.read_metadata(spark, f"{out}/dev")
    dictionary = spark.createDataFrame([("neutral", 0)], "label string, label_id int")
    rows = jobs.training_features(dev, dictionary, ClipSpec(), clips_per_task=2).collect()
    assert Counter(r.error for r in rows) == {None: 2, "unknown label": 4}


def test_annotated_corpus(spark, tmp_path):
    wavs = tmp_path / "Session1" / "sentences" / "wav" / "Ses01F_impro01"
    notes = tmp_path / "Session1" / "dialog" / "EmoEvaluation"
    os.makedirs(wavs)
    os.makedirs(notes / "Attribute")
    lines = ["% header", ""]
    for i, emotion in enumerate(["neu", "ang", "xxx", "hap"]):
        (wavs / f"Ses01F_impro01_{'FM'[i % 2]}00{i}.wav").write_bytes(
            wav(np.zeros(16_000 * (16 if i == 3 else 1))))
        lines.append(f"[1.0 - 2.0]\tSes01F_impro01_{'FM'[i % 2]}00{i}\t{emotion}\t[2.5, 2.5, 2.5]")
    (notes / "Ses01F_impro01.txt").write_text("\r\n".join(lines))
    (notes / "Attribute" / "Ses01F_impro01.txt").write_text(lines[2].replace("neu", "ang"))
    rows = jobs.annotated_corpus(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r.wav_file), r.label) for r in rows) == [
        ("Ses01F_impro01_F000.wav", "neutral"), ("Ses01F_impro01_M001.wav", "non-neutral-male")]
    other = tmp_path / "Session1" / "sentences" / "wav" / "Ses01F_impro02"
    os.makedirs(other)
    (other / "Ses01F_impro02_F000.wav").write_bytes(wav([1] * 100))
    with pytest.raises(FileNotFoundError, match="Ses01F_impro02"):
        jobs.annotated_corpus(spark, str(tmp_path))
    rows = jobs.annotated_corpus(spark, str(tmp_path), "quarantine").collect()
    assert [r.error for r in rows if r.error] == ["no annotated emotion"]


def test_csv_bytes(spark, tmp_path):
    rows = [('say "hi", x.wav', "a"), (" lead", None), ("plain", "")]
    sinks.write_csv(spark.createDataFrame(rows, "wav_file string, label string"),
                    str(tmp_path / "out"), single_file=True)
    part = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert part.splitlines()[0] == "wav_file,label"
    assert set(part.splitlines()[1:]) == {'"say ""hi"", x.wav",a', " lead,", "plain,"}
    back = tables.read_metadata(spark, str(tmp_path / "out")).collect()
    assert {tuple(r) for r in back} == {('say "hi", x.wav', "a"), (" lead", None), ("plain", None)}


def test_export_repeats_the_same_files(spark, tmp_path):
    df = spark.createDataFrame([(i, bytearray(wav([i] * 5))) for i in range(9)],
                               "path int, content binary").repartition(3)
    name = F.concat(F.lit("a b/"), F.col("path").cast("string"), F.lit(".wav"))
    for _ in range(2):
        report = sinks.export_clips(df, str(tmp_path / "out"), name)
        assert report.count() == 9
    assert len(list((tmp_path / "out" / "a b").iterdir())) == 9
    assert sinks.name_collisions(
        spark.createDataFrame([("a/x.wav",), ("b/x.wav",), ("c/y.wav",)], "wav_file string")
    ).collect()[0].asDict() == {"name": "x.wav", "n": 2}


def test_any_model(spark):
    def load():
        return lambda batch: np.stack([batch[:, 0], batch[:, 1]], axis=1) * 2.0

    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [3.0, 1.0])], "id int, x array<float>")
    out = model.predict_batches(df, load, "x", input_tensor_shapes=[[2]]).orderBy("id").collect()
    assert [r.label_id for r in out] == [1, 0]
    assert out[0].score == pytest.approx(1 / (1 + math.exp(-2)))
