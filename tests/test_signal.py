import numpy as np
import pytest
from conftest import tone, wav
from pyspark.sql import functions as F

from clipframe.functions import kernels as K
from clipframe.operators import signal
from clipframe.operators.augment import DEFAULT_AUGMENTATIONS, build_augmentation
from clipframe.operators.encode import label_dictionary
from clipframe.operators.features import wave_features
from clipframe.operators.preprocess import ClipSpec, plan_batches, preprocess
from clipframe.sources.scan import ingest
from clipframe.sources.tables import rows_to_table
from clipframe.sources.wav import decode_samples


def waves(spark, count=40, partitions=3):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=20 + i)]) for i in range(count)]
    return spark.createDataFrame(rows, "id int, x array<float>").repartition(partitions)


def by_key(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_standardise_kernel_equals_expression(spark):
    df = waves(spark)
    kernel = by_key(signal.standardise_waves(df, "x", ["id"]))
    expression = by_key(df.select("id", signal.standardise_column(F.col("x")).alias("samples")))
    for i, r in kernel.items():
        np.testing.assert_allclose(r.samples, expression[i].samples, atol=1e-5)


def test_two_channel_waves(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 5.0, 5.0])], "id int, x array<float>")
    assert signal.mono_waves(df, "x", 2, ["id"]).first().samples == [2.0, 5.0]


def test_sample_rows_and_files_have_the_same_level(spark):
    samples = [int(v) for v in tone(100, 0.05)]
    rows = spark.createDataFrame([(7, v) for v in samples], "id int, v int")
    level = signal.sample_loudness(rows, ["id"], F.col("v")).first()
    assert level.dbfs == pytest.approx(K.pcm_dbfs(np.array(samples), 16))
    silent = signal.sample_loudness(rows.withColumn("v", F.lit(0)), ["id"], F.col("v")).first()
    assert silent.dbfs == -np.inf


def test_augmentation_ignores_partitions_and_keeps_other_splits(spark):
    results = []
    for partitions in (1, 3, 17):
        df = waves(spark, partitions=partitions).withColumn(
            "split", F.when(F.col("id") % 2 == 0, "train").otherwise("dev"))
        out = signal.augment_waves(df, "x", 16_000, [{**a, "p": 0.5} for a in DEFAULT_AUGMENTATIONS],
                                   "id", split_col="split")
        results.append({k: r.samples for k, r in by_key(out).items()})
    assert results[0] == results[1] == results[2]
    original = {k: r.x for k, r in by_key(waves(spark)).items()}
    changed = {k for k, v in results[0].items() if v != original[k]}
    assert changed and all(k % 2 == 0 for k in changed)
    assert len(changed) < 20


def test_features_of_plain_waves(spark):
    table = rows_to_table(spark, [("a", [0.5, -0.5] * 400), ("b", [])], "id string, x array<float>")
    got = by_key(wave_features(table, "x", 16_000, ["id"]))
    assert len(got["a"].features) == K.FEATURE_SIZE and got["a"].features[0] == pytest.approx(0.5)
    assert got["b"].error == "no samples" and got["b"].features is None


def test_registry():
    spec = {"name": "echo", "p": 1.0}
    with pytest.raises(ValueError, match="echo"):
        build_augmentation(spec, key_col="id")
    spec = dict(DEFAULT_AUGMENTATIONS[0])
    build_augmentation(spec, key_col="id")
    assert spec == DEFAULT_AUGMENTATIONS[0]


def test_silent_clip(spark):
    df = spark.createDataFrame([("a", bytearray(wav([0] * 9)))], "path string, content binary")
    assert signal.normalise_gain(df, -20.0).first().error == "silent clip has no gain"
    kept = signal.normalise_gain(df, -20.0, on_silence="keep").first()
    assert kept.error is None and kept.samples == [0.0] * 9


# --- the whole chain against a plain loop --------------------------------

def brute_chain(rows, spec, ids):
    """``rows``: sorted (path, bytes, label). One clip after the other."""
    done = []
    for path, data, label in rows:
        try:
            samples, rate, channels, bits = decode_samples(data)
            assert len(samples)
            if spec.apply_dbfs_norm:
                samples = K.pcm_mono(samples, channels)
                level = K.pcm_dbfs(samples, bits)
                assert level > -np.inf
                samples, channels = K.pcm_gain(samples, spec.target_dbfs - level, bits), 1
            x = (samples / 2.0 ** (bits - 1)).astype(np.float32)
            x = x.reshape(-1, channels).mean(axis=1, dtype=np.float64).astype(np.float32)
            x, _ = K.resample_clips(x, np.array([0, len(x)]), rate, spec.sample_rate)
            x = K.zero_mean_unit_variance(x, np.array([0, len(x)]))
            done.append((path, x, ids[label]))
        except Exception:
            done.append((path, None, None))
    out = {}
    for at in range(0, len(done), spec.batch_size):
        batch = done[at:at + spec.batch_size]
        longest = max([len(x) for _, x, _ in batch if x is not None], default=0)
        for pos, (path, x, label) in enumerate(batch):
            out[path] = None if x is None else (
                at // spec.batch_size, pos, len(x), np.pad(x, (0, longest - len(x))), label)
    return out


@pytest.fixture(scope="module")
def labelled(spark, wav_cases):
    names = ["mono16", "stereo8k", "mono22k", "bits8", "bits24", "list_chunk", "silence",
             "one_sample", "no_samples", "junk", "three_channels", "bits32"]
    rows = [(f"d/{n}.wav", bytearray(wav_cases[n]), "odd" if n == "bits8" else "abc"[i % 3])
            for i, n in enumerate(names)]
    return rows, spark.createDataFrame(rows, "path string, content binary, label string")


@pytest.mark.parametrize("spec", [ClipSpec(), ClipSpec(apply_dbfs_norm=True, batch_size=3)])
@pytest.mark.parametrize("partitions", [1, 5])
def test_chain_equals_plain_loop(spark, labelled, spec, partitions):
    rows, df = labelled
    dictionary = label_dictionary(df.filter("label <> 'odd'"))
    ids = {r.label: r.label_id for r in dictionary.collect()}
    want = brute_chain(sorted((p, bytes(c), label) for p, c, label in rows), spec, ids)
    got = by_key(preprocess(df.repartition(partitions), spec, dictionary=dictionary), "path")
    assert set(got) == set(want)
    for path, expected in want.items():
        r = got[path]
        if expected is None:
            assert r.error and r.input_values is None, path
            continue
        batch_id, pos, n, x, label_id = expected
        assert (r.batch_id, r.pos, r.n_valid, r.label_id, r.error) == (batch_id, pos, n, label_id, None)
        assert r.attention_mask == [1] * n + [0] * (len(x) - n)
        np.testing.assert_allclose(r.input_values, x, atol=1e-5)
    assert got["d/bits8.wav"].error == "unknown label"


def test_ingested_clips_give_the_same_plan(spark, tmp_path, wav_cases):
    for name in ("mono16", "stereo8k", "list_chunk", "junk", "no_samples"):
        (tmp_path / f"{name}.wav").write_bytes(wav_cases[name])
    table = ingest(spark, str(tmp_path), str(tmp_path / "t.parquet"))
    plan = plan_batches(table, ClipSpec(), "path")
    fresh = plan_batches(table.select("path", "content"), ClipSpec(), "path")
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, fresh.collect()))


def test_repeated_key_is_refused(spark, labelled):
    _, df = labelled
    with pytest.raises(ValueError, match="not unique"):
        preprocess(df.union(df), ClipSpec())
