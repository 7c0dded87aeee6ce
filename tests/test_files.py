"""Files read by range and by path: headers, batches, stored labels, paths of other stores."""

import io

import numpy as np
import pytest
from conftest import tone, wav, with_list_chunk

from clipframe.functions import kernels as K
from clipframe.operators import batching
from clipframe.operators.encode import label_dictionary
from clipframe.operators.preprocess import ClipSpec, plan_batches, preprocess
from clipframe.plans import jobs
from clipframe.session import side_table
from clipframe.sources import scan, sinks
from clipframe.sources.files import Files, resolve
from clipframe.sources.wav import WavError, file_header, parse_header, scan_header_files


class Counted:
    """An open file that counts what is read of it."""

    def __init__(self, data):
        self.data, self.read = io.BytesIO(data), 0

    def size(self):
        return len(self.data.getbuffer())

    def read_at(self, count, offset):
        self.data.seek(offset)
        part = self.data.read(count)
        self.read += len(part)
        return part


def test_header_of_a_file_equals_that_of_its_bytes(wav_cases):
    for name, data in wav_cases.items():
        try:
            wanted = parse_header(data)
        except WavError as exc:
            with pytest.raises(WavError, match=str(exc)):
                file_header(Counted(data))
        else:
            assert file_header(Counted(data)) == wanted, name


def test_a_header_takes_a_few_bytes():
    long = wav(np.zeros(400_000))
    chunk = b"LIST" + (100_000).to_bytes(4, "little") + bytes(100_000)
    for data in (long, with_list_chunk(long), long[:36] + chunk + long[36:]):
        handle = Counted(data)
        assert file_header(handle) == (400_000, 16_000, 1, 16)
        assert handle.read <= 600


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("clips")
    for i in range(23):
        (out / f"c{i:02d}.wav").write_bytes(wav(tone(200 + 50 * i, 0.01 + 0.002 * (i % 5))))
    (out / "c05.wav").write_bytes(b"no clip")
    (out / "c06.wav").write_bytes(wav([]))
    (out / "c07.wav").write_bytes(wav(np.zeros(100)))
    return out


def rows_of(batches):
    return sorted((r.batch_id, r.path, tuple(map(tuple, r.input_values)),
                   tuple(map(tuple, r.attention_mask))) for r in batches.collect())


@pytest.mark.parametrize("spec", [
    ClipSpec(), ClipSpec(apply_dbfs_norm=True),
    ClipSpec(apply_dbfs_norm=True, padding="max_length", max_length=500, batch_size=3)])
def test_batches_by_path_equal_those_by_bytes(spark, folder, spec):
    names = spark.createDataFrame([(f"file:{folder}/c{i:02d}.wav",) for i in range(24)],
                                  "path string")
    clips = scan.load_clips(names, "path")
    by_bytes = preprocess(clips, spec)
    by_path = preprocess(names, spec, path_col="path", batches_per_task=2)

    def rows(done):
        return sorted((r.path, r.batch_id, r.pos, r.n_valid, r.error, r.input_values,
                       r.attention_mask) for r in done.collect())

    assert [r[4] for r in rows(by_path)].count(None) == (19 if spec.apply_dbfs_norm else 20) + 1
    assert rows(by_path) == rows(by_bytes)
    stacked = batching.stack_adjacent(by_path, "path", labels=None)
    assert rows_of(stacked) == rows_of(batching.stack_batches(by_bytes, "path", labels=None))


def test_no_audio_is_shuffled(spark, folder):
    names = scan.scan_paths(spark, str(folder), path_col="path")
    done = preprocess(names, ClipSpec(), path_col="path")
    for df in (done, batching.stack_adjacent(done, "path", labels=None)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        first = min(plan.index("Exchange"), plan.index("TableCacheQueryStage")
                    if "TableCacheQueryStage" in plan else len(plan))
        assert "content" not in plan[first:] and "input_values" not in plan[first:]


def test_a_missing_or_large_file_keeps_its_row(spark, folder):
    names = spark.createDataFrame([(f"{folder}/c00.wav",), (f"{folder}/none.wav",), (None,)],
                                  "path string")
    got = {r.path: (r.content is None, r.load_error)
           for r in scan.load_clips(names, "path", max_bytes=100).collect()}
    missing = "cannot read file: FileNotFoundError"
    assert got == {f"{folder}/c00.wav": (True, "file too large"),
                   f"{folder}/none.wav": (True, missing), None: (True, missing)}
    heads = {r.path: r.error for r in scan_header_files(names).collect()}
    assert heads == {f"{folder}/c00.wav": None, f"{folder}/none.wav": missing, None: missing}


def test_rows_without_a_path_are_dealt_evenly(spark):
    names = spark.range(4_000).selectExpr("if(id % 5 < 2, null, concat('/no/', id)) as path")
    loaded = scan.load_clips(names, "path", clips_per_task=100)
    sizes = [r["count"] for r in loaded.selectExpr("spark_partition_id() p").groupBy("p").count()
             .collect()]
    assert sum(sizes) == 4_000 and max(sizes) <= 200


def test_an_empty_table_has_no_batches(spark):
    names = spark.createDataFrame([], "path string")
    done = preprocess(names, ClipSpec(), path_col="path")
    assert done.collect() == []
    assert batching.stack_adjacent(done, "path", labels=None).collect() == []
    assert plan_batches(names, ClipSpec(), path_col="path").count() == 0


def test_jobs_give_the_same_over_folders_and_tables(spark, folder, tmp_path):
    table = scan.ingest(spark, str(folder), str(tmp_path / "table"))
    forms = [str(folder), f"file://{folder}", table,
             scan.scan_clips(spark, str(folder)).drop("load_error")]
    for job in (lambda s: jobs.dataset_stats(spark, s)[0], lambda s: jobs.mean_dbfs(spark, s),
                lambda s: jobs.dataset_stats(spark, s)[2]):
        # sums over other partitions may differ in the last bit
        found = [[tuple(round(v, 12) if isinstance(v, float) else v for v in row)
                  for row in job(form).collect()] for form in forms]
        assert all(rows == found[0] for rows in found)


def test_labels_come_with_the_model(spark, tmp_path):
    for name, pitch in (("a", 200), ("b", 2_000)):
        for i in range(6):
            (tmp_path / f"{name}{i}.wav").write_bytes(wav(tone(pitch + i, 0.05)))
    metadata = spark.createDataFrame(
        [(f"{tmp_path}/{n}{i}.wav", n) for n in "ab" for i in range(6)],
        "wav_file string, label string")
    best, _ = jobs.fit(metadata, metadata, ClipSpec(), model_out=f"{tmp_path}/model",
                       reg_params=(0.01,))
    # another table of labels, in which ids would shift, is not asked for any more
    shifted = label_dictionary(spark.createDataFrame([("0",), ("a",), ("b",)], "label string"))
    found, _ = jobs.predict(spark, str(tmp_path), f"{tmp_path}/model", ClipSpec())
    assert all(r.wav_file[0] == r.label for r in found.collect())
    wrong, _ = jobs.predict(spark, str(tmp_path), best, ClipSpec(), dictionary=shifted)
    assert any(r.wav_file[0] != r.label for r in wrong.collect())
    with pytest.raises(ValueError, match="dictionary"):
        jobs.predict(spark, str(tmp_path), best, ClipSpec())


def test_two_clips_of_one_name_are_refused(spark, tmp_path):
    clips = spark.createDataFrame([("a/x.wav", b"1"), ("b/x.wav", b"2")], "path string, content binary")
    with pytest.raises(ValueError, match="2 clips would be written to 'x.wav'"):
        sinks.export_clips(clips, str(tmp_path / "out"), clips.path.substr(3, 9))
    assert not (tmp_path / "out").exists()


def test_a_side_table_of_long_texts_is_not_shipped(spark):
    side = spark.createDataFrame([("x" * 400, 1), ("y" * 400, 2)], "k string, v int")
    assert side_table(side)[1] and side_table(side, max_bytes=800)[1]
    assert not side_table(side, max_bytes=799)[1] and not side_table(side, max_rows=1)[1]


def test_paths_are_resolved_as_spark_does():
    assert resolve("/a/b", "file:/home/me") == "file:/a/b"
    assert resolve("a/b", "file:/home/me") == "file:/home/me/a/b"
    assert resolve("/a/b", "hdfs://host:9/user/me") == "hdfs://host:9/a/b"
    assert resolve("a b", "hdfs://host:9/user/me") == "hdfs://host:9/user/me/a b"
    assert resolve("s3a://store/a", "file:/home") == "s3a://store/a"
    files = Files("file:/home/me")
    assert files.find("x/y.wav")[1] == "/home/me/x/y.wav"
    assert files.find("file:///x/y.wav")[1] == files.find("file:/x/y.wav")[1] == "/x/y.wav"
    files.known["s3a", "store"] = ("the store", "store")
    assert files.find("s3a://store/a b/c.wav") == ("the store", "store/a b/c.wav")
    files.known["hdfs", "host:9"] = ("the cluster", "/")
    assert files.find("hdfs://host:9/a/c.wav") == ("the cluster", "/a/c.wav")


def test_noise_of_shifted_counters_is_unrelated():
    stride = 0x9E3779B9
    one, two = ((20 * k * stride & 0xFFFFFFFF) << 32 | 77 + k for k in (0, 1))
    a, b = K.counter_normals(one, 5_000), K.counter_normals(two, 5_000)
    assert abs(np.corrcoef(a[10:], b[:-10])[0, 1]) < 0.05
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.05 and abs(a.std() - 1) < 0.05
