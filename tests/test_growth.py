"""What must not grow with the input: tasks, broadcasts, parts of a worker, listings, shuffles."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clipframe.functions import kernels as K
from clipframe.llm import common, langid, minhash, tokens
from clipframe.operators import clips as C
from clipframe.operators import joins, long_clips
from clipframe.operators.preprocess import ClipSpec
from clipframe.plans import queries as Q
from clipframe.sources import scan
from clipframe.sources.manifest import dealt
from clipframe.sources.wav import scan_header_files
from conftest import wav


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_annotations_from_python_are_not_broadcast(spark):
    """The planner takes what comes out of Python for as small as what went in."""
    def turns(batches):
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(["t"] * n), pa.array(["neu"] * n)],
                names=["dialog", "turn", "emotion_raw"])

    dialogs = spark.range(20).select(F.col("id").cast("string").alias("dialog"))
    given = dialogs.mapInArrow(turns, "dialog string, turn string, emotion_raw string")
    for copies in (1, 900):  # no hot key, and one
        clips = dialogs.unionByName(spark.range(copies).select(F.lit("7").alias("dialog"))).select(
            "dialog", F.lit("t").alias("turn"), F.lit("x.wav").alias("wav_file"))
        joined = joins.join_annotations(clips, given, ["dialog", "turn"])
        assert "BroadcastHashJoin" not in plan_of(joined)
        assert joined.filter("emotion_raw = 'neu'").count() == 20 + copies


def test_short_ranges_do_not_make_more_tasks(spark, tmp_path):
    data = wav(np.random.default_rng(1).integers(-9_000, 9_000, 200_000), 22_050)
    (tmp_path / "long.wav").write_bytes(data)
    files = spark.createDataFrame([(f"{tmp_path}/long.wav",)], "path string")
    heads = scan.materialise(long_clips.layouts(files), "layouts")
    cut = long_clips.ranges(heads, 100)
    assert cut.count() == 4_000
    assert cut.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    places = sorted((r["part"], r["first"], r["last"]) for r in cut.collect())
    assert [p for p, _, _ in places] == list(range(4_000))
    assert places[0][1] == 0 and places[-1][2] == 200_000
    assert all(a[2] == b[1] for a, b in zip(places, places[1:]))


def test_ranges_of_a_file_open_it_once(tmp_path, monkeypatch):
    """Many ranges of a task are read from one handle and resampled in one product."""
    (tmp_path / "a.wav").write_bytes(wav(np.arange(4_410), 22_050))
    row = {"path": f"file:{tmp_path}/a.wav", "codec": 1, "num_frames": 4_410, "sample_rate": 22_050,
           "num_channels": 1, "bits": 16, "data_offset": 44, "step": 441}
    rows = [{**row, "part": i, "first": 441 * i, "last": 441 * (i + 1)} for i in range(10)]
    opened, found, calls = long_clips.Opened("file:/"), [], []
    resample, find = K.resample_clips, opened.files.open
    monkeypatch.setattr(K, "resample_clips", lambda *a: calls.append("resample") or resample(*a))
    monkeypatch.setattr(opened.files, "open", lambda p: calls.append("open") or find(p))
    found = list(long_clips.range_waves(opened, rows, 16_000, False))
    assert calls == ["open", "resample"]
    whole = resample((np.arange(4_410) / 2.0 ** 15).astype(np.float32), np.array([0, 4_410]), 22_050,
                     16_000)[0]
    assert np.allclose(np.concatenate([x for _, x, _ in found]), whole, atol=1e-6)


@pytest.mark.parametrize("given", ["folder", "folders"])
def test_ingest_lists_in_tasks(spark, tmp_path, monkeypatch, given):
    """No listing on the driver; left out is what Spark's listing leaves out."""
    clip = wav([1, 2, 3])
    for name in ("a/x.wav", "a/_x.wav", "a/.x.wav", "_a/y.wav", "b/_k=1/z.wav", "b/empty.wav",
                 "b/_metadata/m.wav", "b/other.txt"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"" if "empty" in name else clip)
    roots = str(tmp_path / "in") if given == "folder" else [str(tmp_path / "in" / d) for d in "ab"]
    wanted = sorted(r["path"] for r in scan.scan_clips(spark, roots).collect())
    assert len(wanted) == 3
    monkeypatch.setattr(scan, "scan_clips", None)
    monkeypatch.setattr(scan, "_files", None)
    table = scan.ingest(spark, roots, str(tmp_path / "out"))
    rows = table.collect()
    assert sorted(r["path"] for r in rows) == wanted
    assert all(bytes(r["content"]) == clip and r["num_frames"] == 3 and r["length"] == len(clip)
               and r["error"] is None for r in rows)
    assert table.columns == ["path", "length", "content", "load_error", "num_frames", "sample_rate",
                             "num_channels", "bits", "error"]


def test_parts_of_a_worker_are_small():
    """Clips of one byte a sample: what a chain needs at a time does not grow with the batch."""
    clip = wav(np.random.default_rng(2).integers(-128, 128, 2_000), 22_050, bits=8)
    table = pa.RecordBatch.from_arrays(
        [pa.array([clip] * 5_000, pa.binary()), pa.array([1_500] * 5_000)], names=["content", "pad_to"])
    steps = [*ClipSpec().steps("key", None, False), C.pad("pad_to")]
    tracemalloc.start()
    try:
        n = 0
        for part in C._parts(table, "content"):
            batch = C.ClipBatch(part)
            for step in steps:
                step(batch)
            n += len(C._output(batch, "input_values"))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 5_000 and peak < 200 << 20


def suppliers(spark, tmp_path, n=60):
    spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("s_suppkey")).coalesce(1).write.parquet(
        f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_tones_are_dealt_and_made_once(spark, tmp_path):
    tones = Q._tones(spark, suppliers(spark, tmp_path))
    assert tones.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    rows = {r["s_suppkey"]: r for r in tones.collect()}
    assert len(rows) == 60 and set(rows[None]["samples"]) == {None}
    for key in (1, 33, 59):
        at = 16 + key % 48
        assert rows[key]["bin"] == at and np.allclose(
            rows[key]["samples"], np.sin(np.arange(8_192) * at * 2 * np.pi / 512) / 2, atol=1e-6)


def test_pitch_shift_writes_no_waveform(spark, tmp_path, monkeypatch):
    texts = [(1, "en", "ab" * 5_000), (2, "fr", "xyz" * 3_000), (2, "fr", "other" * 2_000), (None, "de", "q" * 99)]
    spark.createDataFrame(texts, "doc_id bigint, lang string, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    written, materialise = [], scan.materialise
    monkeypatch.setattr(scan, "materialise", lambda df, name: written.append(df.dtypes) or materialise(df, name))
    rows = Q.pitch_shift(spark, str(tmp_path)).collect()
    assert not [kind for kinds in written for _, kind in kinds if kind.startswith("array")]
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 2, 2, 2]  # a repeated id meets itself
    assert all(r["n"] >= 4_096 and r["is_shifted"] is not None for r in rows)


@pytest.mark.parametrize("step", [0.84, 1.0, 1.19])
def test_reading_between_samples(step):
    x = np.random.default_rng(3).normal(size=K.READ_BLOCK + 700)
    cutoff = K.ROLL_OFF * min(1.0, 1.0 / step)
    got = K._read_at(x, step, len(x))
    for i in (0, 5, 699, K.READ_BLOCK - 1, K.READ_BLOCK, len(x) - 1):
        near = np.arange(max(0, int(i * step) - 20), min(len(x), int(i * step) + 20))
        wanted = (K.windowed_sinc((near - i * step) * cutoff) * cutoff * x[near]).sum() if (
            i * step < len(x)) else 0.0
        assert abs(got[i] - wanted) < 1e-10


def test_reading_takes_few_sines(monkeypatch):
    """Four for a block, not two for every tap."""
    seen = []
    sinc, sin = np.sinc, np.sin
    monkeypatch.setattr(np, "sinc", lambda x: seen.append("sinc") or sinc(x))
    monkeypatch.setattr(np, "sin", lambda x: seen.append("sin") or sin(x))
    K._read_at(np.ones(1_000), 1.1, 1_000)
    assert seen == ["sin", "sin"]


def test_learning_languages_holds_no_matrix_of_all_texts():
    rng = np.random.default_rng(4)
    texts = ["".join(map(chr, rng.integers(97, 122, 400))) for _ in range(1_200)]
    labels = ["a" if i % 2 else "b" for i in range(1_200)]
    tracemalloc.start()
    try:
        model = langid.solve(texts, labels, 20, 0.1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.codes) > 5_000 and peak < 4 * len(model.codes) * 1_000


def test_few_edges_are_joined_in_one_task(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pairs = [tuple(map(int, p)) for p in rng.integers(0, 900, (700, 2))]
    pairs += [(i, i + 1) for i in range(2_000, 2_060)] + [(5_000, 5_000)]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    written, names = common.written, []
    monkeypatch.setattr(common, "written", lambda df, name: names.append(name) or written(df, name))
    few = {r["id"]: r["component"] for r in common.components(edges).collect()}
    assert names == ["edges", "components"]
    monkeypatch.setattr(common, "FEW_EDGES", 0)
    many = {r["id"]: r["component"] for r in common.components(edges).collect()}
    assert few == many and few[2_060] == 2_000 and 5_000 not in few


def test_an_idle_encoder_forgets():
    """A worker lives on after a stage; what it remembers must not lie beside later stages."""
    encoder = tokens.Encoder(tokens.default_path())
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(50)) for i in range(40)])
    data, offsets = np.frombuffer(texts.buffers()[2], np.uint8), np.frombuffer(
        texts.buffers()[1], np.int32).astype(np.int64)
    ids, at = encoder.encode(data, offsets, 2)
    assert len(encoder.memory.known) > 1_000
    encoder.forget_later(0.2)
    for _ in range(100):
        if not encoder.memory.known:
            break
        time.sleep(0.1)
    assert not encoder.memory.known and not len(encoder.memory.pools[0])
    again, places = encoder.encode(data, offsets, 2)
    assert again.tolist() == ids.tolist() and places.tolist() == at.tolist()
    encoder.forget_later(0.2)  # watched anew
    time.sleep(1)
    assert not encoder.memory.known


def test_words_are_encoded_once_whatever_marks_follow(monkeypatch):
    """Of words and the marks after them, the parts to encode are the sum and not the product."""
    encoder, encoded = tokens.Encoder(tokens.default_path()), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts, bare=False: (
        encoded.extend([] if bare else texts) or whole(texts, bare)))
    words = [a + b for a in ("lä", "the", "ство", "qué") for b in ("tion", "rà", "nd", "ou", "st")]
    marks = [",", ".", ";", "!!", "?", ":", ",###", ".%%%", "$$$", ")"]
    text = " ".join(w + m for w in words for m in marks)
    data = np.frombuffer(text.encode(), np.uint8)
    ids, _ = encoder.encode(data, np.array([0, len(data)]), 2)
    assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert len(encoder.memory.known) <= len(words) + len(marks) + 1
    assert not any(c.isalpha() for t in encoded for c in t)  # words skip the pre-tokenizer


def test_an_encoder_of_a_worker_is_watched(monkeypatch):
    held = {}
    monkeypatch.setattr(tokens, "worker_state", lambda key, make: held.setdefault(key, make()))
    list(tokens.encoded(pa.array(["some words of a text", None]), tokens.default_path(), 2, 1_000))
    encoder, = held.values()
    assert encoder.watched and encoder.memory.limit == 1_000 and encoder.memory.known


def test_a_crowd_below_the_threshold_gives_no_pairs(spark, monkeypatch):
    """Texts of one template that are not linked share bands; rows grow with them, not pairs."""
    def rows(n):
        return [(i, " ".join([f"t{j}" for j in range(120)] + [f"p{i}y{j}" for j in range(22)]))
                for i in range(n)]

    made, written = [], minhash.written

    def counted(df, name):
        out = written(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "written", counted)
    monkeypatch.setattr(minhash, "BAND_PART", 100)
    n = 400
    found = rows(n) + [(9_000, rows(n)[7][1] + " more"), (9_001, rows(n)[300][1] + " words")]
    df = spark.createDataFrame(found, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in minhash.near_duplicates(df).collect())
    assert got == [(i, i) for i in range(n)] + [(9_000, 7), (9_001, 300)]
    # of a band 1 lead with each member, and at most 32 members with each other
    assert sum(made) < 32 * (n + 2) + 32 * 32 * 16 and max(made) < 20 * n


def test_spanning_forest_of_a_crowd():
    rng = np.random.default_rng(6)
    for two in (False, True):
        sets = [np.unique(rng.integers(0, 40, rng.integers(20, 60))).astype(np.uint64) for _ in range(60)]
        ids, side = np.arange(60) + 100, rng.integers(0, 2, 60) if two else np.zeros(60, np.int64)
        label = rng.integers(0, 50, 60)
        sketch = np.zeros((60, 4), np.int64)
        edges = minhash.spanning(ids, side, label, sketch, sets, 0.6, 0)

        def like(i, j):
            both = len(np.intersect1d(sets[i], sets[j]))
            return both / (len(sets[i]) + len(sets[j]) - both) >= 0.6

        def merged(pairs):
            own = label.copy()
            for i, j in pairs:
                own[own == own[j]] = own[i]
            return {tuple(np.flatnonzero(own == c)) for c in np.unique(own)}

        every = [(i, j) for i in range(60) for j in range(i + 1, 60)
                 if like(i, j) and (not two or side[i] != side[j])]
        given = [(a - 100, b - 100) for a, b in edges]
        assert every and set(given) <= set(every) and merged(given) == merged(every)
        assert len(edges) < 60
        sketch[::2] = -1  # 128 places differ
        apart = minhash.spanning(ids, side, label, sketch, sets, 0.6, 100)
        assert all((a - b) % 2 == 0 for a, b in apart)


def odd_tree(folder):
    clip = wav([1, 2, 3])
    for name in ("a/x.wav", "a/_x.wav", "a/.x.wav", "_a/y.wav", "b/_k=1/z.wav", "b/empty.wav",
                 "b/_metadata/m.wav", "b/other.txt", "b/sp ace %41/c d%20.wav", "b/é.wav", "b/c.WAV",
                 "b/_common_metadata.wav", "b/x.wav._COPYING_", "c/{1}.wav", "c/deep/er/[2].wav"):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"" if "empty" in name else clip)
    return clip


@pytest.mark.parametrize("below, pattern", [
    ("", "*.wav"), ("", "*.{wav,txt}"), ("", "[!a-c]*.wav"), ("", "?.wav"), ("", "*"), ("[ab]", "*.wav"),
    ("{a,c}/*", "*.wav"), ("a/_x.wav", "*.wav"), ("a/x.wav", "*.wav"), ("a/x.wav", "*.txt"),
    ("_a", "*.wav"), (("a", "", "_a"), "*.wav")])
def test_scans_find_in_tasks_what_the_file_source_finds(spark, tmp_path, below, pattern):
    """``wav_roundtrip`` and ``wav_header_files``: the driver lists nothing, whatever the rule."""
    clip = odd_tree(tmp_path)
    roots = [f"{tmp_path}/{b}" for b in ([below] if isinstance(below, str) else below)]
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", pattern).load(roots)
    wanted = sorted((r.path, r.length) for r in source.select("path", "length").collect())
    clips, paths = scan.scan_clips(spark, roots, pattern), scan.scan_paths(spark, roots, pattern)
    for df in (clips, paths):
        assert "binaryfile" not in plan_of(df).lower()
    rows = clips.collect()
    assert sorted((r.path, r.length) for r in rows) == wanted
    assert all(bytes(r.content) == clip and r.load_error is None for r in rows)
    assert clips.columns == ["path", "length", "content", "load_error"]
    assert sorted(r.wav_file for r in paths.collect()) == [p for p, _ in wanted]


def test_a_missing_root_raises_as_before(spark, tmp_path):
    for root in (f"{tmp_path}/none", f"{tmp_path}/*.none"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            scan.scan_clips(spark, root)


def test_headers_of_many_files_are_dealt_to_tasks(spark, tmp_path):
    """Not by the splits of a file source, a task for 32 small files."""
    for i in range(400):
        (tmp_path / f"{i}.wav").write_bytes(wav([i]))
    names = scan.scan_paths(spark, str(tmp_path), path_col="path")
    assert names.rdd.getNumPartitions() <= 4
    heads = scan_header_files(dealt(names))
    assert heads.rdd.getNumPartitions() <= 4 and heads.filter("num_frames = 1").count() == 400
