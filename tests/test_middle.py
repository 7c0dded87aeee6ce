"""Medians by narrower brackets, hot keys, networks kept by workers, heads of odd files."""

import os
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipframe.operators import model, stats
from clipframe.session import hot_join, hot_keys, new_folder, scratch, side_table
from clipframe.sources.scan import materialise
from clipframe.sources.wav import _is_short, scan_headers, with_headers
from conftest import wav


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_medians_by_narrower_brackets(spark, monkeypatch, keys):
    monkeypatch.setattr(stats, "MIDDLE", 3)
    monkeypatch.setattr(stats, "BRACKET", 0.2)
    monkeypatch.setattr(stats, "ROUNDS", 30)
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=3_001), "b": rng.integers(0, 4, 2_000).astype(float),
              None: np.full(500, 7.5), "c": np.array([1.0, 2.0]), "d": rng.normal(size=4_000) ** 9}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("e", None)]
    df = spark.createDataFrame(rows, "k string, duration_s double").repartition(5)
    got = stats.duration_stats(df, keys=keys).collect()
    if keys:
        want = {k: np.median(x) for k, x in groups.items()} | {"e": None}
        assert {r.k: r.median_s for r in got} == want
    else:
        assert got[0].median_s == np.median([v for _, v in rows if v is not None])


def test_middle_of_many_distinct_values(spark, monkeypatch):
    n = 3_000_001
    df = spark.range(n).select((F.col("id") * 7919 % n / 8).alias("duration_s"))
    monkeypatch.setattr(stats, "MIDDLE", 500)
    seen = []
    median_near = stats._median_near

    def watched(near, names, name):
        low, high = near.select("__b").first()[0]
        seen.append(near.filter(F.col("__v").between(low, high)).count())
        return median_near(near, names, name)

    monkeypatch.setattr(stats, "_median_near", watched)
    assert stats.duration_stats(df).first().median_s == (n // 2) / 8
    assert seen[0] <= 500


def test_hot_keys(spark):
    df = spark.range(20_000).selectExpr(
        "if(id % 2 = 0, 'hot', if(id % 20 = 1, 'warm', concat('k', id))) as k", "id as v")
    found = sorted(hot_keys(df, ["k"]).values())
    assert found == pytest.approx([0.05, 0.5], abs=0.01)
    assert hot_keys(df.filter("k not in ('hot', 'warm')"), ["k"]) == {}
    assert hot_keys(df.limit(0), ["k"]) == {}


def test_one_turn_with_half_of_the_rows(spark):
    rows = spark.range(40_000).selectExpr(
        "if(id % 2 = 0, 'hot', concat('k', id % 5000)) as k", "concat('clip', id) as path",
        "if(id % 10 = 3, null, id) as v").withColumn("k", F.expr("if(v is null, null, k)"))
    side = spark.range(5_000).selectExpr("concat('k', id) as k", "id as x").union(
        spark.createDataFrame([("hot", -1)], "k string, x long"))
    before = {name: spark.conf.get(name) for name in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled",
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.enabled")}
    try:
        for name, value in zip(before, ("16", "false", "-1", "false")):
            spark.conf.set(name, value)
        joined = hot_join(rows, side, ["k"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 16 and max(sizes) <= 3 * np.median(sizes)
        plain = rows.join(side, "k", "left")
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))
        assert hot_join(rows, side, ["k"], "inner").count() == plain.filter("x is not null").count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_side_tables_are_measured_first(spark):
    wide = spark.range(40).selectExpr("id", "repeat('x', 1000) as t")
    assert side_table(wide, max_bytes=39_999)[1] is False
    df, fits = side_table(wide, max_bytes=40_000)
    assert fits and df.count() == 40
    assert side_table(wide, 39)[1] is False and side_table(wide.select("id"), 40)[1] is True


def test_a_worker_keeps_one_version_of_a_network(spark, tmp_path):
    batches = spark.range(48).selectExpr(
        "array(id) as id", "array(array(cast(id as float), 1f)) as input_values",
        "array(array(1, 1)) as attention_mask").repartition(24)

    def network(loads, factor):
        def make():
            with open(f"{tmp_path}/{loads}", "a") as handle:
                handle.write(f"{os.getpid()}\n")
            return lambda values, mask: values * factor
        return make

    for loads, version, factor in (("one", "1", 1.0), ("same", "1", 1.0), ("two", "2", -1.0), ("none", None, 1.0)):
        got = model.score_batches(batches, network(loads, factor), "id", version).collect()
        assert {r.id: r.label_id for r in got} == {
            i: int(i * factor < factor) for i in range(48)}
    counts = {name: (tmp_path / name).read_text().split() if (tmp_path / name).exists() else []
              for name in ("one", "same", "two", "none")}
    assert len(counts["one"]) == len(set(counts["one"])) <= 8 and len(counts["none"]) == 24
    assert not set(counts["same"]) & set(counts["one"])
    assert len(counts["two"]) == len(set(counts["two"]))


def with_chunks(data: bytes, *chunks: tuple[bytes, bytes]) -> bytes:
    extra = b"".join(n + struct.pack("<I", len(b)) + b + b"\0" * (len(b) % 2) for n, b in chunks)
    return data[:36] + extra + data[36:]


def test_heads_of_odd_files(spark, wav_cases):
    plain = wav_cases["mono16"]
    rng = random.Random(2)
    files = {**wav_cases, "odd_chunk": with_chunks(plain, (b"LIST", b"data" * 7 + b"x")),
             "many": with_chunks(plain, *[(b"note", b"y" * rng.randrange(9)) for _ in range(12)]),
             "too_many": with_chunks(plain, *[(b"note", b"") for _ in range(20)]),
             "long": with_chunks(plain, (b"LIST", b"data" * 500)),
             "edge": with_chunks(plain, (b"LIST", b"z" * 456)),
             "over_the_edge": with_chunks(plain, (b"LIST", b"z" * 462)),
             "false_size": plain[:40] + b"\xff" * 4 + plain[44:], "short": b"RIFF\0\0\0\0WAVE"}
    df = spark.createDataFrame([(n, bytearray(d)) for n, d in files.items()] + [("null", None)],
                               "path string, content binary")
    got = {r.path: tuple(r)[1:] for r in scan_headers(df).collect()}
    assert got == {r.path: tuple(r)[2:] for r in with_headers(df).collect()}
    good = {n for n, h in got.items() if h[:4] == (4_000, 16_000, 1, 16)}
    assert {"odd_chunk", "many", "too_many", "long", "edge", "over_the_edge", "false_size"} <= good
    short = {r.path: r.s for r in df.select("path", _is_short(F.col("content")).alias("s")).collect()}
    assert short["odd_chunk"] and short["many"] and short["edge"] and short["list_chunk"]
    assert not (short["too_many"] or short["long"] or short["over_the_edge"] or short["junk"])


def test_a_scope_removes_its_tables(spark, tmp_path):
    before = materialise(spark.range(3))
    with scratch(spark):
        inner = materialise(spark.range(5))
        path = new_folder(spark, "unused")
        with pytest.raises(RuntimeError), scratch(spark):
            deeper = materialise(spark.range(7)).inputFiles()[0].removeprefix("file:")
            raise RuntimeError
        assert not os.path.exists(os.path.dirname(deeper.replace("//", "/")))
        inner.write.parquet(str(tmp_path / "kept"))
        files = [f.removeprefix("file:").replace("//", "/") for f in inner.inputFiles()]
        assert all(map(os.path.exists, files))
    assert not any(map(os.path.exists, files)) and not os.path.exists(path)
    assert before.count() == 3 and spark.read.parquet(str(tmp_path / "kept")).count() == 5
