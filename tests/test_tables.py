"""Numbers, batches, dictionary, statistics, joins and scores on small tables."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from clipframe import session
from clipframe.functions.scores import argmax, softmax
from clipframe.operators import batching, encode, joins, scoring, stats


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- batches -------------------------------------------------------------

@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_row_numbers(spark, partitions):
    keys = [f"k{i:05d}" for i in range(500)]
    random.Random(5).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(partitions)
    out = {r.k: r.n for r in batching.number_rows(df, ["k"], "n", partitions).collect()}
    assert out == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("options,expected", [
    ({}, [5, 5, 4, 4]), ({"multiple_of": 4}, [8, 8, 4, 4]),
    ({"padding": "max_length", "max_length": 4}, [4, 5, 4, 4]),
    ({"padding": False}, [3, 5, 4, 1]),
    ({"padding": "max_length", "max_length": 10, "multiple_of": 8}, [16, 16, 16, 16])])
def test_pad_targets(spark, options, expected):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 4), ("d", 1)], "k string, n int")
    batched = batching.assign_batches(df, ["k"], 2)
    out = batching.pad_target(batched, F.col("n"), **options).orderBy("k").collect()
    assert [r.pad_to for r in out] == expected
    assert [(r.batch_id, r.pos) for r in out] == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_bad_padding(spark):
    df = spark.createDataFrame([(0, 3)], "batch_id int, n int")
    with pytest.raises(ValueError):
        batching.pad_target(df, F.col("n"), "max_length")
    with pytest.raises(ValueError):
        batching.pad_target(df, F.col("n"), "shortest")


# --- dictionary and lookups ----------------------------------------------

LABELS = ["non-neutral-male", "neutral", "non-neutral-female", "neutral", None]


@pytest.mark.parametrize("max_rows", [50_000, 2])
def test_dictionary_and_lookups(spark, monkeypatch, max_rows):
    """With a bound of two rows every lookup takes the shuffled way."""
    monkeypatch.setattr(session.side_table, "__defaults__", (max_rows,))
    monkeypatch.setattr(session.lookup_join, "__defaults__", ("left", max_rows))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LABELS)], "i int, label string")
    dictionary = encode.label_dictionary(df)
    assert {r.label: r.label_id for r in dictionary.collect()} == {
        "neutral": 0, "non-neutral-female": 1, "non-neutral-male": 2}
    more = df.union(spark.createDataFrame([(9, "angry")], df.schema))
    coded = encode.encode_labels(more, dictionary)
    assert {r.i: (r.label_id, r.label_error) for r in coded.collect()} == {
        0: (2, None), 1: (0, None), 2: (1, None), 3: (0, None),
        4: (None, "unknown label"), 9: (None, "unknown label")}
    back = encode.decode_labels(coded.select("i", "label_id"), dictionary)
    assert {r.i: r.label for r in back.collect()} == {**dict(enumerate(LABELS)), 9: None}


# --- statistics ----------------------------------------------------------

def test_golden_durations(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "duration_s double")
    r = stats.duration_stats(df).first()
    assert (r.n, r.min_s, r.max_s, r.mean_s, r.median_s) == (4, 1, 10, 4.25, 3)
    assert r.std_s == pytest.approx(3.491060010942235)
    assert r.total_minutes == pytest.approx(17 / 60)


def test_durations_of_nothing(spark):
    r = stats.duration_stats(spark.createDataFrame([], "duration_s double")).first()
    assert r.n == 0 and r.median_s is None and r.mean_s is None


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1_001, 30_000])
def test_median_is_exact(spark, size):
    rng = random.Random(size)
    values = [float(rng.choice([1.0, 1.0, rng.random() * 3, rng.expovariate(1)]))
              for _ in range(size)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, duration_s double")
    assert stats.duration_stats(df, keys=["g"]).first().median_s == statistics.median(values)
    rough = stats.duration_stats(df, exact=False).first().median_s
    assert min(values) <= rough <= max(values)


def test_rows_without_group_are_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0), ("b", None)],
                               "g string, duration_s double")
    got = {r.g: (r.n, r.median_s) for r in stats.duration_stats(df, keys=["g"]).collect()}
    assert got == {None: (2, 1.5), "a": (1, 5.0), "b": (0, None)}


def test_median_with_one_value_holding_most_rows(spark):
    values = [5.0] * 20_000 + [float(i) for i in range(9_000)]
    df = spark.createDataFrame([(v,) for v in values], "duration_s double")
    assert stats.duration_stats(df).first().median_s == statistics.median(values)


def test_formats_and_audit(spark):
    df = spark.createDataFrame([(16_000, 1, 50), (8_000, 1, 10), (16_000, 2, 11), (None,) * 3],
                               "sample_rate int, num_channels int, num_frames bigint")
    assert set(rows_of(stats.distinct_values(df.na.drop(), ["sample_rate", "num_channels"]))) == {
        ("sample_rate", 16_000, 2), ("sample_rate", 8_000, 1), ("num_channels", 1, 2),
        ("num_channels", 2, 1)}
    assert rows_of(stats.audit_headers(df)) == [(4, 1, 1, 1, 1)]


def test_silent_clip_makes_the_mean_infinite(spark):
    df = spark.createDataFrame([(-10.0,), (float("-inf"),)], "dbfs double")
    assert stats.mean_level(df).first().mean_dbfs == float("-inf")
    assert stats.mean_level(df.filter("dbfs > -99")).first().mean_dbfs == -10.0


def test_union_keeps_rows(spark):
    a = spark.createDataFrame([("x", "n"), ("x", "n")], "wav_file string, label string")
    b = spark.createDataFrame([("m", "y", "f")], "label string, wav_file string, gender string")
    union = stats.union_all({"A": a, "B": b})
    assert sorted(rows_of(union)) == [("A", "x", "n"), ("A", "x", "n"), ("B", "y", "m")]
    before = stats.corpus_counts(union)
    assert sorted(rows_of(stats.assert_counts(before, union))) == [("A", 2), ("B", 1)]
    with pytest.raises(Exception, match="row count changed for B"):
        stats.assert_counts(before, union.filter("corpus = 'A'")).collect()


# --- joins and scores ----------------------------------------------------

def pairs(spark, rows):
    return spark.createDataFrame(rows, "wav_file string, label string")


def test_pairing(spark):
    pred = pairs(spark, [("a", "x"), ("b", "y"), ("d", "x"), ("d", "x")])
    truth = pairs(spark, [("a", "x"), ("c", "y"), ("d", "x")])
    report = {r.wav_file: r.status for r in
              joins.pair_predictions(pred, truth, how="report").collect()}
    assert report == {"a": "both", "b": "only_pred", "c": "only_truth", "d": "duplicate"}
    assert rows_of(joins.pair_predictions(pred, truth, how="inner")) == [("a", "x", "x", "both")]
    with pytest.raises(Exception, match="do not match"):
        scoring.macro_f1(joins.pair_predictions(pred, truth)).collect()
    with pytest.raises(ValueError):
        joins.pair_predictions(pred, truth, how="outer")


def test_missing_annotation_files(spark):
    clips = spark.createDataFrame([("S1", "a"), ("S1", "a"), ("S2", "b")], "session string, dialog string")
    files = spark.createDataFrame([("S1", "a")], "session string, dialog string")
    assert rows_of(joins.missing_annotations(clips, files, ["session", "dialog"])) == [("S2", "b")]


def test_golden_macro_f1(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")],
                               "truth string, pred string")
    r = scoring.macro_f1(df).first()
    assert r.macro_f1 == pytest.approx((2 / 3 + 1 / 2 + 0) / 3)
    assert (r.n_classes, r.n_rows) == (3, 4)
    unseen = df.union(spark.createDataFrame([("a", "z")], df.schema))
    assert scoring.macro_f1(unseen).first().n_classes == 4


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, 0.0, -1000.0],)], "x array<double>")
    out = df.select(softmax(F.col("x")).alias("s"), argmax(F.col("x")).alias("a")).collect()
    assert [r.a for r in out] == [1, 0]
    assert out[0].s == pytest.approx([0.063379, 0.46831, 0.46831], abs=1e-5)
    assert out[1].s == [1.0, 0.0, 0.0]


def brute_stop(values, patience):
    best, waited = None, 0
    for epoch, value in enumerate(values):
        if best is None or value > best:
            best, waited = value, 0
        else:
            waited += 1
        if waited >= patience:
            return epoch
    return None


def test_best_epoch_and_early_stop(spark):
    rng = random.Random(11)
    runs = {f"r{i}": [round(rng.random(), 1) for _ in range(12)] for i in range(20)}
    runs["never"] = [i / 10 for i in range(12)]
    df = spark.createDataFrame([(r, e, v) for r, vs in runs.items() for e, v in enumerate(vs)],
                               "run string, epoch int, value double").repartition(5)
    best = {r.run: (r.best_epoch, r.best_value) for r in scoring.best_epoch(df).collect()}
    assert best == {r: (vs.index(max(vs)), max(vs)) for r, vs in runs.items()}
    stop = {r.run: r.stop_epoch for r in scoring.early_stop(df, 4).collect()}
    assert stop == {r: brute_stop(vs, 4) for r, vs in runs.items()}
    lowest = {r.run: r.best_epoch for r in
              scoring.best_epoch(df, greater_is_better=False).collect()}
    assert lowest == {r: vs.index(min(vs)) for r, vs in runs.items()}
