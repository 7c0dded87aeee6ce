import pytest
from pyspark.sql import functions as F

from clipframe.functions import labels as L
from clipframe.functions import paths as P
from clipframe.plans.jobs import label_annotated, label_corpora
from clipframe.sources.tables import annotation_turns, parse_annotation

GOLDEN = [
    ("BAVED", "0-m-21-0-1-1.wav", "male", "neutral", "neutral"),
    ("BAVED", "0-f-21-0-2-1.wav", "female", "non-neutral", "non-neutral-female"),
    ("BAVED", "0-m-21-0-0-1.wav", "male", "non-neutral", "non-neutral-male"),
    ("BAVED", "0-x-21-0-2-1.wav", "x", "non-neutral", "non-neutral-x"),
    ("BAVED", "0-f-21-0-1.wav", "female", "non-neutral", "non-neutral-female"),
    ("EMOVO", "neu-f1-b1.wav", "female", "neutral", "neutral"),
    ("EMOVO", "rab-m2-l4.wav", "male", "non-neutral", "non-neutral-male"),
    ("RAVDESS", "03-01-01-01-01-01-12.wav", "female", "neutral", "neutral"),
    ("RAVDESS", "03-01-02-01-01-01-11.wav", "male", "non-neutral", "non-neutral-male"),
    ("RAVDESS", "03-01-06-01-02-01-24.wav", "female", "non-neutral", "non-neutral-female"),
    ("CORAA_SER", "a_1_neutral.wav", None, None, "neutral"),
    ("CORAA_SER", "a_1_non-neutral-male.wav", None, None, "non-neutral-male"),
    ("CORAA_SER", "plain.wav", None, None, "SER/plain"),
    ("CORAA_SER", "y_z.wav/a_non-neutral-male.wav", None, None, "non-neutral-male"),
]
BAD = [("BAVED", "0-m-21-0.wav"), ("RAVDESS", "03-01-06-01-02-01-xx.wav"),
       ("RAVDESS", "07.wav"), ("EMOVO", "neu.wav")]


def frame(spark, rows):
    data = [(c, f"d/train/{c}/{name}") for c, name in rows]
    return spark.createDataFrame(data, "corpus string, wav_file string")


@pytest.mark.parametrize("mode", L.MODES)
def test_golden_names(spark, mode):
    out = label_corpora(frame(spark, [g[:2] for g in GOLDEN]), mode).collect()
    got = {(r.corpus, r.wav_file): (r.gender, r.emotion, r.label) for r in out}
    assert got == {(c, f"d/train/{c}/{n}"): rest for c, n, *rest_ in GOLDEN
                   for rest in [tuple(rest_)]}


@pytest.mark.parametrize("corpus,name", BAD)
def test_bad_name_raises_in_strict_mode(spark, corpus, name):
    with pytest.raises(Exception, match="in clip name"):
        label_corpora(frame(spark, [(corpus, name)])).collect()


def test_bad_names_have_no_label_in_quarantine_mode(spark):
    out = label_corpora(frame(spark, BAD), "quarantine").collect()
    assert [r.label for r in out] == [None] * len(BAD)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        label_corpora(frame(spark, BAD), "lenient")


def test_paths(spark):
    rows = spark.createDataFrame(
        [("", "a/b.wav"), ("base", "a.wav"), ("base/", "a.wav"), ("base", "/a.wav")],
        "base string, path string")
    out = rows.select(P.join_path(F.col("base"), F.col("path")).alias("p")).collect()
    assert [r.p for r in out] == ["a/b.wav", "base/a.wav", "base/a.wav", "/a.wav"]
    names = rows.select(P.base_name(F.col("path")).alias("b"),
                        P.parent_name(F.col("path")).alias("d")).collect()
    assert [tuple(r) for r in names] == [("b.wav", "a"), ("a.wav", ""), ("a.wav", ""),
                                         ("a.wav", "")]


def test_duration_of_rate_zero_is_null(spark):
    rows = spark.createDataFrame([(8000, 16000), (5, 0)], "n bigint, r int")
    out = rows.select(P.duration_seconds(F.col("n"), F.col("r")).alias("d")).collect()
    assert [r.d for r in out] == [0.5, None]


LINES = [
    "[6.2901 - 8.2357]\tSes01F_impro01_F000\tneu\t[2.5000, 2.5000, 2.5000]",
    "[10.0 - 11.3]\tSes01F_impro01_F001\txxx\t[2.5000, 2.5000, 2.5000]",
    "[6.2901 - 8.2357] Ses01F_impro01_F000 neu [2.5]",
    "C-E2:\tNeutral;\t()",
    "[10.0 - 11.3]\tSes01F_impro01_F002\tneu\t[2.5]",
    "[10.0 - 11.3]\tSes01F_impro01_F002\tang\t[2.5]",
]


def turns(spark):
    rows = [("Session1", "Ses01F_impro01", i, line) for i, line in enumerate(LINES)]
    lines = spark.createDataFrame(rows, "session string, dialog string, n int, value string")
    return annotation_turns(lines, ["session", "dialog"], ["n"])


def test_annotation_lines(spark):
    rows = spark.createDataFrame([(line,) for line in LINES], "value string")
    out = rows.select(*parse_annotation(F.col("value"))).collect()
    assert [tuple(r) for r in out] == [
        ("Ses01F_impro01_F000", "neu"), ("Ses01F_impro01_F001", "xxx"), ("", ""), ("", ""),
        ("Ses01F_impro01_F002", "neu"), ("Ses01F_impro01_F002", "ang")]


def test_last_line_of_a_turn_wins(spark):
    got = {r.turn: r.emotion_raw for r in turns(spark).collect()}
    assert got == {"Ses01F_impro01_F000": "neu", "Ses01F_impro01_F001": "xxx",
                   "Ses01F_impro01_F002": "ang"}


def clips(spark, *rows):
    data = [(f"x/Ses01F_impro01/{name}.wav", seconds) for name, seconds in rows]
    return spark.createDataFrame(data, "wav_file string, duration_s double")


def test_annotated_labels_and_filters(spark):
    rows = clips(spark, ("Ses01F_impro01_F000", 15.0), ("Ses01F_impro01_F001", 1.0),
                 ("Ses01F_impro01_F002", 15.0001))
    out = label_annotated(rows, turns(spark)).collect()
    assert [(r.gender, r.emotion, r.label) for r in out] == [("female", "neutral", "neutral")]


def test_missing_annotation(spark):
    rows = clips(spark, ("Ses01F_impro01_M999", 1.0), ("Ses01F_impro01_F002", 2.0),
                 ("Sesxx_impro01_F002", 2.0))
    with pytest.raises(Exception, match="annotated emotion|session number"):
        label_annotated(rows, turns(spark)).collect()
    out = {r.wav_file.split("/")[-1]: r for r in
           label_annotated(rows, turns(spark), "quarantine").collect()}
    assert out["Ses01F_impro01_M999.wav"].error == "no annotated emotion"
    assert out["Sesxx_impro01_F002.wav"].error == "no session number in clip name"
    assert out["Ses01F_impro01_F002.wav"].label == "non-neutral-female"
    assert out["Ses01F_impro01_F002.wav"].error is None
