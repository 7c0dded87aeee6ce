"""Clips made from the given tables: file names, annotation lines and WAV bytes.

The tables hold no audio, so names are composed from ids and a document's whole
text, as bytes, is the PCM data of one clip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.session import spread
from clipframe.sources.wav import wav_bytes

# Emotion codes by event_id % 7 and event types that stand for emotions.
EMOVO_CODES = ("neu", "dis", "gio", "pau", "rab", "sor", "tri")
EMOTION_BY_TYPE = {"click": "neu", "view": "hap", "purchase": "exc", "signup": "sad",
                   "error": "xxx"}
LABEL_BY_LANG = {"en": "neutral", "fr": "non-neutral-female"}
OTHER_LABEL = "non-neutral-male"

# WAV format (rate, channels, bits) of a document by its language.
FORMAT_BY_LANG = {"fr": (22_050, 1, 8), "de": (8_000, 2, 16), "es": (16_000, 1, 24)}
OTHER_FORMAT = (16_000, 1, 16)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: str, values: dict, other) -> Column:
    out = None
    for key, value in values.items():
        out = (F.when(F.col(column) == key, value) if out is None
               else out.when(F.col(column) == key, value))
    return out if other is None else out.otherwise(other)


def coraa_paths(documents: DataFrame) -> DataFrame:
    label = _choose("lang", LABEL_BY_LANG, OTHER_LABEL)
    return documents.select(F.concat(
        F.lit("data/train/CORAA_SER/"), F.col("lang"), F.lit("/clip_"), F.col("doc_id"),
        F.lit("_"), label, F.lit(".wav")).alias("wav_file"))


def document_paths(documents: DataFrame) -> DataFrame:
    """Two names a document, in two corpora; those of French ones in the second are cut
    short after the gender and have no label."""
    tail = F.when(F.col("lang") == "fr", "21").otherwise(
        F.concat_ws("-", F.lit("21-0"), F.col("doc_id") % 3, "doc_id"))
    second = documents.select(F.concat(F.lit("data/train/BAVED/"), "lang", F.lit("/"), "doc_id",
                                       F.lit("-m-"), tail, F.lit(".wav")).alias("wav_file"))
    return coraa_paths(documents).unionByName(second)


def baved_paths(events: DataFrame) -> DataFrame:
    side = F.when(F.col("user_id") % 7 < 3, "m").when(F.col("user_id") % 7 < 6, "f").otherwise("x")
    return events.select(F.concat(
        F.lit("data/train/BAVED/"), F.col("event_type"), F.lit("/"), F.col("user_id"), F.lit("-"),
        side, F.lit("-21-"), F.col("event_id") % 5, F.lit("-"), F.col("event_id") % 3, F.lit("-"),
        F.col("event_id"), F.lit(".wav")).alias("wav_file"))


def emovo_paths(events: DataFrame) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in EMOVO_CODES]),
                        (F.col("event_id") % 7 + 1).cast("int"))
    side = F.when(F.col("user_id") % 2 == 0, "f").otherwise("m")
    return events.select(F.concat(
        F.lit("data/train/EMOVO/"), F.col("event_type"), F.lit("/"), code, F.lit("-"), side,
        F.col("user_id") % 3 + 1, F.lit("-b"), F.col("event_id"), F.lit(".wav")).alias("wav_file"))


def ravdess_paths(events: DataFrame) -> DataFrame:
    return events.select(F.concat(
        F.lit("data/train/RAVDESS/e"), F.col("event_id"), F.lit("/03-01-0"),
        F.col("event_id") % 8 + 1, F.lit("-01-02-01-"),
        F.lpad((F.col("user_id") % 24 + 1).cast("string"), 2, "0"),
        F.lit(".wav")).alias("wav_file"))


def corpus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(corpus, wav_file)`` of all four corpora."""
    documents = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events")
    parts = {"CORAA_SER": coraa_paths(documents), "BAVED": baved_paths(events),
             "EMOVO": emovo_paths(events), "RAVDESS": ravdess_paths(events)}
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("corpus"), "wav_file")
        out = part if out is None else out.unionByName(part)
    return out


def _dialog() -> tuple[Column, Column, Column]:
    """Session number, dialog and turn of an event."""
    session = (F.col("event_id") % 5 + 1).cast("string")
    side = F.when(F.col("user_id") % 2 == 0, "F").otherwise("M")
    dialog = F.concat(F.lit("Ses0"), session, side, F.lit("_impro"),
                      F.lpad((F.col("user_id") % 30).cast("string"), 2, "0"))
    speaker = F.when(F.col("user_id") % 3 == 0, "F").otherwise("M")
    turn = F.concat(dialog, F.lit("_"), speaker, F.col("event_id").cast("string"))
    return session, dialog, turn


def dialog_clips(events: DataFrame) -> DataFrame:
    """``(wav_file, duration_s)``: the event value is the length in seconds."""
    session, dialog, turn = _dialog()
    return events.select(
        F.concat(F.lit("data/IEMOCAP/Session"), session, F.lit("/sentences/wav/"), dialog,
                 F.lit("/"), turn, F.lit(".wav")).alias("wav_file"),
        F.col("value").alias("duration_s"))


def dialog_lines(events: DataFrame) -> DataFrame:
    """Annotation lines ``(session, dialog, line_no, value)``: every turn is listed
    twice, first undecided, then with its emotion, and each has a heading."""
    session, dialog, turn = _dialog()
    emotion = _choose("event_type", EMOTION_BY_TYPE, None)
    tail = F.lit("\t[2.5000, 2.5000, 2.5000]")
    start = F.concat(F.lit("["), F.col("event_id"), F.lit(".0 - "), F.col("event_id") + 1,
                     F.lit(".5]\t"), turn, F.lit("\t"))
    lines = F.array(
        F.struct(F.lit(0).alias("line_no"), F.concat(start, F.lit("xxx"), tail).alias("value")),
        F.struct(F.lit(1).alias("line_no"), F.concat(start, emotion, tail).alias("value")),
        F.struct(F.lit(2).alias("line_no"), F.lit("C-E2:\tNeutral;\t()").alias("value")))
    return events.select(F.concat(F.lit("Session"), session).alias("session"),
                         dialog.alias("dialog"), F.explode(lines).alias("l")).select(
        "session", "dialog", "l.line_no", "l.value")


def document_wavs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, content)``: one WAV file per document, its text as PCM bytes."""
    spec = {k: F.struct(*[F.lit(x).cast("int").alias(n) for n, x in zip("rcb", v)])
            for k, v in {**FORMAT_BY_LANG, "": OTHER_FORMAT}.items()}
    other = spec.pop("")
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    documents = documents.withColumn("f", _choose("lang", spec, other))
    return documents.select("doc_id", "lang", wav_bytes(
        F.col("text").cast("binary"), F.col("f.r"), F.col("f.c"), F.col("f.b")).alias("content"))


def with_list_chunk(content: Column) -> Column:
    """The same file with a LIST chunk of odd size, so padded, before the data."""
    chunk = F.lit(bytearray(b"LIST\x05\x00\x00\x00INFOx\x00"))
    size = F.octet_length(content)
    return F.concat(F.substring(content, 1, 36), chunk, F.substring(content, F.lit(37), size))


def odd_wavs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(clip_id, content)``: of each document its clip, a silent one as long as its text,
    one without samples, and its text as it is."""
    wavs = document_wavs(spark, sf_dir)
    data = F.substring(F.col("content"), F.lit(45), F.octet_length("content"))
    mono = (F.lit(16_000), F.lit(1), F.lit(16))
    silent = F.unhex(F.repeat(F.lit("00"), F.octet_length(data)))
    kinds = F.array(F.col("content"), wav_bytes(silent, *mono), wav_bytes(F.lit(bytearray()), *mono),
                    data)
    return wavs.select("doc_id", F.posexplode(kinds).alias("kind", "content")).select(
        (F.col("doc_id") * 4 + F.col("kind")).alias("clip_id"), "content")


def class_logits(embedding: Column, classes: int = 10) -> Column:
    """Ten class scores: the sums over every tenth number of the whole vector."""
    def total(c: Column) -> Column:
        own = F.filter(embedding, lambda x, i: i % classes == c)
        return F.aggregate(own, F.lit(0.0), lambda acc, v: acc + v.cast("double"))

    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), total)


def daily_history(events: DataFrame) -> DataFrame:
    """Metric history ``(run, epoch, split, metric, value)``: a run per event type,
    an epoch per day, the mean event value as the metric."""
    day = F.datediff(F.col("ts"), F.lit("2024-01-01"))
    return events.groupBy(F.col("event_type").alias("run"), day.alias("epoch")).agg(
        F.round(F.avg("value"), 6).alias("value")).select(
        "run", "epoch", F.lit("eval").alias("split"), F.lit("f1").alias("metric"), "value")
