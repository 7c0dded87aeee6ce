"""Class labels from clip file names, one rule set per corpus.

Each corpus rule returns two columns, ``gender`` and ``emotion``; the label is
composed of them in a second step. A name that does not follow its rule raises
in ``strict`` mode and gives NULL in ``quarantine`` mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.functions.paths import base_name, parent_name

# Class vocabulary and the neutral code of every corpus.
NEUTRAL = "neutral"
NON_NEUTRAL = "non-neutral"
MALE = "male"
FEMALE = "female"
BAVED_NEUTRAL = "1"
EMOVO_NEUTRAL = "neu"
RAVDESS_NEUTRAL = "01"
IEMOCAP_NEUTRAL = "neu"
IEMOCAP_UNDECIDED = "xxx"
MAX_SECONDS = 15.0

MODES = ("strict", "quarantine")


def required(value: Column, path: Column, what: str, mode: str) -> Column:
    """``value``, or an error naming the path when it is NULL and the mode is strict."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == "quarantine":
        return value
    message = F.concat(F.lit(f"no {what} in clip name: "), F.coalesce(path, F.lit("NULL")))
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(message))


def binary_emotion(code: Column, neutral_code: str) -> Column:
    return F.when(code == neutral_code, NEUTRAL).when(code.isNotNull(), NON_NEUTRAL)


def compose_label(emotion: Column, gender: Column) -> Column:
    """``neutral`` or ``<emotion>-<gender>``; NULL when a part is missing."""
    return F.when(gender.isNotNull(), F.when(emotion == NEUTRAL, emotion).otherwise(
        F.concat(emotion, F.lit("-"), gender)))


def suffix_label(path: Column) -> Column:
    """Text after the last ``_`` of the whole path with every ``.wav`` removed."""
    return F.substring_index(F.replace(path, F.lit(".wav"), F.lit("")), "_", -1)


def baved_fields(path: Column, mode: str = "strict") -> tuple[Column, Column]:
    parts = F.split(base_name(path), "-")
    raw = required(F.get(parts, 1), path, "gender", mode)
    code = required(F.get(parts, 4), path, "emotion level", mode)
    gender = F.when(raw == "m", MALE).when(raw == "f", FEMALE).otherwise(raw)
    return gender, binary_emotion(code, BAVED_NEUTRAL)


def emovo_fields(path: Column, mode: str = "strict") -> tuple[Column, Column]:
    parts = F.split(base_name(path), "-")
    raw = required(F.get(parts, 1), path, "gender", mode)
    gender = F.when(raw.startswith("m"), MALE).when(raw.startswith("f"), FEMALE).otherwise(raw)
    return gender, binary_emotion(F.get(parts, 0), EMOVO_NEUTRAL)


def ravdess_fields(path: Column, mode: str = "strict") -> tuple[Column, Column]:
    parts = F.split(base_name(path), "-")
    number = F.split(F.element_at(parts, -1), r"\.")[0].try_cast("int")
    actor = required(number, path, "actor number", mode)
    code = required(F.get(parts, 2), path, "emotion code", mode)
    gender = F.when(actor % 2 == 0, FEMALE).when(actor.isNotNull(), MALE)
    return gender, binary_emotion(code, RAVDESS_NEUTRAL)


def iemocap_turn(path: Column) -> Column:
    """Turn name: the base name up to its first dot."""
    return F.split(base_name(path), r"\.")[0]


def iemocap_session(path: Column, mode: str = "strict") -> Column:
    first = F.split(iemocap_turn(path), "_")[0]
    number = required(F.substring(first, 4, 2).try_cast("int"), path, "session number", mode)
    return F.concat(F.lit("Session"), number.cast("string"))


def iemocap_dialog(path: Column) -> Column:
    return parent_name(path)


def iemocap_fields(path: Column, emotion_raw: Column,
                   mode: str = "strict") -> tuple[Column, Column]:
    last = F.element_at(F.split(iemocap_turn(path), "_"), -1)
    raw = required(F.nullif(F.substring(last, 1, 1), F.lit("")), path, "gender letter", mode)
    gender = F.when(raw == "F", FEMALE).when(raw == "M", MALE).otherwise(raw)
    return gender, binary_emotion(emotion_raw, IEMOCAP_NEUTRAL)


# Corpus folder name -> (gender, emotion) rule. The split corpus is not here: its
# names hold the label itself.
SPLIT_CORPUS = "CORAA_SER"
CORPUS_RULES = {"BAVED": baved_fields, "EMOVO": emovo_fields, "RAVDESS": ravdess_fields}
CORPORA = (SPLIT_CORPUS, *CORPUS_RULES)


def with_label(df: DataFrame, gender: Column, emotion: Column) -> DataFrame:
    """Add ``gender``, ``emotion`` and the ``label`` composed of them."""
    parts = df.withColumns({"gender": gender, "emotion": emotion})
    return parts.withColumn("label", compose_label(F.col("emotion"), F.col("gender")))
