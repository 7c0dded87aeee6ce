"""Metadata tables, annotation text and in-memory rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_SCHEMA = "wav_file string, label string"
TEST_SCHEMA = "wav_file string"

# Fixed value: the annotation line format (turn and emotion between two
# bracketed fields, tab separated). (?d): only a newline ends a line.
ANNOTATION_PATTERN = r"(?d)\[.+\]\t(.+)\t(.+)\t\[.+\]"


def read_metadata(spark: SparkSession, path: str | Sequence[str],
                  schema: str = METADATA_SCHEMA) -> DataFrame:
    """CSV with a header row and doubled quotes, read with an explicit schema."""
    return (
        spark.read.option("header", "true").option("escape", '"')
        .schema(schema).csv([path] if isinstance(path, str) else list(path))
    )


def rows_to_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table from rows held by the caller (settings, label lists)."""
    return spark.createDataFrame(list(rows), schema)


def parse_annotation(line: Column) -> tuple[Column, Column]:
    """``(turn, emotion_raw)`` of an annotation line; empty strings for other lines."""
    return (F.regexp_extract(line, ANNOTATION_PATTERN, 1),
            F.regexp_extract(line, ANNOTATION_PATTERN, 2))


def annotation_turns(lines: DataFrame, keys: Sequence[str], order: Sequence[str],
                     line_col: str = "value") -> DataFrame:
    """One row per (keys, turn); a turn listed twice takes its last line.

    ``max_by`` combines on the map side, so a much-repeated turn costs one row
    per task. A plain substring test spares most other lines the pattern.
    """
    line = F.col(line_col)
    turn, emotion = parse_annotation(line)
    parsed = lines.filter(line.contains("]\t")).select(
        *keys, turn.alias("turn"), emotion.alias("emotion_raw"), *order)
    position = F.struct(*[F.col(c) for c in order])
    return parsed.filter(F.col("turn") != "").groupBy(*keys, "turn").agg(
        F.max_by("emotion_raw", position).alias("emotion_raw"))


def scan_annotations(spark: SparkSession, root: str) -> DataFrame:
    """Annotation lines below ``root`` with their place in the file.

    Adds ``session`` (a folder named ``Session<n>``), ``dialog`` (the file name
    without ``.txt``) and the line order: the offset of the file block and the
    row id, which grows within a block. Large files stay splittable.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
        .text(root)
        .select("value", F.col("_metadata.file_path").alias("file_path"),
                F.col("_metadata.file_block_start").alias("block_start"),
                F.monotonically_increasing_id().alias("line_id"))
    )
    return annotated(lines)


def annotated(files: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Add ``session`` and ``dialog`` by the path; only annotation files stay."""
    return files.withColumns({
        "session": F.regexp_extract(path_col, r"/(Session\d+)/dialog/EmoEvaluation/[^/]*$", 1),
        "dialog": F.regexp_extract(path_col, r"/([^/]*)\.txt$", 1),
    }).filter(F.col("session") != "")


def scan_annotation_files(spark: SparkSession, root: str) -> DataFrame:
    """``(session, dialog)`` of every annotation file; no line is read."""
    from clipframe.sources.scan import scan_paths

    files = scan_paths(spark, root, pattern="*.txt", path_col="file_path")
    return annotated(files).select("session", "dialog")
