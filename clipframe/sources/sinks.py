"""CSV, clip, model and metric sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.util import MLWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.functions.paths import base_name
from clipframe.sources import commits
from clipframe.sources.files import Files, qualified
from clipframe.sources.scan import materialise


METRICS = "run string, epoch int, split string, metric string, value double"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header row, no index, doubled quotes, bare empty fields; overwrites.

    A folder of part files. ``single_file`` is for small exports only.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", "true").option("escape", '"')
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_split_clips(clips: DataFrame, path: str, split_col: str = "split") -> DataFrame:
    """Clip rows, bytes included, as Parquet with one folder per split."""
    clips.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return clips.sparkSession.read.parquet(path)


def name_collisions(df: DataFrame, path_col: str = "wav_file") -> DataFrame:
    """Base names that several paths share: ``(name, n)``."""
    return (df.groupBy(base_name(F.col(path_col)).alias("name"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def export_clips(clips: DataFrame, folder: str, name: Column, content_col: str = "content",
                 key: str = "path") -> DataFrame:
    """Write each clip to ``<folder>/<name>`` from the tasks; returns ``(key, target, length)``.

    ``folder`` is reachable from every executor (path or URI). A file appears
    under its name when complete, so a retried task repeats the same result. Two clips
    of one name raise before anything is written.
    """
    narrow = clips.select(key, name.alias("__name"), F.col(content_col).alias("__content"))
    twice = narrow.groupBy("__name").count().filter(F.col("count") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0][1]} clips would be written to {twice[0][0]!r}")
    base = qualified(clips.sparkSession, ".")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath
        import uuid

        filesystem, root = Files(base).find(folder)
        made = set()
        for batch in batches:
            targets, sizes = [], []
            for item, data in zip(batch.column(1).to_pylist(), batch.column(2)):
                target = f"{root}/{item}"
                parent = posixpath.dirname(target)
                if parent not in made:
                    filesystem.create_dir(parent, recursive=True)
                    made.add(parent)
                part = f"{parent}/.{uuid.uuid4().hex}.part"
                buffer = data.as_buffer()
                with filesystem.open_output_stream(part) as stream:
                    stream.write(buffer)
                filesystem.move(part, target)
                targets.append(f"{folder}/{item}")
                sizes.append(buffer.size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(targets, pa.string()), pa.array(sizes, pa.int64())],
                names=[key, "target", "length"])

    schema = f"`{key}` {narrow.schema[key].dataType.simpleString()}, target string, length bigint"
    return materialise(narrow.mapInArrow(write, schema), "export")


def write_model(model: MLWritable, path: str, dictionary: DataFrame | None = None) -> None:
    """The model and the labels its classes stand for, as one part of a folder.

    Readers take the newest whole part, so they never see a model with the labels of
    another; older parts are removed only when the new one is complete.
    """
    spark = SparkSession.active()
    before = commits.complete(spark, path)
    number = 1 + max((int(k.partition("=")[2]) for k in before), default=0)
    part = commits.stage(spark, path, f"model={number}")
    model.write().save(f"{part}/pipeline")
    if dictionary is not None:
        dictionary.write.parquet(f"{part}/labels")
    commits.finish(spark, part)
    for key in before:
        commits.remove(spark, f"{path.rstrip('/')}/{key}")


def append_metrics(history: DataFrame, path: str, key: str | None = None) -> None:
    """Add ``(run, epoch, split, metric, value)`` rows to the metrics of a folder.

    Rows of one ``key`` replace those given before under it, so a job that is repeated
    does not count twice; without a key they are always added.
    """
    part = commits.stage(history.sparkSession, path, f"rows={key or uuid.uuid4().hex}")
    history.write.parquet(part)
    commits.finish(history.sparkSession, part)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All rows given to :func:`append_metrics`; those of a run that was ended are not there."""
    found = spark.createDataFrame([], METRICS)
    for key in commits.complete(spark, path):
        found = found.union(spark.read.parquet(f"{path.rstrip('/')}/{key}").select(
            *found.columns))
    return found
