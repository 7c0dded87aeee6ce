"""Which files lie below some folders: listed in tasks, and remembered between runs.

Folders are expanded level by level; each level is a table whose rows are dealt to
tasks, so a tree of any size is listed by the executors and no name reaches the
driver. Files of zero bytes and names that begin with ``_`` are files like others;
names that begin with a dot are hidden.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipframe.session import pin
from clipframe.sources import commits
from clipframe.sources.files import Files, qualified
from clipframe.sources.scan import MAX_FILE_BYTES, materialise, read_files

FOLDERS_PER_TASK = 16
NAMES_PER_BATCH = 10_000
MAX_LEVELS = 200          # deeper is taken for a link to a folder above
TASK_BYTES = 128 << 20    # of files that one task reads, about
LISTED = "path string, length bigint, mtime timestamp"
ENTRIES = f"{LISTED}, folder boolean"
CHANGES = f"{LISTED}, change string"


def list_files(spark: SparkSession, roots: str | Sequence[str], pattern: str = "*.wav", *,
               names: str | None = None, hidden: str | None = None) -> DataFrame:
    """``(path, length, mtime)`` of the files below the roots whose names fit the pattern.

    A root may be a file. A missing root raises. A path that several roots reach is
    listed once. ``*``, ``?`` and ``[..]`` of the pattern are case sensitive. With
    ``names``, whole file names fit that regular expression instead, those of roots too;
    what ``hidden`` finds in ``/<name>`` is left out, and folders with all they hold.
    """
    base = qualified(spark, ".")
    given = [qualified(spark, r) for r in ([roots] if isinstance(roots, str) else roots)]
    entry_types = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]

    def entries(batches: Iterator[pa.RecordBatch], below: bool) -> Iterator[pa.RecordBatch]:
        import os
        import re
        from fnmatch import fnmatchcase
        from itertools import batched

        from pyarrow.fs import FileSelector, FileType, LocalFileSystem

        def left_out(name: str, folder: bool) -> bool:
            if names is None and not below or folder and not below:
                return False
            if name.startswith(".") or hidden is not None and re.search(hidden, f"/{name}"):
                return True
            return not (folder or (fnmatchcase(name, pattern) if names is None
                                   else re.fullmatch(names, name, re.DOTALL)))

        def found_at(path: str) -> Iterator[tuple[str, bool, int, int]]:
            store, inside = files.find(path)
            if below and isinstance(store, LocalFileSystem):  # a folder of any size is a stream
                with os.scandir(inside) as found:
                    for entry in found:
                        stat = entry.stat()
                        yield entry.name, entry.is_dir(), stat.st_size, stat.st_mtime_ns // 1000
                return
            for info in (store.get_file_info(FileSelector(inside)) if below
                         else [store.get_file_info(inside)]):
                if info.type == FileType.NotFound:
                    raise FileNotFoundError(f"no such file or folder: {path}")
                folder = info.type == FileType.Directory
                yield info.base_name, folder, info.size, 0 if folder else info.mtime_ns // 1000

        files = Files(base)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for some in batched(found_at(path), NAMES_PER_BATCH):
                    rows = [(f"{path}/{name}" if below else path, None if folder else size,
                             None if folder else mtime, folder)
                            for name, folder, size, mtime in some if not left_out(name, folder)]
                    columns = zip(*rows) if rows else [()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, entry_types)],
                        names=["path", "length", "mtime", "folder"])

    level = spark.createDataFrame([(r,) for r in dict.fromkeys(given)], "path string").mapInArrow(
        lambda batches: entries(batches, False), ENTRIES)
    listed = None
    for _ in range(MAX_LEVELS):
        level = materialise(level, "listing")
        files = level.filter("not folder").drop("folder")
        listed = files if listed is None else listed.union(files)
        folders = level.filter("folder").select("path").distinct()
        n = folders.count()
        if not n:
            return listed.dropDuplicates(["path"])
        tasks = max(-(-n // FOLDERS_PER_TASK), min(n, spark.sparkContext.defaultParallelism))
        level = folders.repartition(tasks, "path").mapInArrow(
            lambda batches: entries(batches, True), ENTRIES)
    raise RecursionError(f"folders lie deeper than {MAX_LEVELS} levels")


def balanced(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Names dealt so that a task has about ``task_bytes`` to read, before any byte is read."""
    total = files.agg(F.sum("length")).first()[0] or 0
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(-(-total // task_bytes), cores), "path")


def dealt(files: DataFrame, per_task: int = 1024) -> DataFrame:
    """Names dealt by their number, for jobs that read little of each file."""
    n, cores = files.count(), files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(-(-n // per_task), min(n, cores), 1), "path")


def read_lines(files: DataFrame) -> DataFrame:
    """``(file_path, line_id, value)`` of listed text files (UTF-8), opened in the tasks.

    Lines end as Spark's text source ends them; a file is read as a stream.
    """
    base = qualified(files.sparkSession, ".")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        from itertools import batched

        found = Files(base)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with found.open(path) as handle:
                    text = io.TextIOWrapper(handle, "utf-8", "replace", newline=None)
                    for lines in batched(enumerate(text), NAMES_PER_BATCH):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(lines)), pa.array([i for i, _ in lines], pa.int64()),
                             pa.array([line.removesuffix("\n") for _, line in lines])],
                            names=["file_path", "line_id", "value"])

    return dealt(files.select("path"), 16).mapInArrow(
        read, "file_path string, line_id bigint, value string")


def read_listed(files: DataFrame, max_bytes: int = MAX_FILE_BYTES,
                part_bytes: int = 64 << 20) -> DataFrame:
    """``(path, length, content, load_error)`` of listed files, opened in the tasks.

    A file over ``max_bytes`` or gone since keeps its row, with a ``load_error``. A worker
    holds about ``part_bytes`` at a time, or one file.
    """
    names = balanced(files).select("path")
    schema = T.StructType([*names.schema.fields, T.StructField("length", T.LongType()),
                           T.StructField("content", T.BinaryType()),
                           T.StructField("load_error", T.StringType())])
    return names.mapInArrow(
        read_files(qualified(files.sparkSession, "."), "path", max_bytes, part_bytes), schema)


class Manifest:
    """The files below some folders as of each run, kept as changes in a folder.

    Version n holds what run n found ``added``, ``changed`` (another length or time) or
    ``removed`` since the version before. A version counts once it is complete, so a
    run that was killed leaves none.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        return sorted(int(k.partition("=")[2]) for k in commits.complete(self.spark, self.folder))

    def last(self) -> int:
        """The newest version; 0 before the first."""
        return max(self.versions(), default=0)

    def changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """``(path, length, mtime, change, version)`` of the versions after ``after``, oldest first."""
        wanted = [v for v in self.versions() if v > after and (upto is None or v <= upto)]
        found = self.spark.createDataFrame([], f"{CHANGES}, version int")
        for v in wanted:
            found = found.union(self.spark.read.schema(CHANGES).parquet(self._part(v)).withColumn(
                "version", F.lit(v)))
        return found

    def files(self, version: int | None = None) -> DataFrame:
        """``(path, length, mtime)`` of the files there were at a version, the newest by default."""
        latest = self.changes(0, version).groupBy("path").agg(F.max_by(
            F.struct("length", "mtime", "change"), "version").alias("now"))
        return latest.filter("now.change <> 'removed'").select("path", "now.length", "now.mtime")

    def fresh(self, after: int) -> DataFrame:
        """``(path, length, mtime)`` of the files that are new or changed since a version."""
        latest = self.changes(after).groupBy("path").agg(F.max_by(
            F.struct("length", "mtime", "change"), "version").alias("now"))
        return latest.filter("now.change <> 'removed'").select("path", "now.length", "now.mtime")

    def refresh(self, roots: str | Sequence[str], pattern: str = "*.wav") -> int:
        """List the folders again and keep what changed; the version that holds it.

        Without a change the last version stays the newest.
        """
        before = self.files().select("path", F.col("length").alias("old_length"),
                                     F.col("mtime").alias("old_mtime"), F.lit(True).alias("known"))
        found = list_files(self.spark, roots, pattern).withColumn("there", F.lit(True))
        both = found.join(before, "path", "full")
        same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("mtime").eqNullSafe(
            F.col("old_mtime"))
        change = (F.when(F.col("known").isNull(), "added").when(F.col("there").isNull(), "removed")
                  .when(~same, "changed"))
        changed = pin(both.withColumn("change", change).filter("change is not null").select(
            "path", "length", "mtime", "change"))
        last = self.last()
        if changed.isEmpty() and last:
            return last
        part = commits.stage(self.spark, self.folder, f"version={last + 1}")
        changed.write.parquet(f"{part}/files")
        commits.finish(self.spark, part)
        return last + 1

    def _part(self, version: int) -> str:
        return f"{self.folder}/version={version}/files"
