"""Results that appear as a whole: parts of a folder that count only once they are marked.

A part is named by its key (a run, a version, an epoch). Writing it anew first removes
what an ended run left of it; readers see marked parts only. The driver lists one
folder with as many entries as there are parts, never the data.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

MARK = "_COMPLETE"


def _store(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def stage(spark: SparkSession, folder: str, key: str) -> str:
    """The path of part ``key``, empty: write there, then :func:`finish` it."""
    if not re.fullmatch(r"[A-Za-z0-9][\w.=-]*", key):
        raise ValueError(f"not a key of a part: {key!r}")
    target = f"{folder.rstrip('/')}/{key}"
    remove(spark, target)
    return target


def finish(spark: SparkSession, part: str) -> None:
    store, path = _store(spark, part)
    store.create(path(f"{part}/{MARK}"), True).close()


def remove(spark: SparkSession, part: str) -> None:
    """Take a part away, its mark first."""
    store, path = _store(spark, part)
    store.delete(path(f"{part}/{MARK}"), False)
    store.delete(path(part), True)


def is_complete(spark: SparkSession, part: str) -> bool:
    store, path = _store(spark, part)
    return store.exists(path(f"{part}/{MARK}"))


def complete(spark: SparkSession, folder: str) -> list[str]:
    """Keys of the marked parts, in the order in which they were marked."""
    store, path = _store(spark, folder)
    if not store.exists(path(folder)):
        return []
    found = []
    for status in store.listStatus(path(folder)):
        mark = path(status.getPath(), MARK)
        if status.isDirectory() and store.exists(mark):
            found.append((store.getFileStatus(mark).getModificationTime(), status.getPath().getName()))
    return [key for _, key in sorted(found)]
