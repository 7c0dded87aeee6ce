"""Files opened by path inside tasks, wherever they lie."""

from __future__ import annotations

import re

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import SparkSession

# Schemes of the same store that have another name here.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the file sources report it: scheme and all, without a last slash."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop.getFileSystem(conf).makeQualified(hadoop).toString().rstrip("/")


def resolve(path: str, base: str) -> str:
    """The path with its scheme; one without is taken from ``base``, as Spark does."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path):
        return path
    if path.startswith("/"):
        return re.match(r"[^:]+:(//[^/]*)?", base)[0] + path
    return f"{base}/{path}"


class Files:
    """Finds the file system of a path; each is set up once in a task.

    ``base`` is the qualified working folder, found on the driver.
    """

    def __init__(self, base: str):
        self.base = base
        self.known: dict = {}

    def find(self, path: str) -> tuple[FileSystem, str]:
        """``(file system, path inside it)``."""
        scheme, _, rest = resolve(path, self.base).partition(":")
        if scheme == "file":
            return self.known.setdefault(scheme, LocalFileSystem()), "/" + rest.lstrip("/")
        host, _, inside = rest.removeprefix("//").partition("/")
        if (scheme, host) not in self.known:
            self.known[scheme, host] = FileSystem.from_uri(
                f"{SCHEMES.get(scheme, scheme)}://{host}/")
        filesystem, root = self.known[scheme, host]
        return filesystem, f"{root.rstrip('/')}/{inside}"

    def open(self, path: str | None):
        """The file for reading by range; a NULL path is a missing file."""
        if path is None:
            raise FileNotFoundError
        filesystem, inside = self.find(path)
        return filesystem.open_input_file(inside)
