"""Clip files as DataFrames: folder scans, corpus scans and path-driven loads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipframe.session import new_folder
from clipframe.sources.files import Files, qualified

# Largest file the binary source can hold in one row (a JVM byte array).
MAX_FILE_BYTES = 2**31 - 1
# Of the files a scan holds in a worker, beside the workers of what follows.
SCAN_PART_BYTES = 4 << 20
# Fixed value: what makes a path a glob to Spark.
GLOB = frozenset("{}[]*?\\")
# Fixed value: files and folders that Spark's listing takes for hidden.
HIDDEN = r"/_(?!metadata|common_metadata)[^/=]*(/|$)|\._COPYING_(/|$)"
# Fixed value: files that it lists but its sources do not read.
UNREAD = r"/_[^/=]*$"


def _files(spark: SparkSession, roots: str | Sequence[str], pattern: str) -> DataFrame:
    """``(path, length)`` by the rules of Spark's file sources, but listed in tasks.

    A root may be a glob, as there; what it names is found on the driver, not what lies below.
    """
    from clipframe.sources.manifest import list_files

    given = [path for root in ([roots] if isinstance(roots, str) else roots)
             for path in _named(spark, root)]
    regex = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
    return list_files(spark, given, names=regex, hidden=HIDDEN).filter(
        (F.col("length") > 0) & ~F.col("path").rlike(UNREAD)).select("path", "length")


def _named(spark: SparkSession, root: str) -> list[str]:
    """The files and folders that a root names: itself, or what the glob fits."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if set(root) & GLOB:
        found = [str(s.getPath()) for s in store.globStatus(store.makeQualified(hadoop)) or []]
    else:
        found = [qualified(spark, root)] if store.exists(hadoop) else []
    if not found:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {qualified(spark, root)}.")
    return found


def scan_clips(spark: SparkSession, roots: str | Sequence[str], pattern: str = "*.wav",
               max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """``(path, length, content, load_error)`` of every matching file below the roots.

    The files are listed and read in tasks that have about as many bytes each, so no name
    reaches the driver. Hidden names (leading ``.`` or ``_``) and files of zero bytes are
    skipped, as by Spark's file sources. A file over ``max_bytes`` keeps its row, with NULL
    content and a ``load_error``; its bytes are never read.
    """
    from clipframe.sources.manifest import read_listed

    return read_listed(_files(spark, roots, pattern), max_bytes, SCAN_PART_BYTES)


def oversized(spark: SparkSession, roots: str | Sequence[str], pattern: str = "*.wav",
              max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Files too large for one row: ``(path, length, error)``, bytes never read."""
    files = _files(spark, roots, pattern).filter(F.col("length") > max_bytes)
    return files.select("path", "length", F.lit("file too large").alias("error"))


def scan_paths(spark: SparkSession, roots: str | Sequence[str], pattern: str = "*.wav",
               path_col: str = "wav_file") -> DataFrame:
    """Only the paths, by the rules of :func:`scan_clips`: no file is opened."""
    return _files(spark, roots, pattern).select(F.col("path").alias(path_col))


def scan_corpora(spark: SparkSession, base_dir: str, corpora: Sequence[str],
                 train_dir: str = "train", path_col: str = "wav_file") -> DataFrame:
    """One scan of ``<base>/<train>/<corpus>/**`` -> ``(corpus, wav_file)``.

    The paths begin with ``base_dir`` as given; the corpus is the folder right
    below ``<base>/<train>/``.
    """
    given = f"{base_dir.rstrip('/')}/{train_dir}/"
    paths = scan_paths(spark, [given + name for name in corpora], path_col="path")
    return corpus_paths(paths, base_dir, train_dir, path_col)


def corpus_paths(paths: DataFrame, base_dir: str, train_dir: str = "train",
                 path_col: str = "wav_file") -> DataFrame:
    """``(corpus, wav_file)`` of files below ``<base>/<train>`` with their full ``path``."""
    given = f"{base_dir.rstrip('/')}/{train_dir}/"
    below = F.substring_index("path", qualified(paths.sparkSession, given) + "/", -1)
    return paths.select(F.split(below, "/")[0].alias("corpus"),
                        F.concat(F.lit(given), below).alias(path_col))


def read_files(base: str, path_col: str, max_bytes: int = MAX_FILE_BYTES, part_bytes: int = 64 << 20
               ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does to batches of rows with paths: adds ``length, content, load_error``.

    ``base`` is the qualified working folder. A part ends when it holds ``part_bytes``.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(base)
        for batch in batches:
            paths = batch.column(batch.schema.get_field_index(path_col)).to_pylist()
            start, held = 0, 0
            content: list[bytes | None] = []
            lengths: list[int | None] = []
            errors: list[str | None] = []
            for i, path in enumerate(paths):
                data, size, error = None, None, None
                try:
                    with files.open(path) as handle:
                        size = handle.size()
                        if size > max_bytes:
                            error = "file too large"
                        else:
                            data = handle.read()
                except FileNotFoundError as exc:  # the row is kept; other faults are retried
                    error = f"cannot read file: {type(exc).__name__}"
                content.append(data)
                lengths.append(size)
                errors.append(error)
                held += len(data or b"")
                if held >= part_bytes or i == len(paths) - 1:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(lengths, pa.int64()),
                         pa.array(content, pa.binary()), pa.array(errors, pa.string())],
                        names=[*part.schema.names, "length", "content", "load_error"])
                    start, held, content, lengths, errors = i + 1, 0, [], [], []

    return read


def load_clips(df: DataFrame, path_col: str = "input_values",
               clips_per_task: int | None = None, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Read the file each row names, inside the tasks that hold the rows.

    Adds ``length``, ``content`` and ``load_error``. Works from a metadata table
    without listing folders and without a join, so audio bytes are never
    shuffled. A file that is missing or over ``max_bytes`` keeps its row, with the
    reason; other read faults fail the task, so it is retried.
    ``clips_per_task`` spreads the (small) metadata rows before any byte is read.
    """
    base = qualified(df.sparkSession, ".")
    if clips_per_task:
        tasks = max(1, -(-df.count() // clips_per_task))
        df = df.repartition(tasks)  # round-robin: many rows may lack a path
    schema = T.StructType([
        *df.schema.fields,
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("load_error", T.StringType()),
    ])
    return df.mapInArrow(read_files(base, path_col, max_bytes), schema)


def ingest(spark: SparkSession, roots: str | Sequence[str], out: str,
           pattern: str = "*.wav") -> DataFrame:
    """Copy many small files into one Parquet clip table, header included.

    Later jobs read this table: header jobs read the header columns only. The files are
    listed and read in tasks that have about as many bytes each, so no name reaches the
    driver; as in :func:`scan_clips`, names that begin with ``_`` and files of zero bytes
    are left out.
    """
    from clipframe.sources.manifest import list_files, read_listed
    from clipframe.sources.wav import with_headers

    given = [qualified(spark, r) for r in ([roots] if isinstance(roots, str) else roots)]
    path, below = F.col("path"), F.lit("")
    for root in given:
        below = F.when(path.startswith(f"{root}/"), F.substring(path, F.lit(len(root) + 1), F.length(path))
                       ).otherwise(below)
    listed = list_files(spark, given, pattern).filter((F.col("length") > 0) & ~below.rlike(HIDDEN))
    clips = with_headers(read_listed(listed))
    clips.write.mode("overwrite").option("parquet.block.size", 128 << 20).parquet(out)
    return spark.read.parquet(out)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write once to the shared folder and read back: costly columns run one time."""
    out = new_folder(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)
