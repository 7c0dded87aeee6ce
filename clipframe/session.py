"""Session settings, the shared scratch folder and bounded side tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Side tables up to this many rows, and this many bytes in their texts, may be shipped
# to every task; a larger one is joined by shuffling. The rest of a row is numbers.
MAX_SIDE_ROWS = 50_000
MAX_SIDE_BYTES = 16 << 20

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Audio rows are large: cap an Arrow batch by bytes, not by row count.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(app: str = "clipframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names for checkpoints.

    Only where none is named and everything runs in one process (tests, a laptop) a
    temporary one is made; on a cluster a missing name is an error, because each
    executor would write to its own disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="clipframe-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path (not yet created) in the shared folder."""
    path = f"{shared_dir(spark)}/clipframe-{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what operators wrote to the shared folder in between.

    Results that still read those tables must be written elsewhere inside. Without a
    scope the tables stay, because a returned DataFrame may need them at any time.
    """
    _scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(hadoop, _scopes.pop()):
            path.getFileSystem(conf).delete(path, True)


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows, their order and their partitions stay fixed."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash the rows of a small input over all cores.

    A small table may be one file with one row group, hence one task, which is
    slow when each row is a clip to decode. An input with at least as many
    partitions as cores is left as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def side_table(df: DataFrame, max_rows: int = MAX_SIDE_ROWS, *,
               max_bytes: int = MAX_SIDE_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(df, fits)`` where ``fits`` says that ``df`` has at most ``max_rows`` rows
    and ``max_bytes`` in its texts.

    A table that fits comes back as a local relation, so it is computed once and
    Catalyst knows its exact size. Texts are measured before any row reaches the
    driver; then at most ``max_rows + 1`` rows do.
    """
    first = df.limit(max_rows + 1)
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if texts:
        first = pin(first)  # measured and collected, computed once
        if (first.agg(F.sum(sum(texts[1:], texts[0]))).first()[0] or 0) > max_bytes:
            return df, False
    rows = first.collect()
    if len(rows) > max_rows:
        return df, False
    return df.sparkSession.createDataFrame(rows, df.schema), True


def lookup_join(df: DataFrame, side: DataFrame, on: list[str], how: str = "left",
                max_rows: int = MAX_SIDE_ROWS) -> DataFrame:
    """Join a (usually tiny) side table with unique keys.

    Within ``max_rows`` it is broadcast. Beyond, both sides are shuffled on the
    key plus a salt: the side table is repeated once per salt value, so rows of
    one hot key spread over ``SALTS`` tasks.
    """
    side, fits = side_table(side, max_rows)
    if fits:
        return df.join(F.broadcast(side), on, how)
    return salted_join(df, side, on, how)


SALTS = 32


def salted_join(df: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join with a side whose keys are unique, hot keys of ``df`` spread by a salt.

    The salt is a hash of the row's plain columns, so a retried task repeats it.
    """
    salt = "__salt"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*hashable(df)), F.lit(SALTS)).cast("int"))
    copies = side.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*on, salt], how).drop(salt)


HOT_SHARE = 200       # a key that more than a 200th of the rows have is hot
TRACKED = 10_000      # keys that the sketch of a task keeps


def hot_keys(df: DataFrame, on: list[str]) -> dict[int, float]:
    """Hashes of the hot keys and their shares, at most ``HOT_SHARE`` of them.

    One pass with a sketch of frequent items; no key is shuffled.
    """
    found = df.select(F.xxhash64(*on).alias("k")).agg(
        F.call_function("approx_top_k", F.col("k"), F.lit(HOT_SHARE), F.lit(TRACKED)).alias("top"),
        F.count(F.lit(1)).alias("n")).first()
    return {t["item"]: t["count"] / found["n"] for t in found["top"] or []
            if t["count"] * HOT_SHARE > found["n"]}


def hot_join(df: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join with a side whose keys are unique; only hot keys of ``df`` are spread.

    A hot key gets as many salts as it has tasks' worth of rows, several times over, and
    the side's row of it that many copies; all other rows are joined as they are. Both sides
    may be large, so neither is broadcast, however small the planner takes it to be: of what
    comes out of Python it knows no more than the size of what went in, such as file names.
    """
    hot = hot_keys(df, on)
    if not hot:
        return df.join(side.hint("merge"), on, how)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.map_from_arrays(F.lit(list(hot)), F.lit([1 + int(16 * tasks * s) for s in hot.values()]))
    many = F.coalesce(F.element_at(salts, F.xxhash64(*on)), F.lit(1))
    salt = "__salt"
    spread_ = df.withColumn(salt, F.pmod(F.xxhash64(*hashable(df)), many).cast("int"))
    copies = side.withColumn(salt, F.explode(F.sequence(F.lit(0), many - 1)))
    return spread_.join(copies.hint("merge"), [*on, salt], how).drop(salt)


def hashable(df: DataFrame) -> list[str]:
    """Plain columns to hash; audio bytes and arrays are too long for that."""
    return [f"`{f.name}`" for f in df.schema.fields
            if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.BinaryType)]
