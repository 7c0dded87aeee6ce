"""Reading, one-time tables and connected components shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.session import new_folder


ARROW_ROWS = 2_000
FEW_EDGES = 200_000


def text_batches(spark: SparkSession) -> None:
    """Send fewer rows to Python at a time, unless the session says how many.

    The default of 10,000 is meant for narrow rows; here a row is a whole text.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ARROW_ROWS))


def give_back() -> None:
    """Return freed memory of this Python worker to the system.

    Workers live on after a stage, beside those of the next.
    """
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    text_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, whatever executor is lost."""
    out = new_folder(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores before it until no column has that name."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted = "_" + wanted
    return wanted


def held_out(doc_id: Column) -> Column:
    """The fifth of the rows that no model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _few_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, component)`` of all vertices of a few edges, by union and find."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    for batch in batches:
        for u, v in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = top(u), top(v)
            above[max(a, b)] = min(a, b)
    ids = list(above)
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([top(x) for x in ids], pa.int64())],
        names=["id", "component"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``(a bigint, b bigint)``: ``(id, component)``, the smallest id.

    Alternating large-star and small-star rounds; each is an aggregate and a join
    on the vertex, so a hub is pre-aggregated and its join is split when skewed.
    Every round is a table in the shared folder; only its size and a checksum
    reach the driver. At most ``FEW_EDGES`` are joined in one task, which spares the many
    small files of the rounds. Vertices without an edge to another do not appear.
    """
    edges = written(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if edges.count() <= FEW_EDGES:
        return written(edges.coalesce(1).mapInArrow(
            _few_components, "id bigint, component bigint"), "components")
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v")))
        edges = written(small.filter(F.col("u") != F.col("v")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = now
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
