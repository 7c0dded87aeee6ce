"""Token-id files: Parquet with encoded list columns, small row groups and page indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.llm import tokens as tk

SCHEMA = "doc_id bigint, shard int, start bigint, n_tokens int, ids array<int>"

# Ids take at most 16 bits each through a dictionary page; the sorted columns are
# stored as deltas. Pages are cut by rows too, so that the page index (written with
# every file) lets a reader skip to the documents it wants.
FILE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "compression": "zstd",
}


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = tk.END_ID,
          **options: str) -> None:
    """Encode whole texts and write them in ascending ``doc_id`` order.

    File ``shard`` n holds the n-th range of ids; ``start`` counts the ids before a
    document in its own file. A null text is empty and has the end id alone; rows
    with equal ids follow each other ordered by text, a null id comes first. An
    empty table gives a folder without rows. Columns other than the two needed
    are not read.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, ids, at in tk.encoded(batch.column(1), tokenizer, end_id):
                sizes = np.diff(at).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sizes)),
                     pa.array(np.full(len(sizes), shard, np.int32)),
                     pa.array(before + at[:-1]), pa.array(sizes), lists],
                    names=["doc_id", "shard", "start", "n_tokens", "ids"])
                before += int(at[-1])

    (docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id")
     .sortWithinPartitions("doc_id", "text").mapInArrow(encode, SCHEMA)
     .write.mode("overwrite").options(**{**FILE_OPTIONS, **options}).parquet(path))


def read(spark: SparkSession, path: str, doc_ids: tuple[int, int] | None = None) -> DataFrame:
    """``(doc_id, shard, start, n_tokens, ids)`` with ``start`` counted over all files.

    Select only the metadata and the ids are not read; ``doc_ids`` is an inclusive
    range, which skips row groups by their statistics and pages by the page index.
    The join adds one number for each file.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    sizes = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    base = sizes.selectExpr("shard", "sum(n) over (order by shard) - n as base")
    if doc_ids:
        files = files.filter(F.col("doc_id").between(*doc_ids))
    return files.join(F.broadcast(base), "shard").select(
        "doc_id", "shard", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    def checksum(lists: pa.Array) -> pa.Array:
        import zlib

        data = memoryview(lists.flatten().cast(pa.int32()).to_numpy().tobytes())
        ends = np.cumsum(lists.value_lengths().to_numpy()) * 4
        return pa.array([zlib.crc32(data[b:e]) for b, e in zip([0, *ends[:-1]], ends)], pa.int64())

    return F.arrow_udf(checksum, "bigint")(ids)
