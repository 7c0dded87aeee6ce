"""Row numbers, batches, pad targets and stacked batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipframe.session import pin

LOW_33_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_number",
                partitions: int | None = None) -> DataFrame:
    """Add 0-based global row numbers in the order of ``order``.

    The rows are range-partitioned and sorted, then pinned by a checkpoint so
    partition counts and numbering see the same partitions even after a lost
    executor. Only one count per partition reaches the driver. Pass narrow rows.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = pin(df.repartitionByRange(partitions, *order).sortWithinPartitions(*order))
    # partition number in the high bits, position in the partition in the low 33
    place = fixed.withColumn("__id", F.monotonically_increasing_id())
    part = F.shiftright("__id", 33).cast("int")
    counts = dict(fixed.groupBy(F.spark_partition_id().alias("p")).count().collect())
    total = list(accumulate((counts.get(p, 0) for p in range(partitions)), initial=0))
    offsets = spark.createDataFrame(list(enumerate(total[:-1])), "__part int, __offset bigint")
    number = F.col("__offset") + F.col("__id").bitwiseAND(F.lit(LOW_33_BITS))
    return (
        place.withColumn("__part", part).join(F.broadcast(offsets), "__part")
        .select(*df.columns, number.alias(name)))


def assign_batches(df: DataFrame, order: Sequence[str], batch_size: int,
                   partitions: int | None = None) -> DataFrame:
    """Add ``batch_id`` and ``pos`` (place in the batch) in the given order."""
    numbered = number_rows(df, order, "__row", partitions)
    return numbered.select(
        *df.columns,
        F.expr(f"__row div {int(batch_size)}").alias("batch_id"),
        F.expr(f"__row % {int(batch_size)}").cast("int").alias("pos"))


def pad_target(df: DataFrame, length: Column, padding: bool | str = True,
               max_length: int | None = None, multiple_of: int | None = None,
               name: str = "pad_to") -> DataFrame:
    """Add the length each row of a batch is padded to.

    ``True`` / ``'longest'``: the longest of the batch; ``'max_length'``: that
    length; ``False``: no padding. NULL lengths (rejected rows) do not count. A
    longer clip is never cut. A window holds one batch, ``batch_size`` rows.
    """
    if padding in (True, "longest"):
        target = F.max(length).over(Window.partitionBy("batch_id"))
    elif padding == "max_length":
        if max_length is None:
            raise ValueError("padding='max_length' needs max_length")
        target = F.lit(max_length)
    elif padding is False:
        target = length
    else:
        raise ValueError(f"unknown padding: {padding!r}")
    if multiple_of and padding is not False:
        target = F.ceil(target / multiple_of) * multiple_of
    return df.withColumn(name, F.greatest(target, length).cast("int"))


def by_batch(plan: DataFrame, batches_per_task: int) -> DataFrame:
    """Narrow plan rows in tasks of whole, adjacent batches, sorted by batch and place."""
    batches = (plan.agg(F.max("batch_id")).first()[0] or 0) + 1
    cores = plan.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-batches // batches_per_task), min(batches, cores))
    return plan.repartitionByRange(tasks, "batch_id").sortWithinPartitions("batch_id", "pos")


def stack_adjacent(padded: DataFrame, key: str, labels: str | None = "label_id",
                   error: str | None = "error") -> DataFrame:
    """As :func:`stack_batches` for rows of ``preprocess`` by path: no shuffle.

    The rows of a batch follow each other in one task, in order of ``pos``; one batch is
    held at a time.
    """
    good = padded.filter(F.col(error).isNull()) if error else padded
    columns = [key, "input_values", "attention_mask", *([labels] if labels else [])]
    narrow = good.select("batch_id", *columns)
    schema = T.StructType([narrow.schema["batch_id"], *[
        T.StructField(c, T.ArrayType(narrow.schema[c].dataType)) for c in columns]])

    def stacked(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        ends = pa.array([0, whole.num_rows], pa.int32())
        return pa.RecordBatch.from_arrays(
            [whole.column(0)[:1], *[pa.ListArray.from_arrays(ends, c) for c in whole.columns[1:]]],
            names=schema.names)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for table in tables:
            ids = table.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for start, end in pairwise(cuts):
                part = table.slice(start, end - start)
                if held and part.num_rows and held[0].column(0)[0] != part.column(0)[0]:
                    yield stacked(held)
                    held = []
                if part.num_rows:
                    held.append(part)
        if held:
            yield stacked(held)

    return narrow.mapInArrow(run, schema)


def stack_batches(padded: DataFrame, key: str, labels: str | None = "label_id",
                  error: str | None = "error") -> DataFrame:
    """Padded rows -> one row per batch, clips in order of ``pos``.

    ``batch_id, key, input_values, attention_mask, [labels]``, each an array over
    the clips. Rejected rows are left out. A group is one batch, so it holds at
    most ``batch_size`` rows.
    """
    good = padded.filter(F.col(error).isNull()) if error else padded
    columns = ["pos", key, "input_values", "attention_mask", *([labels] if labels else [])]
    rows = F.sort_array(F.collect_list(F.struct(*columns)))
    stacked = good.groupBy("batch_id").agg(rows.alias("__rows"))
    return stacked.select("batch_id", *[F.col(f"__rows.{c}").alias(c) for c in columns[1:]])
