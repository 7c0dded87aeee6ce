"""Best-fit packing of documents into token sequences, certified by lower bounds.

Pieces are dealt into partitions; each packs its own by best-fit decreasing and
proves how good that is with dual-feasible functions. Pieces in the worst filled
sequences of partitions with a gap change partitions and are packed again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipframe.llm import tokens as tk
from clipframe.llm.common import written

ITEMS_PER_TASK = 50_000
MAX_ROUNDS = 4
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = (PIECES + ", sequence_id bigint, offset bigint, kept boolean, "
          "bins bigint, bound bigint")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of two families of dual-feasible functions."""
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = 0
    for cut in np.unique(np.minimum(lengths, capacity - lengths + 1)):
        if 2 * cut > capacity:
            continue
        # above capacity - cut: a whole sequence; below cut: nothing
        value = np.where(size > capacity - cut, capacity, np.where(size < cut, 0, size))
        best = max(best, -(-int(counts @ value) // capacity))
    best = max(best, -(-int(counts @ size) // capacity))
    for k in range(1, 33):
        times = (k + 1) * size
        value = np.where(times % capacity == 0, times // capacity * k,
                         times // capacity * (k + 1))
        best = max(best, -(-int(counts @ value) // (k * (k + 1))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each length, and the fill of each bin."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if some bin has exactly r left
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        above = open_rooms >> length
        if above:
            left = length + (above & -above).bit_length() - 1
            chosen = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            left, chosen = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = chosen, capacity - left
        fill[chosen] += length
        left -= length
        if left:
            room[left].append(chosen)
            open_rooms |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = tk.END_ID,
           remembered: int = tk.REMEMBERED) -> DataFrame:
    """Encode whole texts and cut those longer than ``capacity``; the first piece is the short one.

    A null text is empty and has the end id alone. Ids stay out of the result; a
    piece is named by its document, start and length, and known by its checksum.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows = batch.column(0).to_pylist(), []
            for row, ids, at in tk.encoded(batch.column(1), tokenizer, end_id,
                                               remembered):
                for doc_id, a0, b0 in zip(names[row:], at.tolist(), at[1:].tolist()):
                    first = (b0 - a0) % capacity or capacity
                    edges = [0, *range(first, b0 - a0 + 1, capacity)]
                    rows += [(doc_id, n, a, b - a, tk.crc(ids[a0 + a:a0 + b]))
                             for n, (a, b) in enumerate(zip(edges, edges[1:]))]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)


def pack(items: DataFrame, capacity: int, items_per_task: int = ITEMS_PER_TASK,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Give each row of ``items`` (schema ``PIECES``, lengths 1 to capacity) a place.

    Adds ``sequence_id``, ``offset`` and the ``bins`` and ``bound`` of the partition
    that placed it: equal numbers certify that no packing of its rows needs fewer.
    Round-robin dealing keeps partitions even whatever key repeats. Each partition
    gives up its least filled sequence, and eight more for each one above its
    bound; the pool is a small part of the input and shrinks, and is dealt anew
    until it fits one task, whose result stands, or the rounds are used up.
    """
    done, pool = [], items
    for number in range(max_rounds):
        n = pool.count()
        if not n:
            break
        tasks = -(-n // items_per_task)
        last = tasks == 1 or number == max_rounds - 1

        def place(batches: Iterator[pa.RecordBatch], number: int = number,
                  last: bool = last) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            mine = list(batches)
            if not sum(b.num_rows for b in mine):
                return
            rows = pa.Table.from_batches(mine).combine_chunks()
            lengths = rows.column("length").to_numpy()
            bins, offsets, fill = best_fit(lengths, capacity)
            bound = lower_bound(lengths, capacity)
            kept = np.ones(len(fill), bool)
            if not last:
                loose = np.argsort(fill, kind="stable")[:1 + 8 * (len(fill) - bound)]
                kept[loose[fill[loose] < capacity]] = False
            name = (number << 58) + (TaskContext.get().partitionId() << 32)
            for values, column in ((bins + name, "sequence_id"), (offsets, "offset"),
                                   (kept[bins], "kept"),
                                   (np.full(len(bins), len(fill)), "bins"),
                                   (np.full(len(bins), bound), "bound")):
                rows = rows.append_column(column, pa.array(values))
            yield from rows.to_batches(max_chunksize=10_000)

        names = [f.split()[0] for f in PIECES.split(", ")]
        placed = written(pool.select(names).repartition(tasks).mapInArrow(place, PACKED),
                         f"packed-{number}")
        done.append(placed.filter("kept"))
        pool = placed.filter("not kept")
        if last:
            break
    if not done:
        return written(items, "packed").selectExpr(
            "*", "0L as sequence_id", "0L as offset", "0L as bins", "0L as bound")
    result = done[0]
    for more in done[1:]:
        result = result.union(more)
    return result.drop("kept")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024,
                   end_id: int = tk.END_ID, remembered: int = tk.REMEMBERED,
                   **options: int) -> DataFrame:
    """Pieces of all documents with their sequences. An empty table gives an empty result.

    A worker remembers the ids of ``remembered`` parts of texts at most.

    Repeated rows and null ids are packed like any other row; only ``doc_id`` and
    ``text`` are read.
    """
    return pack(written(pieces(docs, tokenizer, capacity, end_id, remembered), "pieces"), capacity, **options)
