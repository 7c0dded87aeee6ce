"""Benchmark decontamination by winnowed fingerprints that are joined and extended."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.llm import words as W
from clipframe.llm.common import free_name, written
from clipframe.llm.tokens import worker_state

SPAN_WORDS = 10
GRAM_WORDS = 5
ITEM_BYTES = 8 << 20  # of items that are broadcast, at most
PART_ROWS = 1_000     # documents with shared fingerprints that are looked at together


class Index(NamedTuple):
    """Winnowed grams of one gram size over a block of items.

    ``gram`` sorted, with ``at`` the word each begins at in ``hashes``; items are
    laid end to end, ``first`` and ``last`` bound the words of the item of a gram.
    """
    k: int
    span: int
    gram: np.ndarray
    at: np.ndarray
    item: np.ndarray
    first: np.ndarray
    last: np.ndarray


def winnow(grams: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Positions of the grams kept: the last smallest of every ``window`` in a row.

    ``starts`` and ``ends`` bound the grams of each row. What is kept depends on the
    window alone, so two texts that share a window keep the same gram of it.
    """
    if window == 1 or not len(grams):
        return np.concatenate([np.arange(s, e) for s, e in zip(starts, ends) if e > s] or
                              [np.empty(0, np.int64)]).astype(np.int64)
    n = len(grams) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, place = grams[:n].copy(), np.arange(n)
    for j in range(1, window):
        here = grams[j:j + n]
        less = here <= best
        best = np.where(less, here, best)
        place = np.where(less, np.arange(j, j + n), place)
    inside = np.zeros(n + 1, np.int64)
    full = ends - starts >= window
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, ends[full] - window + 1, -1)
    return np.unique(place[np.cumsum(inside[:n]) > 0])


def kept_grams(words: W.Words, k: int, window: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the winnowed grams of rows with ``shortest`` words or more."""
    grams = W.grams(words.hashes, k)
    counts = np.diff(words.first)
    ok = counts >= shortest
    at = winnow(grams, words.first[:-1][ok], words.first[1:][ok] - k + 1, window)
    return grams[at], at


def build(items: pa.Array, span: int, k: int) -> tuple[list[Index], np.ndarray]:
    """Indexes of a block of item texts: one for spans of ``span``, one for each shorter item length."""
    hashes, first, rows = [], [], 0
    for _, data, offsets in W.chunks(items):
        words = W.split_words(data, offsets, W.ALPHANUMERIC)
        hashes.append(words.hashes)
        first.append(words.first[:-1] + rows)
        rows += len(words.hashes)
    words = W.Words(np.concatenate([*hashes, np.empty(0, np.uint64)]),
                    np.concatenate([*first, [rows]]).astype(np.int64))
    counts = np.diff(words.first)
    found = []
    for size in sorted(set(np.minimum(counts, span).tolist()) - {0}):
        mine = counts >= span if size == span else counts == size
        gram_words = min(k, size)
        grams = W.grams(words.hashes, gram_words)
        ends = words.first[1:][mine] - gram_words + 1
        at = winnow(grams, words.first[:-1][mine], ends, size - gram_words + 1)
        item = np.searchsorted(words.first, at, "right") - 1
        order = np.argsort(grams[at], kind="stable")
        at, item = at[order], item[order]
        found.append(Index(gram_words, size, grams[at], at, item,
                           words.first[item], words.first[item + 1]))
    return found, words.hashes


def matches(words: W.Words, index: Index, item_words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matched runs ``(from, to, item)`` in words of a batch of documents.

    Fingerprints that meet are extended word by word, at most ``span - k`` words to
    either side; every shared span holds such a fingerprint, so none is missed.
    """
    none = (np.empty(0, np.int64),) * 3
    gram, at = kept_grams(words, index.k, index.span - index.k + 1, index.span)
    if not len(gram) or not len(index.gram):
        return none
    low = np.searchsorted(index.gram, gram, "left")
    hit = low < len(index.gram)
    hit[hit] = index.gram[low[hit]] == gram[hit]
    gram, at, low = gram[hit], at[hit], low[hit]
    many = np.searchsorted(index.gram, gram, "right") - low
    mine = np.repeat(at, many)
    entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) \
        if len(many) else np.empty(0, np.int64)
    if not len(mine):
        return none
    theirs = index.at[entry]
    row = np.searchsorted(words.first, mine, "right") - 1
    begin, end = words.first[row], words.first[row + 1]
    same = np.ones(len(mine), bool)
    for j in range(index.k):
        same &= words.hashes[mine + j] == item_words[theirs + j]
    left, right = np.zeros(len(mine), np.int64), np.full(len(mine), index.k)
    going_left, going_right = same.copy(), same.copy()
    for step in range(1, index.span - index.k + 1):
        going_left &= (mine - step >= begin) & (theirs - step >= index.first[entry])
        going_left[going_left] = (words.hashes[(mine - step)[going_left]]
                                  == item_words[(theirs - step)[going_left]])
        left += going_left
        reach = index.k + step - 1
        going_right &= (mine + reach < end) & (theirs + reach < index.last[entry])
        going_right[going_right] = (words.hashes[(mine + reach)[going_right]]
                                    == item_words[(theirs + reach)[going_right]])
        right += going_right
    enough = same & (left + right >= index.span)
    return (mine - left)[enough], (mine + right)[enough], index.item[entry[enough]]


RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<string>>"
PRINTS = "row bigint, size int, gram bigint"
FOUND = "row bigint, n_words bigint, n_hit bigint, items array<string>"


def find(texts: pa.Array, indexes: list[Index], item_words: np.ndarray, names: list[str | None]
         ) -> Iterator[tuple[int, int, list[str]]]:
    """``(n_words, n_hit, items)`` of each text."""
    for _, data, offsets in W.chunks(texts):
        words = W.split_words(data, offsets, W.ALPHANUMERIC)
        change = np.zeros(len(words.hashes) + 1, np.int64)
        rows, which = [], []
        for index in indexes:
            start, stop, item = matches(words, index, item_words)
            np.add.at(change, start, 1)
            np.add.at(change, stop, -1)
            rows.append(np.searchsorted(words.first, start, "right") - 1)
            which.append(item)
        covered = np.cumsum(change)[:-1] > 0
        pairs = np.unique(np.stack([np.concatenate([*rows, np.empty(0, np.int64)]),
                                    np.concatenate([*which, np.empty(0, np.int64)])]).astype(
                                        np.int64), axis=1)
        bounds = np.searchsorted(pairs[0], np.arange(len(words.first)))
        for i in range(len(words.first) - 1):
            mine = pairs[1][bounds[i]:bounds[i + 1]]
            yield (int(words.first[i + 1] - words.first[i]),
                   int(covered[words.first[i]:words.first[i + 1]].sum()) if len(mine) else 0,
                   sorted({names[j] for j in mine if names[j] is not None}))


def in_tasks(spark, ids: list[str | None], texts: list[str | None], span: int, k: int) -> Column:
    """A column function that finds a bounded number of items in a text column."""
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((ids, texts))

    def found(column: pa.Array) -> pa.Array:
        names, item_texts = shared.value
        held = worker_state("items", dict)  # the index of one call, kept over batches and tasks
        if key not in held:
            held.clear()
            held[key] = build(pa.array(item_texts, pa.large_string()), span, k)
        indexes, item_words = held[key]
        rows = list(find(column, indexes, item_words, names))
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.string()))],
            names=["n_words", "n_hit", "items"])

    return F.arrow_udf(found, RESULT)


def fingerprints(rows: DataFrame, text_col: str, span: int, k: int,
                 sizes: list[int] | None = None) -> DataFrame:
    """``(row, size, gram)`` of ``rows (row, text)``: distinct winnowed grams of each text.

    An item has those of its own size: its number of words, at most ``span``. With
    ``sizes`` a text has those of all these sizes that it is long enough for.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy()
            for row, data, offsets in W.chunks(batch.column(1)):
                words = W.split_words(data, offsets, W.ALPHANUMERIC)
                counts = np.diff(words.first)
                for size in sizes or sorted(set(np.minimum(counts, span).tolist()) - {0}):
                    gram_words = min(k, size)
                    grams = W.grams(words.hashes, gram_words)
                    mine = counts >= size if sizes or size == span else counts == size
                    at = winnow(grams, words.first[:-1][mine],
                                words.first[1:][mine] - gram_words + 1, size - gram_words + 1)
                    owner = np.searchsorted(words.first, at, "right") - 1
                    pairs = np.unique(np.stack([owner.astype(np.uint64), grams[at]]), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[row + pairs[0].astype(np.int64)]),
                         pa.array(np.full(pairs.shape[1], size, np.int32)),
                         pa.array(pairs[1].view(np.int64))], names=["row", "size", "gram"])

    return rows.select("row", text_col).mapInArrow(sign, PRINTS)


def by_join(docs: DataFrame, items: DataFrame, text_col: str, span: int, k: int,
            found_col: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``docs`` with ``found_col``, for items beyond any bound: no task holds all of them.

    The distinct fingerprints of documents and items meet in a join; the documents that
    share one, and the items they share it with, are dealt into parts, in which hits
    are extended. Hot fingerprints are distinct in each document, and their join is
    split by the adaptive skew join.
    """
    row = free_name(docs.columns, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    texts = numbered.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
    items = written(items.withColumn("row", F.monotonically_increasing_id()), "items")
    item_prints = written(fingerprints(items, "text", span, k), "item-fingerprints")
    sizes = [r[0] for r in item_prints.select("size").distinct().orderBy("size").collect()]
    prints = fingerprints(texts, "text", span, k, sizes) if sizes else item_prints.limit(0)
    met = written(prints.join(item_prints.withColumnRenamed("row", "item"), ["size", "gram"])
                  .select("row", "item").distinct(), "met")
    n = met.select("row").distinct().count()
    part = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n // part_rows)))).alias("part")
    left = texts.join(met.select("row").distinct(), "row", "left_semi").select(part, "row", "text")
    right = met.select(part, "item").distinct().join(
        items.select(F.col("row").alias("item"), "item_id", F.col("text").alias("item_text")), "item")

    def extend(mine: pa.Table, others: pa.Table) -> pa.Table:
        mine, others = mine.combine_chunks(), others.combine_chunks()
        names = others.column("item_id").to_pylist()
        rows = []
        if mine.num_rows and others.num_rows:
            indexes, words = build(whole(others.column("item_text")), span, k)
            rows = list(find(whole(mine.column("text")), indexes, words, names))
        return pa.table({"row": mine.column("row") if rows else pa.array([], pa.int64()),
                         "n_words": pa.array([r[0] for r in rows], pa.int64()),
                         "n_hit": pa.array([r[1] for r in rows], pa.int64()),
                         "items": pa.array([r[2] for r in rows], pa.list_(pa.string()))})

    def whole(column: pa.ChunkedArray) -> pa.Array:
        return pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks])

    hits = left.groupBy("part").cogroup(right.groupBy("part")).applyInArrow(extend, FOUND)
    hits = hits.withColumn("found", F.struct("n_words", "n_hit", "items")).select(
        F.col("row").alias(row), F.col("found").alias(found_col))

    def count(column: pa.Array) -> pa.Array:
        return pa.array([int(n) for _, data, offsets in W.chunks(column) for n in np.diff(
            W.split_words(data, offsets, W.ALPHANUMERIC).first)], pa.int64())

    clean = F.struct(F.arrow_udf(count, "bigint")(F.col(text_col)).alias("n_words"),
                     F.lit(0).cast("bigint").alias("n_hit"),
                     F.array().cast("array<string>").alias("items"))
    return numbered.join(hits, row, "left").withColumn(
        found_col, F.coalesce(F.col(found_col), clean)).drop(row)


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  span: int = SPAN_WORDS, k: int = GRAM_WORDS,
                  most_bytes: int = ITEM_BYTES) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with one column added, and the columns that sum it up.

    Returns the frame and ``n_words``, ``n_hit`` and ``items`` (sorted distinct
    ids as strings). Items of at most ``most_bytes`` (measured before they are read)
    are broadcast, and their fingerprints meet those of the documents in one pass
    without a shuffle. Beyond that fingerprints meet in a join (``by_join``). Both
    ways find the same.

    A null text has no words and no hits. An item of fewer words than ``span`` must
    occur whole; one without words or text matches nothing. Items with equal ids
    count once, an item without id marks words and is not named. Without items
    nothing is hit.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))
                           + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 16)).first()[0] or 0
    name = free_name(docs.columns, "found")
    if size > most_bytes:
        found = by_join(docs, items, text_col, span, k, name)
    else:
        rows = items.collect()
        column = in_tasks(docs.sparkSession, [r[0] for r in rows], [r[1] for r in rows], span, k)
        found = docs.withColumn(name, column(F.col(text_col)))
    return found, {c: F.col(name)[c] for c in ("n_words", "n_hit", "items")}


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
