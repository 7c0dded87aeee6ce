"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.llm import words as W
from clipframe.llm.common import give_back, held_out, written

BITS = 20
LOOKED_AT = 4
SAMPLE = 6_000  # labelled documents of each class that are learned from, at most


class Settings(NamedTuple):
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    passes: int = 8
    bits: int = BITS


def features(words: W.Words, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(feature, word position)`` of words, word pairs, and pairs with a word between."""
    hashes, first = words
    shift = np.uint64(64 - bits)
    yield hashes >> shift, np.arange(len(hashes))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes))
    for gap, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        at = np.flatnonzero(left > gap)
        yield W.mix(hashes[at] * np.uint64(factor) + hashes[at + gap]) >> shift, at


def ftrl(documents: list[np.ndarray], labels: np.ndarray, how: Settings) -> tuple[
        np.ndarray, np.ndarray, float]:
    """Indexes and values of the weights that are not zero, and the intercept.

    Each document is a set of features. Rates are per coordinate; a coordinate whose
    accumulated gradient stays within ``l1`` keeps the weight zero.
    """
    z, n = np.zeros(1 << how.bits), np.zeros(1 << how.bits)
    z0 = n0 = 0.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= how.l1, 0.0, (np.sign(z) * how.l1 - z)
                        / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))

    def intercept() -> float:
        return -z0 * how.alpha / (how.beta + n0 ** 0.5)

    for turn in range(how.passes):
        for i in np.random.default_rng(turn).permutation(len(documents)):
            x = documents[i]
            zx, nx = z[x], n[x]
            w, b = weights(zx, nx), intercept()
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = p - labels[i]
            z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / how.alpha * w
            n[x] = nx + g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0 ** 0.5) / how.alpha * b
            n0 += g * g
    w = weights(z, n)
    kept = np.flatnonzero(w)
    return kept, w[kept], float(intercept())


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic)`` of all labelled documents that may be learned from.

    Only documents outside the held-out fifth. A document with several labels counts as
    toxic if one says so; rows with a null id or label are left out, as are labels
    without a document, and one row stands for a repeated id.
    """
    known = (labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
             .filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    return known.join(docs.select(F.col("doc_id").cast("bigint")), "doc_id", "left_semi")


def sample(docs: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` documents of each class of ``learnable``, ``(doc_id, toxic, text)``.

    The choice is by a hash of the id: the lowest of each class. Only several times as
    many as are needed are sorted, whatever the number of tasks.
    """
    chosen = None
    sizes = known.agg(F.count_if(F.col("toxic") <= 0), F.count_if(F.col("toxic") > 0)).first()
    for label, size in enumerate(sizes):
        below = min((1 << 63) - 1, (LOOKED_AT * limit << 64) // max(size, 1) - (1 << 63))
        some = known.filter(((F.col("toxic") > 0) == bool(label))
                            & (F.xxhash64("doc_id") <= below)).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(limit)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    return (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
            .agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))


def prior_shift(known: DataFrame, limit: int) -> float:
    """What turns the log-odds of the classes in a ``sample`` into those of all ``known``.

    0 where no class is cut, and where only one class is known.
    """
    clean, toxic = known.agg(F.count_if(F.col("toxic") <= 0), F.count_if(F.col("toxic") > 0)).first()
    if not clean or not toxic:
        return 0.0
    return float(np.log(toxic / clean) - np.log(min(toxic, limit) / min(clean, limit)))


class Model(NamedTuple):
    index: np.ndarray
    value: np.ndarray
    intercept: float
    bits: int


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE,
        how: Settings = Settings()) -> Model:
    """Learn from a bounded sample in one task; only the non-zero weights come back.

    The limit may cut one class more than the other: the intercept is shifted back to
    the odds of all labelled documents, which are counted. So a probability of 0.5
    means the same at every size of input. Without labelled documents the model has no weights and scores everything by the
    intercept alone: 0.5 without any, so the caller decides (``score`` gives 0 then).
    """
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, found, y = [], [], []
        for batch in batches:
            texts = batch.column(2)
            for row, data, offsets in W.chunks(texts):
                words = W.split_words(data, offsets, W.ALPHANUMERIC)
                sets: list[list[np.ndarray]] = [[] for _ in range(len(offsets) - 1)]
                for values, at in features(words, how.bits):
                    bounds = np.searchsorted(at, words.first)
                    for i, own in enumerate(sets):
                        own.append(values[bounds[i]:bounds[i + 1]])
                found += [np.unique(np.concatenate(own)).astype(np.int32) for own in sets]
            order += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
        by_id = np.argsort(np.array(order, np.int64), kind="stable")
        index, value, intercept = ftrl([found[i] for i in by_id],
                                       np.minimum(np.array(y, float)[by_id], 1), how)
        if not order:
            intercept = -35.0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(index, -1)), pa.array(np.append(value, intercept))],
            names=["index", "value"])
        del found
        give_back()

    known = written(learnable(docs, labels), "learnable")
    rows = sample(docs, known, limit).repartition(1).mapInArrow(
        learn, "index bigint, value double").toPandas()
    if not len(rows):
        return Model(np.empty(0, np.int64), np.empty(0), -35.0, how.bits)
    model = rows[rows["index"] >= 0]
    intercept = float(rows.loc[rows["index"] < 0, "value"].iloc[0])
    return Model(model["index"].to_numpy(), model["value"].to_numpy(),
                 intercept + prior_shift(known, limit), how.bits)


def score(model: Model, spark) -> callable:
    """A column function: the probability of toxic for whole texts; null or empty have the intercept's."""
    shared = spark.sparkContext.broadcast(tuple(model))

    def apply(texts: pa.Array) -> pa.Array:
        index, value, intercept, bits = shared.value
        weights = np.zeros(1 << bits, np.float64)
        weights[index] = value
        result = np.full(len(texts), intercept)
        for row, data, offsets in W.chunks(texts):
            words = W.split_words(data, offsets, W.ALPHANUMERIC)
            keys = []
            for values, at in features(words, bits):
                hit = np.flatnonzero(weights[values])
                owner = np.searchsorted(words.first, at[hit], "right") - 1
                keys.append((owner << bits) + values[hit].astype(np.int64))
            distinct = np.unique(np.concatenate(keys))
            np.add.at(result, row + (distinct >> bits), weights[distinct & ((1 << bits) - 1)])
        give_back()
        return pa.array(1 / (1 + np.exp(-np.clip(result, -35, 35))))

    udf = F.arrow_udf(apply, "double")
    return lambda text: udf(text)


def predicted(probability: Column) -> Column:
    return (probability >= 0.5).cast("int")
