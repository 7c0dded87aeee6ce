"""Language identification with a string kernel, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipframe.llm import words as W
from clipframe.llm.common import give_back, held_out
from clipframe.llm.slices import text_sizes

TRAIN_PER_LANGUAGE = 500
TRAIN_ROWS = 20_000     # of all languages, about
MOST_LANGUAGES = 1_000  # that are learned, the most frequent ones
HASHES = 1 << 40
LOOKED_AT = 4
LANDMARKS = 60          # for each language
MOST_LANDMARKS = 3_000  # of all languages, about
RIDGE = 0.1
FOLDS = 5               # see floor_of
REJECT = 200            # of so many texts of a language one may lie below its floor
MARGIN = 0.25
SHORT_BYTES = 200       # shorter texts say too little to be found of no language
TRIGRAM_BITS = 17
CODES = 256 + 65536 + (1 << TRIGRAM_BITS)
BATCH_ROWS = 64
UNDETERMINED = "und"


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(code, row)`` of every run of one, two and three bytes (lower case) within a row."""
    text = W.LOWER[data].astype(np.int32)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    yield text, row
    if len(text) < 2:
        return
    same = row[:-1] == row[1:]
    pair = (text[:-1] << 8) | text[1:]
    yield (pair + 256)[same], row[:-1][same]
    if len(text) < 3:
        return
    same = row[:-2] == row[2:]
    three = (pair[:-1].astype(np.uint32) << np.uint32(8)) | text[2:].astype(np.uint32)
    three = (three * np.uint32(0x9E3779B1)) >> np.uint32(32 - TRIGRAM_BITS)
    yield (three.astype(np.int32) + 256 + 65536)[same], row[:-2][same]


def presence(texts: pa.Array, place: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(first row, matrix)``: which of ``width`` n-grams occur in each text, as 0 and 1.

    ``place`` maps a code to its column, or to ``width`` if it has none.
    """
    for row, data, offsets in W.chunks(texts):
        for low in range(0, len(offsets) - 1, BATCH_ROWS):
            bounds = offsets[low:low + BATCH_ROWS + 1]
            flags = np.zeros((len(bounds) - 1, width + 1), bool)
            for code, owner in grams(data[bounds[0]:bounds[-1]], bounds - bounds[0]):
                flags[owner, place[code]] = True
            yield row + low, flags[:, :width].astype(np.float32)


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray    # n-gram codes that the landmarks have
    weights: np.ndarray  # n-grams x languages
    floor: np.ndarray | float = -np.inf  # of each language, or one of all: see floor_of


def solve(texts: list[str], labels: list[str], landmarks: int, ridge: float) -> Model:
    """Kernel ridge regression, one language against the rest, on Nyström features.

    The kernel of two texts is the number of n-grams they share, over the geometric
    mean of their own numbers, among the n-grams that occur in a landmark.
    """
    languages = sorted(set(labels))
    landmarks = max(1, min(landmarks, MOST_LANDMARKS // len(languages)))
    y = np.array([languages.index(v) for v in labels])
    chosen = np.sort(np.concatenate([np.flatnonzero(y == i)[:landmarks]
                                     for i in range(len(languages))]))
    seen = np.zeros(CODES, bool)
    for _, data, offsets in W.chunks(pa.array([texts[i] for i in chosen], pa.large_string())):
        for code, _ in grams(data, offsets):
            seen[code] = True
    codes = np.flatnonzero(seen)
    place = np.full(CODES, len(codes), np.int32)
    place[codes] = np.arange(len(codes))
    # no more than the landmarks' rows and one block are held, whatever the number of texts
    def unit(some: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        for row, x in presence(pa.array(some, pa.large_string()), place, len(codes)):
            x /= np.maximum(np.sqrt(x.sum(axis=1, keepdims=True)), 1)
            yield row, x

    z = np.empty((len(chosen), len(codes)), np.float32)
    for row, x in unit([texts[i] for i in chosen]):
        z[row:row + len(x)] = x
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.empty((len(texts), root.shape[1]))
    for row, x in unit(texts):
        phi[row:row + len(x)] = (x @ z.T).astype(np.float64) @ root
    share = np.bincount(y, minlength=len(languages))[y]
    weight = (len(y) / len(languages) / share)[:, None]  # languages count alike
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    w = np.linalg.solve(phi.T @ (weight * phi) + ridge * np.eye(phi.shape[1]),
                        phi.T @ (weight * target))
    return Model(languages, codes, (z.T.astype(np.float64) @ (root @ w)).astype(np.float32))


def values_of(texts: pa.Array, codes: np.ndarray, weights: np.ndarray) -> Iterator[
        tuple[int, np.ndarray]]:
    """``(first row, matrix)``: the regression value of each language for each text."""
    place = np.full(CODES, len(codes), np.int32)
    place[codes] = np.arange(len(codes))
    for row, x in presence(texts, place, len(codes)):
        size = np.maximum(np.sqrt(x.sum(axis=1, keepdims=True)), 1)
        yield row, (x @ weights / size).astype(np.float64)


def floor_of(texts: list[str], labels: list[str], landmarks: int, ridge: float) -> np.ndarray:
    """For each language what its texts should not fall below, from texts not learned from.

    Every text takes its turn: a fifth of each language is judged by a model of the rest.
    Left out are texts that no floor is asked about, the short ones and those without a
    letter, and the only text of a language, which the model of the rest cannot know.
    Of further texts found to be of a language one in ``REJECT`` is expected below its floor.
    A language with fewer texts than that has the floor of all, or its worst text if that is
    lower; of few texts in all the floor lies below the worst, by ``MARGIN`` at least.
    """
    languages = sorted(set(labels))
    seen = dict.fromkeys(languages, 0)
    turn = []
    for label in labels:
        turn.append(seen[label] % FOLDS)
        seen[label] += 1
    asked = [len(t.encode()) >= SHORT_BYTES and any(map(str.isalpha, t)) and seen[v] > 1
             for t, v in zip(texts, labels)]
    judged: dict[str, list[float]] = {v: [] for v in languages}
    for fold in range(FOLDS):
        mine = [i for i, t in enumerate(turn) if t != fold]
        other = [i for i, t in enumerate(turn) if t == fold and asked[i]]
        if not other:
            continue
        model = solve([texts[i] for i in mine], [labels[i] for i in mine], landmarks, ridge)
        for _, values in values_of(pa.array([texts[i] for i in other], pa.large_string()),
                                   model.codes, model.weights):
            for best, value in zip(values.argmax(axis=1), values.max(axis=1)):
                judged[model.languages[best]].append(value)
        del model  # before the next one
    whole = np.sort(np.concatenate([np.empty(0), *judged.values()]))
    floors = np.full(len(languages), -np.inf)
    for i, language in enumerate(languages):
        own = np.sort(judged[language])
        if len(own) >= REJECT:
            floors[i] = own[(len(own) + 1) // REJECT - 1]
        elif len(whole) >= REJECT:
            floors[i] = min([whole[(len(whole) + 1) // REJECT - 1], *own[:1]])
        elif len(whole):
            some = own if len(own) else whole
            floors[i] = some[0] - max(MARGIN, (np.median(some) - some[0]) / 2)
    return floors


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` documents of each language, ``(doc_id, lang, text)``.

    Only rows with text and language outside the held-out fifth, chosen by a hash of
    the id (ties by the id) in one pass over the ids, of which few more are sent on than
    are needed; one row stands for a repeated id, all of which count. The
    ``MOST_LANGUAGES`` most frequent languages are learned, the first by name of equal
    ones; with many languages each has fewer documents, so that all have about
    ``TRAIN_ROWS``.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "lang", "text").filter(
        "doc_id is not null and lang is not null and text is not null").filter(
            ~held_out(F.col("doc_id")))
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "lang").limit(MOST_LANGUAGES)
    languages = [(r["lang"], r["n"]) for r in counted.collect()]
    if not languages:
        return rows.filter("false")
    each = max(1, min(per_language, TRAIN_ROWS // len(languages)))
    # of a frequent language only the lowest hashes are looked at, several times as many
    # as are needed, whatever the number of tasks
    known = docs.sparkSession.createDataFrame(
        [(v, min(HASHES, -(-HASHES * LOOKED_AT * each // n))) for v, n in languages],
        "lang string, below bigint")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES))
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    chosen = rows.join(F.broadcast(known), "lang").filter(place < F.col("below")).select(
        "doc_id", F.row_number().over(order).alias("place")).filter(F.col("place") <= each)
    return (rows.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
            .join(F.broadcast(known.select("lang")), "lang").groupBy("doc_id")
            .agg(F.min("lang").alias("lang"), F.min("text").alias("text")))


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> Model:
    """Learn in one task from the bounded sample; the weights come back, not the texts.

    Without any labelled text the model knows no language.
    """
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        if rows:
            texts, labels = [r[2] for r in rows], [r[1] for r in rows]
            model = solve(texts, labels, landmarks, ridge)._replace(
                floor=floor_of(texts, labels, landmarks, ridge))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(model))])], ["model"])
        give_back()  # the worker lives on beside those that judge

    got = sample(docs, per_language).repartition(1).mapInArrow(learn, "model binary").first()
    if got is None:
        return Model([], np.empty(0, np.int64), np.empty((0, 0), np.float32))
    import pickle

    return Model(*pickle.loads(bytes(got[0])))


RESULT = "struct<lang_pred:string,score:double,accepted:boolean>"


def predict(model: Model, spark) -> callable:
    """A column function ``text -> struct(lang_pred, score, accepted)``, on whole texts.

    ``und`` with score 0 if the text is null, has no letter, or no language was
    learned. The score is the softmax share of the best language's regression value;
    of equal values the first language by name wins. Accepted are texts of a language
    whose value is not below its floor (see ``floor_of``), or that are short. Equal texts
    have equal results, repeated rows included; a text of any length is judged whole, in
    chunks of rows.
    """
    shared = spark.sparkContext.broadcast(tuple(model))

    def apply(texts: pa.Array, letters: pa.Array) -> pa.Array:
        languages, codes, weights, floor = shared.value
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        accepted = np.zeros(len(texts), bool)
        floors = np.broadcast_to(floor, len(languages))
        short = text_sizes(texts) < SHORT_BYTES
        known = letters.to_pylist()
        if languages:
            for row, values in values_of(texts, codes, weights):
                share = np.exp(4 * (values - values.max(axis=1, keepdims=True)))
                share /= share.sum(axis=1, keepdims=True)
                for i, best in enumerate(values.argmax(axis=1)):
                    if known[row + i]:
                        names[row + i], scores[row + i] = languages[best], share[i, best]
                        accepted[row + i] = values[i, best] >= floors[best] or short[row + i]
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores), pa.array(accepted)],
            names=["lang_pred", "score", "accepted"])

    udf = F.arrow_udf(apply, RESULT)
    return lambda text: udf(text, F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score, accepted)`` of every row, see :func:`predict`."""
    found: Column = predict(model, docs.sparkSession)(F.col("text"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")
