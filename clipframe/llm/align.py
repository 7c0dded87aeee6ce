"""Alignment of the tokens of two tokenizers, by the bytes they cover.

Both sides are encoded; in a batch, ``pandas.merge_asof`` keyed by document finds for
each token start the other side's token that covers it, once in either direction. The
union of both are the overlaps, and tokens that begin together cut the text into
groups. How many documents hold a pair of ids linked is counted over the whole corpus:
a slice of documents sends each of its pairs once, and the counts come back to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipframe.llm import tokens as tk
from clipframe.llm import words as W
from clipframe.llm.common import give_back, written
from clipframe.llm.slices import buffers_of, from_planes, planes, runs

SLICE_BYTES = 8 << 20
BATCH_BYTES = 1 << 20   # of text whose tokens meet in one merge
REMEMBERED = 500_000    # parts, with the ids of both sides
WORD_START = "▁"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
LOOKUPS = ("slice bigint, number int, pair bigint, docs bigint, ids array<bigint>, "
           "metrics binary, digests binary, per_doc binary, place binary, links binary")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
          "n_best bigint, count_sum bigint, groups_sha256 string")


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others in ascending order for the
    characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """The first side: a byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.encoder = tk.Encoder(path, plain=True)
        self.by_parts = self.encoder.by_parts
        alphabet = byte_alphabet()
        vocabulary = self.encoder.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes[i] = bytes(alphabet[c] for c in piece if c in alphabet)

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.by_parts:
            return self.encoder.distinct(parts)
        return flat([x.tolist() for x in self.encoder.whole([p.decode() for p in parts])])


class Pieces:
    """The second side: pieces of a model that puts a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i)
                      else p.replace(WORD_START, " ").encode() for i, p in enumerate(pieces)]
        # Only then do blanks and line feeds part what is merged
        self.lead = self.model.encode("\n")
        self.by_parts = (len(self.lead) == 2 and self.bytes[self.lead[0]] == b" "
                         and not any(WORD_START in p.lstrip(WORD_START) or "\n" in p
                                     for p in pieces))

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts. One without a blank of its own follows a line feed, which is cut off."""
        own = [p[:1] == b" " for p in parts]
        ids = self.model.encode([p[1:].decode() if o else "\n" + p.decode()
                                 for p, o in zip(parts, own)], num_threads=1)
        if not all(o or x[:2] == self.lead for x, o in zip(ids, own)):
            raise ValueError("the model does not keep line feeds apart")
        return flat([x if o else x[2:] for x, o in zip(ids, own)])


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return (np.fromiter((i for x in ids for i in x), np.uint32),
            np.array([len(x) for x in ids], np.int64))


class Sides:
    """Both tokenizers, with the ids of parts remembered."""

    def __init__(self, first: str, second: str):
        self.sides = ByteLevel(first), Pieces(second)
        self.by_parts = all(s.by_parts for s in self.sides)
        self.memory = tk.Memory(*(s.encode for s in self.sides), limit=REMEMBERED)
        self.sizes = [np.array([len(b) for b in s.bytes], np.int64) for s in self.sides]
        self.codes = [len(s.bytes) for s in self.sides]
        if self.codes[0] * self.codes[1] > 1 << 32:
            raise ValueError("the vocabularies have more than 2 ** 32 pairs of ids")
        # what an id adds to the text of groups: first or later token of a group, either side
        self.shown = pa.array([f"{mark}{i}".encode() for mark, n in zip(
            (";", ",", "|", ","), np.repeat(self.codes, 2)) for i in range(n)], pa.binary())

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts (each begins with a blank) and how many each text has, for either side.

        Texts whose bytes a side does not give back have no tokens.
        """
        starts = tk.cuts(data, offsets) if self.by_parts else offsets[:-1]
        numbers = self.memory.numbers(data, starts)
        first = np.searchsorted(starts, offsets)
        sides, good = [], np.ones(len(offsets) - 1, bool)
        for k, side in enumerate(self.sides):
            ids, counts = self.memory.ids(k, numbers)
            at = np.concatenate([[0], np.cumsum(counts)])[first]
            covered = np.concatenate([[0], np.cumsum(self.sizes[k][ids])])[at]
            good &= np.diff(covered) == np.diff(offsets)
            sides.append((ids, at))
        for i in np.flatnonzero(good):
            if not self.sure(numbers[first[i]:first[i + 1]]):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                good[i] = all(b"".join([side.bytes[x] for x in ids[at[i]:at[i + 1]]]) == text
                              for side, (ids, at) in zip(self.sides, sides))
        out = []
        for ids, at in sides:
            counts = np.diff(at)
            out.append((ids[np.repeat(good, counts)], np.where(good, counts, 0)))
        return out

    def sure(self, numbers: np.ndarray) -> bool:
        """Whether both sides give back the bytes of all these parts, one by one."""
        if len(self.checked) != len(self.memory.known) or self.memory.known is not self.seen:
            begin = len(self.checked) if self.memory.known is self.seen else 0
            checked = np.ones(len(self.memory.known), bool)
            checked[:begin] = self.checked[:begin]
            names = list(self.memory.known)[begin:]
            for k, side in enumerate(self.sides):
                ids, counts = self.memory.ids(k, np.arange(begin, len(checked)))
                ends = np.cumsum(counts)
                pieces = [side.bytes[i] for i in ids.tolist()]
                checked[begin:] &= [b"".join(pieces[e - c:e]) == name for e, c, name in zip(
                    ends.tolist(), counts.tolist(), names)]
            self.checked, self.seen = checked, self.memory.known
        return bool(self.checked[numbers].all())

    checked = np.empty(0, bool)
    seen: dict | None = None


class Aligned(NamedTuple):
    metrics: np.ndarray   # n_a, n_b, n_groups, n_links of each text
    groups: list[bytes]   # the text of the groups, empty without tokens
    doc: np.ndarray       # of each link
    pair: np.ndarray      # code of both ids of each link


def align(sides: Sides, data: np.ndarray, offsets: np.ndarray) -> Aligned:
    """Links and groups of texts that lie end to end, each with a blank before it."""
    texts = len(offsets) - 1
    (ids_a, n_a), (ids_b, n_b) = sides.tokens(data, offsets)
    doc_a, doc_b = (np.repeat(np.arange(texts), n) for n in (n_a, n_b))
    start_a, start_b = (np.cumsum(size[ids]) - size[ids]
                        for size, ids in zip(sides.sizes, (ids_a, ids_b)))
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(ids_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(ids_b))})
    if not len(a):
        return Aligned(np.zeros((texts, 4), np.int64), [b""] * texts, np.empty(0, np.int64),
                       np.empty(0, np.int64))
    covering_b = pd.merge_asof(a, b, on="start", by="doc")["b"].to_numpy(np.int64)
    covering_a = pd.merge_asof(b, a, on="start", by="doc")["a"].to_numpy(np.int64)
    # tokens that begin together are in both directions; both end there what went before
    new_a = start_b[covering_b] == start_a
    new_b = start_a[covering_a] == start_b
    only_b = np.flatnonzero(~new_b)
    link_a = np.concatenate([np.arange(len(ids_a)), covering_a[only_b]])
    link_b = np.concatenate([covering_b, only_b])
    doc = np.concatenate([doc_a, doc_b[only_b]])
    pair = ids_a[link_a].astype(np.int64) * sides.codes[1] + ids_b[link_b]
    metrics = np.stack([n_a, n_b, np.bincount(doc_a[new_a], minlength=texts),
                        np.bincount(doc, minlength=texts)], axis=1)
    # a group is written as its tokens of one side, then those of the other
    first_a, first_b = np.flatnonzero(new_a), np.flatnonzero(new_b)
    group_a, group_b = np.cumsum(new_a) - 1, np.cumsum(new_b) - 1
    sequence = np.empty(len(ids_a) + len(ids_b), np.int64)
    sequence[np.arange(len(ids_a)) + first_b[group_a]] = np.where(
        new_a, ids_a, sides.codes[0] + ids_a)
    sequence[np.arange(len(ids_b)) + np.append(first_a, len(ids_a))[group_b + 1]] = (
        2 * sides.codes[0] + np.where(new_b, ids_b, sides.codes[1] + ids_b))
    shown, sizes = buffers_of(sides.shown.take(pa.array(sequence)))
    shown = shown.tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n_a + n_b)])]
    groups = [shown[x + 1:y] for x, y in zip(ends.tolist(), ends[1:].tolist())]
    return Aligned(metrics, groups, doc, pair)


def blanked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with text, and their texts with a blank before each, end to end."""
    data, sizes = buffers_of(texts)
    rows = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[rows] + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - sizes[rows] - 1] = False
    out[inside] = data
    return rows, out, np.concatenate([[0], ends])


def lookups(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Alignments of ``docs (doc_id, text)`` by slice, schema ``LOOKUPS``.

    For each pair of ids linked in a slice a row with the number of its documents; and
    one row without number with the measures of each document and the pairs it links.
    """
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
             *[pa.binary()] * 5]
    schema = pa.schema(list(zip((c.split()[0] for c in LOOKUPS.split(", ")), kinds)))

    def batch(**columns: pa.Array) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def of_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides = tk.worker_state(f"sides:{first}:{second}", lambda: Sides(first, second))
        number = TaskContext.get().partitionId() << 32
        for table in runs(batches, 1, SLICE_BYTES):
            metrics, digests, keys, counts = [], [], [], []
            texts = table.column(1).combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            for row, _, offsets in W.chunks(texts, BATCH_BYTES):
                rows, data, at = blanked(texts.slice(row, len(offsets) - 1))
                own = np.zeros((len(offsets) - 1, 4), np.int64)
                shown = [b"\0" * 32] * (len(offsets) - 1)
                if len(rows):
                    found = align(sides, data, at)
                    own[rows] = found.metrics
                    for i, text in zip(rows, found.groups):
                        shown[i] = hashlib.sha256(text).digest()
                    key, n = np.unique((rows[found.doc] + row) << 32 | found.pair,
                                       return_counts=True)
                    keys.append(key)
                    counts.append(n)
                metrics.append(own)
                digests += shown
            key = np.concatenate([*keys, np.empty(0, np.int64)]).astype(np.int64)
            pairs, place, docs = np.unique(key & 0xFFFFFFFF, return_inverse=True,
                                           return_counts=True)
            order = np.argsort(-docs, kind="stable")  # frequent pairs get small numbers
            rank = np.empty(len(pairs), np.int64)
            rank[order] = np.arange(len(pairs))
            for low in range(0, len(pairs), 50_000):
                some = order[low:low + 50_000]
                yield batch(slice=pa.array(np.full(len(some), number)),
                            number=pa.array(np.arange(low, low + len(some)).astype(np.int32)),
                            pair=pa.array(pairs[some]), docs=pa.array(docs[some]))
            yield batch(
                slice=pa.array([number]),
                ids=pa.array([table.column(0).to_pylist()], pa.list_(pa.int64())),
                metrics=pa.array([planes(np.concatenate(metrics).ravel(), "<u8")]),
                digests=pa.array([b"".join(digests)]),
                per_doc=pa.array([planes(np.bincount(key >> 32, minlength=table.num_rows))]),
                place=pa.array([planes(rank[place])]),
                links=pa.array([planes(np.concatenate([*counts, np.empty(0, np.int64)]))]))
            number += 1
            give_back()

    return docs.mapInArrow(of_slices, LOOKUPS)


def alignments(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Schema ``RESULT``: one row for each row of ``docs (doc_id, text)``.

    ``first`` is a byte-level tokenizer file, which encodes a blank and the text,
    ``second`` a sentencepiece model, which adds that blank. Special strings in texts
    are plain text. ``count_sum`` adds up, over the links of a document, how many
    documents of the corpus link the two ids; ``n_best`` counts those links where
    no other id is linked to the first side's id in more documents (ties count).

    A text that is null or empty, or whose bytes either side does not give back, has no
    tokens: zeros and an empty digest. Repeated rows and null ids are documents like
    others. Long texts are read whole; one longer than a slice is a slice of its own.
    Other columns are not read. An empty table gives an empty result.
    """
    held = written(lookups(docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")),
        first, second), "alignments")
    pairs = held.filter("number is not null").select("slice", "number", "pair", "docs")
    # the second side's vocabulary bounds the pairs of an id; hot ones are summed before
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    width = F.lit(second_codes(second))
    valued = counts.withColumn("best", F.col("count") == F.max("count").over(
        Window.partitionBy(F.floor(F.col("pair") / width))))
    answers = pairs.join(valued, "pair").select(
        F.col("slice").alias("of_slice"), "number", "count", "best")
    rows = held.filter("number is null").drop("number", "pair", "docs")

    def add(_, row: pa.Table, answers: pa.Table) -> pa.Table:
        row = row.to_pylist()[0]
        number = answers.column("number").to_numpy()
        count, best = np.zeros((2, len(number)), np.int64)
        count[number] = answers.column("count").to_numpy()
        best[number] = answers.column("best").to_numpy(zero_copy_only=False)
        place, links, per_doc = (from_planes(row[c]).astype(np.int64)
                                 for c in ("place", "links", "per_doc"))
        edges = np.concatenate([[0], np.cumsum(per_doc)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[place] * links)])[edges])
                for x in (best, count)]
        metrics = from_planes(row["metrics"], "<u8").astype(np.int64).reshape(-1, 4)
        digests = [row["digests"][i:i + 32].hex() if n else "" for i, n in zip(
            range(0, len(row["digests"]), 32), metrics[:, 0].tolist())]
        return pa.table([pa.array(row["ids"], pa.int64()), *map(pa.array, metrics.T.copy()),
                         *map(pa.array, sums), pa.array(digests, pa.string())],
                        names=[c.split()[0] for c in RESULT.split(", ")])

    return rows.groupBy("slice").cogroup(answers.groupBy("of_slice")).applyInArrow(add, RESULT)


def second_codes(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).vocab_size()
