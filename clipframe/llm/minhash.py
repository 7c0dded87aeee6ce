"""MinHash fingerprints of word shingles, bands joined in Spark, Jaccard verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.llm import words as W
from clipframe.llm.common import components, written

SHINGLE_WORDS = 5
PERMUTATIONS = 128
BAND_ROWS = 4
FEW_PAIRS = 50_000  # whose ids are broadcast to find their texts
BAND_PART = 1_000  # members of a band that meet its lead, or each other, in one part
PART_SHINGLES = 1_000_000  # of these members, about
CROWD = 32         # a band of more members gives no pairs of them
MISSED = 1e-9      # probability of a linked pair whose signatures are not looked at further


def signatures(texts: pa.Array, k: int, permutations: int,
               named: list | None = None) -> np.ndarray:
    """16 bits of the smallest value of each permutation, for every row.

    Permutations are multiply-add-shift universal hashes of the 64-bit shingles. A
    row without words has the same signature as any other such row and no other. The
    name and size of each row's set of shingles are added to ``named``, if given.
    """
    multiply = W.stream(3, permutations) | np.uint64(1)
    add = W.stream(4, permutations)
    result = np.full((len(texts), permutations), 0xFFFFFFFF, np.uint64)
    for row, data, offsets in W.chunks(texts):
        values, at = W.shingles(W.split_words(data, offsets, W.BLANK_SEPARATED), k)
        if named is not None:
            for a, b in zip(at, at[1:]):
                own = np.unique(values[a:b])
                named.append((hashlib.md5(own.tobytes()).digest(), len(own)))
        some = np.flatnonzero(np.diff(at))
        if not len(some):
            continue
        starts, image = at[some], np.empty_like(values)
        for j in range(permutations):
            np.multiply(values, multiply[j], out=image)
            image += add[j]
            image >>= np.uint64(32)
            result[row + some, j] = np.minimum.reduceat(image, starts)
    mixed = W.mix(result + np.uint64(1)).astype(np.uint16)
    return mixed


def as_bytes(signature: np.ndarray) -> pa.Array:
    return pa.array([row.astype(">u2").tobytes() for row in signature], pa.binary())


def sketches(signature: np.ndarray) -> pa.Array:
    """Two bits of each signature value, as 64-bit words: all low bits, then all high bits."""
    rows, n = signature.shape
    words = [np.packbits(np.pad(signature >> bit & 1, ((0, 0), (0, -n % 64))).astype(np.uint8), axis=1)
             .view(np.int64) for bit in (0, 1)]
    return pa.array(list(np.concatenate(words, axis=1)), pa.list_(pa.int64()))


def differing(a: str, b: str, permutations: int) -> Column:
    """In how many places two sketches differ."""
    words = -(-permutations // 64)
    x, y = F.col(a), F.col(b)
    return sum((F.bit_count(x[i].bitwiseXOR(y[i]).bitwiseOR(x[words + i].bitwiseXOR(y[words + i])))
                for i in range(words)), F.lit(0))


def _compare(ids: list, own: list[str], after: list[str], k: int,
             permutations: int) -> pa.RecordBatch:
    """Fingerprints of texts and of their edited forms, given the text that follows each."""
    edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(own, after)]
    named: list = []
    signature = signatures(pa.array([*own, after[-1]], pa.large_string()), k, permutations, named)
    mine, following = signature[:-1], signature[1:]
    changed = signatures(pa.array(edited, pa.large_string()), k, permutations)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).digest() for t in edited], pa.binary()),
        as_bytes(mine), as_bytes(changed),
        pa.array((mine == changed).mean(axis=1)), pa.array((mine == following).mean(axis=1)),
        pa.array([x for x, _ in named[:-1]], pa.binary()),
        pa.array([n for _, n in named[:-1]], pa.int64()), sketches(mine),
    ], names=RESULT)


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
          "near_edited", "near_next", "set_name", "set_size", "set_sketch"]
SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, "
          "edited_fingerprint binary, near_edited double, near_next double, set_name binary, "
          "set_size bigint, set_sketch array<bigint>")
EDGE = "edge int, first_id bigint, first_text string, last_id bigint, last_text string"


def compare_with_next(docs: DataFrame, k: int = SHINGLE_WORDS,
                      permutations: int = PERMUTATIONS) -> DataFrame:
    """Fingerprints in hexadecimal digits, see :func:`fingerprints`."""
    return shown(fingerprints(docs, k, permutations))


def shown(found: DataFrame) -> DataFrame:
    return found.select(
        *[F.lower(F.hex(c)).alias(c) if kind == "binary" else c
          for c, kind in found.dtypes if not c.startswith("set_")])


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS,
                 permutations: int = PERMUTATIONS) -> DataFrame:
    """Fingerprint every text, its edited form and its likeness to the next document.

    ``set_name`` and ``set_size`` are those of the text's set of shingles, ``set_sketch`` has
    two bits of each value of its signature.

    The rows are sorted by ``doc_id`` in ranges; neighbours in a range meet in its
    task. Only the first and last document of each range are joined afterwards, as
    many rows as there are partitions. Null texts are empty; rows with equal or null
    ids are ordered by text, nulls first; a single row is followed by itself. Texts
    without words are like each other (1.0) and like no other text. An empty table
    gives an empty result.
    """
    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head, held_id, held = None, None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, texts = (part.column(i).to_pylist() for i in (0, 1))
                texts = [t or "" for t in texts]
                if head is None:
                    head = (ids[0], texts[0])
                else:
                    ids, texts = [held_id, *ids], [held, *texts]
                if len(ids) > 1:
                    yield padded(_compare(ids[:-1], texts[:-1], texts[1:], k, permutations))
                held_id, held = ids[-1], texts[-1]
        if head is not None:
            row = (TaskContext.get().partitionId(), *head, held_id, held)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, t) for t in result_types),
                 *(pa.array([v], t) for v, t in zip(row, edge_types))], names=names)

    result_types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
                    pa.float64(), pa.float64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    edge_types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    names = RESULT + ["edge", "first_id", "first_text", "last_id", "last_text"]

    def padded(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.nulls(batch.num_rows, t) for t in edge_types)], names=names)

    rows = written(
        docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text").mapInArrow(neighbours, f"{SCHEMA}, {EDGE}"),
        "fingerprints")
    edges = rows.filter("edge is not null").selectExpr(
        "edge", "first_text", "last_id", "last_text")
    order = edges.select("edge").selectExpr(
        "edge", "coalesce(lead(edge) over (order by edge), min(edge) over ()) as next_edge")
    pairs = (edges.join(order, "edge").select("last_id", "last_text", "next_edge")
             .join(edges.selectExpr("edge as next_edge", "first_text"), "next_edge")
             .select("last_id", "last_text", "first_text"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _compare([row["last_id"]], [row["last_text"]], [row["first_text"]],
                               k, permutations)

    return rows.filter("edge is null").select(*RESULT).union(
        written(pairs.mapInArrow(ends, SCHEMA), "edges"))


def least_matches(threshold: float, permutations: int) -> int:
    """Places in which sketches of two sets at the threshold agree but for ``MISSED`` of pairs."""
    from math import comb

    below, same = 0.0, threshold + (1 - threshold) / 4  # two bits also agree by chance
    for n in range(permutations + 1):
        below += comb(permutations, n) * same ** n * (1 - same) ** (permutations - n)
        if below > MISSED:
            return n
    return permutations


def spanning(ids: np.ndarray, side: np.ndarray, label: np.ndarray, sketch: np.ndarray,
             sets: list[np.ndarray], threshold: float, most: int) -> list[tuple[int, int]]:
    """Links between members that join their components as all links do.

    Members of one side are not compared, unless there is but one side. Sets are those
    of whole texts; two are looked at if their sketches differ in ``most`` places at most.
    """
    words, label = sketch.shape[1] // 2, np.unique(label, return_inverse=True)[1]
    size = np.array([len(s) for s in sets])
    begin = np.cumsum(size) - size
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    mine, two, edges = np.zeros(len(values), bool), len(np.unique(side)) > 1, []
    for i in range(len(sets) - 1):
        differ = (sketch[i] ^ sketch[i + 1:]).view(np.uint64)
        near = np.bitwise_count(differ[:, :words] | differ[:, words:]).sum(axis=1) <= most
        near &= label[i + 1:] != label[i]
        near &= np.minimum(size[i + 1:], size[i]) / np.maximum(size[i + 1:], size[i]) >= threshold
        if two:
            near &= side[i + 1:] != side[i]
        other = i + 1 + np.flatnonzero(near)
        if not len(other):
            continue
        mine[code[begin[i]:begin[i] + size[i]]] = True
        first = np.cumsum(size[other]) - size[other]
        at = np.repeat(begin[other] - first, size[other]) + np.arange(size[other].sum())
        both = np.add.reduceat(mine[code[at]], first, dtype=np.int64)
        mine[code[begin[i]:begin[i] + size[i]]] = False
        other = other[both / (size[i] + size[other] - both) >= threshold]
        reached, where = np.unique(label[other], return_index=True)
        edges += [(int(ids[i]), int(ids[j])) for j in other[where]]
        label[np.isin(label, reached)] = label[i]
    return edges


def crowd_links(members: DataFrame, texts: DataFrame, k: int, threshold: float,
                permutations: int, most: int) -> DataFrame:
    """Links ``(a, b)`` within bands of many members that join components as all links do.

    ``members (band, id, name, sketch, component, size)``. The members of a band are dealt in
    parts of bounded size and any two parts meet in a task, which compares all their
    pairs and gives a spanning forest of the links. So the rows are members, not pairs.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sets = [s.tobytes() for s in W.shingle_sets(batch.column(0).slice(at, 500), k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.md5(s).digest() for s in sets], pa.binary()),
                     pa.array(sets, pa.binary())], names=["name", "shingles"])

    def meet(rows: pa.Table) -> pa.Table:
        # by id, whatever the order of arrival
        rows = rows.sort_by("id").combine_chunks()
        ids, side, label = (rows.column(c).to_numpy() for c in ("id", "part", "component"))
        sketch = np.array(rows.column("sketch").to_pylist(), np.int64)
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows.column("shingles")]
        edges = spanning(ids, side, label, sketch, sets, threshold, most)
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()),
                         "b": pa.array([b for _, b in edges], pa.int64())})

    members = written(members.select("band", "id", "name", "sketch", "component", "size"), "crowds")
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    sets = written(texts.join(ids, "doc_id", "left_semi").select("text").mapInArrow(
        hashed, "name binary, shingles binary").dropDuplicates(["name"]), "sets")
    parts = members.groupBy("band").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BAND_PART), F.ceil(F.sum("size") / PART_SHINGLES)).cast(
            "int").alias("parts"))
    dealt = (members.drop("size").join(parts, "band").join(sets, "name")
             .withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))))
    return written(dealt.select(
        "band", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"),
        "part", "id", "component", "sketch", "shingles").groupBy("band", "x", "y").applyInArrow(
            meet, "a bigint, b bigint"), "links")


def near_duplicates(docs: DataFrame, threshold: float = 0.75, k: int = SHINGLE_WORDS,
                    permutations: int = PERMUTATIONS, band_rows: int = BAND_ROWS,
                    signed: DataFrame | None = None) -> DataFrame:
    """``(doc_id, component_id)`` of non-null, distinct ids; texts without words stay alone.

    Equal shingle sets are one class. Any two classes that share a band of their
    signatures are compared, unless a chain of links joins them already: first with
    the band's smallest class, then, in bands of at most ``CROWD`` members, pair by pair,
    at last in larger bands block by block (``crowd_links``). So no band gives more pairs than a
    fixed number of times its members. 32 bands of 4 find a pair at 0.75 with probability above
    0.99999. Every pair is verified on whole shingle sets, but those whose sketches agree in so
    few places that a pair at the threshold does so with a probability below ``MISSED``.

    ``signed`` are the :func:`fingerprints` of the same rows, if there are any. Rows that
    repeat an id each have a row; unlike texts of one id are classes of their own, and of
    classes of one smallest id all follow the links of either. Long texts are read whole.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, named = batch.slice(at, 500), []
                signature = signatures(part.column(1), k, permutations, named)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in named], pa.binary()),
                     pa.array([n for _, n in named], pa.int64()), as_bytes(signature),
                     sketches(signature)],
                    names=["doc_id", "set_name", "set_size", "fingerprint", "set_sketch"])

    texts = docs.select(F.col("doc_id").cast("bigint"), "text").filter("doc_id is not null")
    if signed is None:
        signed = written(texts.mapInArrow(
            sign, "doc_id bigint, set_name binary, set_size bigint, fingerprint binary, "
                  "set_sketch array<bigint>"), "signatures")
    signed = signed.filter("doc_id is not null").select(
        "doc_id", F.col("set_name").alias("key"), F.col("set_size").alias("size"), "fingerprint",
        F.col("set_sketch").alias("sketch"))
    classes = written(signed.filter("size > 0").groupBy("key").agg(
        F.min("doc_id").alias("id"), F.first("size").alias("size"),
        F.first("fingerprint").alias("fingerprint"), F.first("sketch").alias("sketch")), "classes")
    named = classes.select("id", F.col("key").alias("name"), "sketch")
    bands = F.transform(F.sequence(F.lit(0), F.lit(permutations // band_rows - 1)),
                        lambda j: F.xxhash64(j, F.substring(
                            "fingerprint", j * (2 * band_rows) + 1, F.lit(2 * band_rows))))
    banded = classes.select("id", "size", F.explode(bands).alias("band"))
    shared = banded.groupBy("band").agg(
        F.min("id").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    members = written(banded.join(shared, "band").select(
        "band", "id", "size", "n", (F.col("id") == F.col("lead")).alias("leads"))
        .join(named, "id"), "members")

    @F.arrow_udf("double")
    def jaccard(left: pa.Array, right: pa.Array, names: pa.Array, others: pa.Array) -> pa.Array:
        out = []
        found = left.dictionary_encode()  # rows of one lead follow each other
        sets = list(W.shingle_sets(found.dictionary, k))
        own = [hashlib.md5(s.tobytes()).digest() for s in sets]
        for i, y, name, other in zip(found.indices.to_pylist(), W.shingle_sets(right, k),
                                     names.to_pylist(), others.to_pylist()):
            if own[i] != name or hashlib.md5(y.tobytes()).digest() != other:
                out.append(0.0)  # another text of a repeated id
                continue
            both = len(np.intersect1d(sets[i], y, assume_unique=True))
            out.append(both / (len(sets[i]) + len(y) - both))
        return pa.array(out, pa.float64())

    def similar(pairs: DataFrame, n: int) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        own = texts.join(F.broadcast(ids) if n <= FEW_PAIRS else ids, "doc_id", "left_semi")
        left, right = (own.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
                       for c in ("a", "b"))
        return pairs.join(right, "b").join(left, "a").filter(
            jaccard("text_a", "text_b", "name_a", "name_b") >= threshold).select("a", "b").distinct()

    most = permutations - least_matches(threshold, permutations)

    def links(now: DataFrame, leads: Column) -> DataFrame:
        """Of members of a band with each of its leads; many members are dealt in parts."""
        parts = F.ceil(F.col("n") / BAND_PART)
        ahead = now.filter(leads).select(
            "band", F.col("id").alias("lead"), F.col("size").alias("lead_size"),
            F.col("name").alias("lead_name"), F.col("sketch").alias("lead_sketch"),
            F.col("component").alias("lead_component"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"))
        pairs = written(
            now.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), parts))
            .join(ahead, ["band", "part"])
            .filter((F.col("component") != F.col("lead_component"))
                    & (F.col("id") > F.col("lead"))
                    & (F.least("size", "lead_size") / F.greatest("size", "lead_size")
                       >= threshold) & (differing("sketch", "lead_sketch", permutations) <= most))
            .select(F.col("lead").alias("a"), F.col("id").alias("b"),
                    F.col("lead_name").alias("name_a"), F.col("name").alias("name_b"))
            .distinct(), "pairs")
        n = pairs.count()
        return written(similar(pairs, n), "links") if n else pairs.select("a", "b")

    def crowds(now: DataFrame) -> DataFrame:
        return crowd_links(now, texts, k, threshold, permutations, most)

    found = docs.sparkSession.createDataFrame([], "id bigint, component bigint")
    few = F.col("n") <= CROWD
    for those, compare in ((F.lit(True), lambda now: links(now, F.col("leads"))),
                           (few, lambda now: links(now, ~F.col("leads"))), (~few, crowds)):
        now = members.filter(those).join(found, "id", "left").withColumn(
            "component", F.coalesce("component", "id"))
        if compare is crowds and now.isEmpty():
            break
        mixed = now.groupBy("band").agg(  # bands that are one component by now are done
            F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
        new = compare(now.join(mixed.select("band"), "band", "left_semi"))
        if not new.isEmpty():
            found = components(new.union(found.select("component", "id")))
    return (signed.select("doc_id", "key").join(classes.select("key", "id"), "key", "left")
            .join(found, "id", "left").select(
                "doc_id", F.coalesce("component", "id", "doc_id").alias("component_id")))
