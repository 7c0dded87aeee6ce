"""How sources of a language differ in their terms, tokenizing each distinct chunk once.

White space cuts a text into chunks, and no term crosses white space. So documents
are counted in chunks first; every chunk that occurs anywhere is cut into terms once;
and the terms are joined back to the chunk counts of the documents, whose distinct
terms and occurrences are summed by language and source.

What travels is packed: a slice of documents sends each of its distinct chunks once,
and sums of its terms instead of rows for documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipframe.llm import words as W
from clipframe.llm.common import give_back, written
from clipframe.llm.slices import (buffers_of, from_planes, joined, planes, runs, spread,
                                  strings_of)
from clipframe.session import lookup_join

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TERM_RANKS = 200
SLICE_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20   # of text for each bucket of chunks and terms, about
FAN_IN = 256              # slices whose sums meet in one task
BLOCK_SOURCES = 512       # of a language that are compared with all others in one task
BUCKET_ROWS = 50_000      # kept counts in a task that compares sources
CELLS = 4_000_000         # of terms x sources at a time

# [^\x00-\x40\x5B-\x60\x7B-\x7F]+ once A-Z are lower case
LETTERS = W.byte_table(bytes([*range(0x61), *range(0x7B, 0x80)]))

FACTORS = ("slice bigint, bucket int, data binary, sizes binary, place binary, chunk binary, "
           "n binary, per_doc binary, group binary, langs array<string>, sources array<string>")
CHUNKS = "slice bigint, bucket int, data binary, sizes binary, counts binary"
SUMS = ("slice bigint, bucket int, data binary, sizes binary, per_term binary, group binary, "
        "docs binary, n binary, langs array<string>, sources array<string>")
KEPT = "lang string, source string, term string, n bigint, total bigint, first boolean"


def schema_of(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
             "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def buckets_of(data: np.ndarray, sizes: np.ndarray, buckets: int) -> np.ndarray:
    starts = np.cumsum(sizes) - sizes
    if not len(starts):
        return np.empty(0, np.int64)
    return (W.string_hashes(data, starts) % np.uint64(buckets)).astype(np.int64)


def factor(docs: DataFrame, buckets: int) -> DataFrame:
    """Chunk counts of documents ``(lang, source, text)``, by slice; schema ``FACTORS``.

    For each slice and bucket a row with the distinct chunks; and one row without
    bucket that says, for each document, which chunks it has and how often.
    """
    schema = schema_of(FACTORS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for table in runs(batches, 2, SLICE_BYTES):
            yield pa.RecordBatch.from_pylist(list(slice_rows(table, number, buckets)), schema)
            number += 1
            give_back()

    return docs.mapInArrow(cut, FACTORS)


def slice_rows(table: pa.Table, number: int, buckets: int) -> Iterator[dict]:
    groups: dict[tuple, int] = {}
    group = [groups.setdefault(key, len(groups)) for key in zip(
        table.column(0).to_pylist(), table.column(1).to_pylist())]
    texts = table.column(2).combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.chunk(0)
    data, sizes = buffers_of(texts)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    inside = W.BLANK_SEPARATED[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:len(data)]
    starts = np.flatnonzero(begins)
    per_doc = np.diff(np.searchsorted(starts, offsets))
    if len(starts):
        at = np.cumsum(inside)[starts] - 1
        kept = data[inside]
        found = strings_of(kept, np.diff(np.append(at, len(kept)))).dictionary_encode()
        named = found.dictionary
        index = found.indices.to_numpy().astype(np.int64)
    else:
        named, index = strings_of(b"", np.empty(0, np.int64)), np.empty(0, np.int64)
    # the most frequent chunks get the smallest numbers
    order = np.argsort(-np.bincount(index, minlength=len(named)), kind="stable")
    rank = np.empty(len(named), np.int64)
    rank[order] = np.arange(len(named))
    key = np.repeat(np.arange(len(per_doc)), per_doc) * max(len(named), 1) + rank[index]
    key, n = np.unique(key, return_counts=True)
    bytes_, lengths = buffers_of(named)
    bucket = buckets_of(bytes_, lengths, buckets)
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    begin = np.cumsum(lengths) - lengths
    for b in np.flatnonzero(np.diff(edges)):
        mine = by_bucket[edges[b]:edges[b + 1]]
        yield {"slice": number, "bucket": int(b), "sizes": planes(lengths[mine]),
               "data": bytes_[spread(begin[mine], lengths[mine])].tobytes()}
    yield {"slice": number, "place": planes(rank[by_bucket]),
           "chunk": planes(key % max(len(named), 1)), "n": planes(n),
           "per_doc": planes(np.bincount(key // max(len(named), 1), minlength=len(per_doc))),
           "group": planes(group), "langs": [k[0] for k in groups],
           "sources": [k[1] for k in groups]}


def tokenize(data: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of strings that lie end to end, and how many each string has."""
    data = W.LOWER[data]
    inside = LETTERS[data]
    first = np.zeros(len(data) + 1, bool)
    first[np.cumsum(sizes) - sizes] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:len(data)]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    if not len(starts):
        return strings_of(b"", np.empty(0, np.int64)), counts
    kept = data[inside]
    at = np.cumsum(inside)[starts] - 1
    return strings_of(kept, np.diff(np.append(at, len(kept)))), counts


def chunk_terms(chunks: DataFrame) -> DataFrame:
    """Terms of the chunks of each slice, schema ``CHUNKS``; a chunk is cut into terms once.

    All slices that have a chunk meet in its bucket, each with one copy.
    """
    schema = schema_of(CHUNKS)

    def answer(rows: pa.Table) -> pa.Table:
        sizes = [from_planes(v) for v in rows.column("sizes").to_pylist()]
        data = b"".join(rows.column("data").to_pylist())
        found = strings_of(data, joined(sizes, np.int64)).dictionary_encode()
        which = found.indices.to_numpy()
        terms, counts = tokenize(*buffers_of(found.dictionary))
        begin = np.cumsum(counts) - counts
        bytes_, lengths = buffers_of(terms)
        at = np.cumsum(lengths) - lengths
        out, row = [], 0
        for slice_, bucket, own in zip(rows.column("slice").to_pylist(),
                                       rows.column("bucket").to_pylist(), sizes):
            mine = which[row:row + len(own)]
            row += len(own)
            take = spread(begin[mine], counts[mine])
            out.append({"slice": slice_, "bucket": bucket, "counts": planes(counts[mine]),
                        "sizes": planes(lengths[take]),
                        "data": bytes_[spread(at[take], lengths[take])].tobytes()})
        give_back()
        return pa.Table.from_pylist(out, schema)

    return chunks.groupBy("bucket").applyInArrow(answer, CHUNKS)


def pack_sums(number: int, buckets: int, terms: pa.Array, term: np.ndarray, group: np.ndarray,
              docs: np.ndarray, n: np.ndarray, names: list[tuple]) -> Iterator[dict]:
    """Sums in the order of ``term`` as rows of ``SUMS``, one for each bucket that has any."""
    data, lengths = buffers_of(terms)
    bucket = buckets_of(data, lengths, buckets)
    begin = np.cumsum(lengths) - lengths
    per_term = np.bincount(term, minlength=len(lengths))
    entry = np.cumsum(per_term) - per_term
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        mine = by_bucket[edges[b]:edges[b + 1]]
        take = spread(entry[mine], per_term[mine])
        used, local = np.unique(group[take], return_inverse=True)
        yield {"slice": number, "bucket": int(b), "sizes": planes(lengths[mine]),
               "data": data[spread(begin[mine], lengths[mine])].tobytes(),
               "per_term": planes(per_term[mine]), "group": planes(local),
               "docs": planes(docs[take], "<u8"), "n": planes(n[take], "<u8"),
               "langs": [names[g][0] for g in used], "sources": [names[g][1] for g in used]}


def slice_sums(factors: DataFrame, terms: DataFrame, buckets: int) -> DataFrame:
    """Documents and occurrences of each term by language and source, in each slice."""
    schema = schema_of(SUMS)

    def count(_, counts: pa.Table, answers: pa.Table) -> pa.Table:
        row = counts.to_pylist()[0]
        chunk, n, per_doc, group = (from_planes(row[c]).astype(np.int64)
                                    for c in ("chunk", "n", "per_doc", "group"))
        got = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        own = joined([from_planes(r["counts"]) for r in got], np.int64)
        found = strings_of(b"".join(r["data"] for r in got), joined(
            [from_planes(r["sizes"]) for r in got], np.int64)).dictionary_encode()
        if not len(found):
            return pa.Table.from_pylist([], schema)
        place = from_planes(row["place"]).astype(np.int64)  # number of each answered chunk
        begin, many = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        many[place], begin[place] = own, np.cumsum(own) - own
        take = spread(begin[chunk], many[chunk])
        term = found.indices.to_numpy()[take].astype(np.int64)
        doc = np.repeat(np.repeat(np.arange(len(per_doc)), per_doc), many[chunk])
        n = np.repeat(n, many[chunk])
        groups = len(row["langs"])
        held = np.unique(doc * len(found.dictionary) + term)  # a document counts once
        keys, docs = np.unique(held % len(found.dictionary) * groups
                               + group[held // len(found.dictionary)], return_counts=True)
        n = np.unique(np.repeat(term * groups + group[doc], n), return_counts=True)[1]
        out = pa.Table.from_pylist(list(pack_sums(
            row["slice"], buckets, found.dictionary, keys // groups, keys % groups, docs, n,
            list(zip(row["langs"], row["sources"])))), schema)
        give_back()
        return out

    return (factors.groupBy("slice").cogroup(terms.groupBy("slice"))
            .applyInArrow(count, SUMS))


def add(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Sums of rows of one bucket: terms, then term, group, documents, occurrences; groups."""
    rows = rows.to_pylist()
    groups: dict[tuple, int] = {}
    found = strings_of(b"".join(r["data"] for r in rows), joined(
        [from_planes(r["sizes"]) for r in rows], np.int64)).dictionary_encode()
    term = np.repeat(found.indices.to_numpy().astype(np.int64),
                     joined([from_planes(r["per_term"]) for r in rows], np.int64))
    group = joined([np.array([groups.setdefault(k, len(groups)) for k in zip(
        r["langs"], r["sources"])], np.int64)[from_planes(r["group"])] for r in rows], np.int64)
    key = term * len(groups) + group
    order = np.argsort(key, kind="stable")
    begins = np.flatnonzero(np.diff(key[order], prepend=-1))
    docs, n = (np.add.reduceat(joined([from_planes(r[c], "<u8") for r in rows], np.int64)[order],
                               begins) for c in ("docs", "n"))
    key = key[order][begins]
    return (found.dictionary, key // len(groups), key % len(groups), docs, n, list(groups))


def kept_counts(sums: DataFrame, slices: int, least: int) -> DataFrame:
    """``KEPT``: occurrences of each term that enough documents of its language have.

    Sums of slices meet in a tree, ``FAN_IN`` at a time. ``total`` is the count of the
    term in its whole language; ``first`` marks one row of each term and language.
    """
    schema, packed = schema_of(KEPT), schema_of(SUMS)

    def merge(rows: pa.Table) -> pa.Table:
        terms, term, group, docs, n, names = add(rows)
        out = list(pack_sums(rows.column("slice")[0].as_py(), 1, terms, term, group, docs, n, names))
        for row in out:
            row["bucket"] = rows.column("bucket")[0].as_py()
        give_back()
        return pa.Table.from_pylist(out, packed)

    def keep(rows: pa.Table) -> pa.Table:
        terms, term, group, docs, n, names = add(rows)
        langs: dict[str, int] = {}
        lang = np.array([langs.setdefault(k[0], len(langs)) for k in names], np.int64)[group]
        key = term * len(langs) + lang
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.diff(key[order], prepend=-1))
        sizes = np.diff(np.append(begins, len(key)))
        enough = np.repeat(np.add.reduceat(docs[order], begins) >= least, sizes)
        total = np.repeat(np.add.reduceat(n[order], begins), sizes)[enough]
        first = np.zeros(len(key), bool)
        first[begins] = True
        mine = order[enough]
        out = pa.Table.from_arrays(
            [pa.array([k[0] for k in names], pa.string()).take(pa.array(group[mine])),
             pa.array([k[1] for k in names], pa.string()).take(pa.array(group[mine])),
             terms.take(pa.array(term[mine])).cast(pa.string()), pa.array(n[mine]),
             pa.array(total), pa.array(first[enough])], schema=schema)
        give_back()
        return out

    while slices > FAN_IN:
        slices = -(-slices // FAN_IN)
        # a remainder would follow how partitions are numbered
        part = F.pmod(F.xxhash64("slice"), F.lit(slices))
        sums = sums.withColumn("slice", part).groupBy("bucket", "slice").applyInArrow(merge, SUMS)
    return sums.groupBy("bucket").applyInArrow(keep, KEPT)


def price(count: Column, n: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (n + v))`` without rounding; no use without terms."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, F.greatest(n + v, F.lit(1)).cast("decimal(20,0)")) + 1


def gain(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pair_values(priced: DataFrame, sizes: DataFrame, kept_rows: int) -> DataFrame:
    """``(lang, source, item, value)`` of every two sources of a language.

    Terms are dealt in buckets and sources in blocks; a task sums its terms for a block
    of sources against all others of the language, so a row leaves it for two sources,
    not for two sources and a term.
    """
    buckets = max(1, kept_rows // BUCKET_ROWS)
    numbered = sizes.withColumn("at", F.row_number().over(
        Window.partitionBy("lang").orderBy("source")) - 1).select(
            "lang", "source", "at", price(F.lit(0), F.col("n_source"), F.col("v")).alias("p"))
    many = numbered.groupBy("lang").agg(
        (F.floor(F.max("at") / BLOCK_SOURCES) + 1).cast("int").alias("blocks"))
    grid = many.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
                           ).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    right = numbered.join(grid.select("lang", "bucket", "block"), "lang")
    left = lookup_join(priced.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")),
                       many, ["lang"], "inner").withColumn(
        "block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
            "lang", "bucket", "block", "term", "source", "p")

    def compare(counts: pa.Table, sources: pa.Table) -> pa.Table:
        sources = sources.sort_by("at")
        names = sources.column("source").combine_chunks()
        zero = sources.column("p").to_numpy()
        block = sources.column("block")[0].as_py()
        low, high = block * BLOCK_SOURCES, min((block + 1) * BLOCK_SOURCES, len(zero))
        value = np.zeros((high - low, len(zero)), np.int64)
        if counts.num_rows:
            found = counts.column("term").combine_chunks().dictionary_encode()
            term = found.indices.to_numpy()
            at = {s: i for i, s in enumerate(names.to_pylist())}
            column = np.array([at[s] for s in counts.column("source").to_pylist()])
            p = counts.column("p").to_numpy()
            step = max(1, CELLS // len(zero))
            order = np.argsort(term, kind="stable")
            edges = np.searchsorted(term[order], np.arange(0, len(found.dictionary) + step, step))
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                mine = order[a:b]
                full = np.tile(zero, (min(step, len(found.dictionary) - k * step), 1))
                full[term[mine] - k * step, column[mine]] = p[mine]
                for i in range(low, high):
                    off = full[:, i:i + 1] - full
                    value[i - low] += (off * off // full).sum(axis=0)
        own, other = (x.ravel() for x in np.indices(value.shape))
        two = own + low != other
        lang = sources.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * int(two.sum()), pa.string()),
                         "source": names.take(pa.array(own[two] + low)),
                         "item": names.take(pa.array(other[two])),
                         "value": pa.array(value.ravel()[two])})

    keys = ["lang", "bucket", "block"]
    return (left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        compare, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs (lang, source, text)``.

    Part ``pair``: how far a source's term shares are from those of each other source
    of its language, over all terms in at least ``least`` documents of the language.
    Part ``term``: its ``ranks`` terms that are most above the whole language.

    Nulls are empty strings; a text without terms counts nothing but its source
    occurs. Repeated rows are documents of their own. Equal values are ordered by the
    UTF-8 of the item. Texts are read whole, and one longer than a slice is a slice.
    Other columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")])
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size // bucket_bytes))
    factors = written(factor(docs, buckets), "factors")
    slices = factors.filter("bucket is null").count()
    terms = chunk_terms(factors.filter("bucket is not null").select(
        "slice", "bucket", "data", "sizes"))
    counts = factors.filter("bucket is null").drop("bucket", "data", "sizes")
    kept = written(kept_counts(slice_sums(counts, terms, buckets), slices, least), "kept-terms")
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"),
                                       F.count_if("first").alias("v"))
    sizes = written(docs.select("lang", "source").distinct().join(
        by_source, ["lang", "source"], "left").join(by_lang, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                                for c in ("n_source", "n_lang", "v")]), "sources")
    priced = lookup_join(kept, sizes, ["lang", "source"], "inner").select(
        "lang", "source", "term", price(F.col("n"), F.col("n_source"), F.col("v")).alias("p"),
        price(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))
    pairs = pair_values(priced.select("lang", "source", "term", "p"), sizes, kept.count())
    above = priced.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), gain(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
            .select(*columns).union(
                above.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks)
                .withColumn("part", F.lit("term")).select(*columns)))
