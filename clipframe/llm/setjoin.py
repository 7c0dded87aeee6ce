"""Exact Jaccard self-join of shingle sets that uses relations between sets to skip work.

Two kinds of relations are used. Index lists are sorted by position and cut into
blocks; a block whose positions and sizes rule out the threshold is skipped whole.
And sets that are much alike follow a leader: what is known of the leaders of two
groups, with the few shingles that members have beyond their leaders, bounds the
overlap of every pair of members, so most pairs need no comparison of their own.

Sets travel as packed numpy arrays: a task sends one row to each hash bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.llm import words as W
from clipframe.llm.common import components, give_back, written

SHINGLE_WORDS = 5
TOKENS_PER_BUCKET = 2_000_000
LOW_BITS = 40       # of a shingle's hash that travel, at most; the bucket gives the bits above
BLOCK = 64          # entries of an index list that are skipped together
MEMBERS = 1_024     # of a leader's group in a block, about
PROBES = 2_000      # of a block in one part, about
PART_BYTES = 16 << 20  # of the sets in a block or part, about
CROWD = 32          # sets that share a smallest shingle and are much alike without links
ALIKE = 50          # percent of the union that a member of a crowd shares with its leader
STARS = 4           # orders of the shingles by which crowds find a leader
CELLS = 8_000_000   # of a matrix of sets and shingles


def pack(bucket: np.ndarray, buckets: int, **columns: np.ndarray) -> Iterator[dict]:
    """One dict of bytes for each bucket that has entries."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    columns = {k: v[order] for k, v in columns.items()}
    for b in np.flatnonzero(np.diff(edges)):
        yield {"bucket": int(b), **{k: v[edges[b]:edges[b + 1]].tobytes()
                                    for k, v in columns.items()}}


def unpack(rows: pa.Table, name: str, dtype: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), dtype) for v in rows.column(name)]
                          or [np.empty(0, dtype)])


def set_key(values: np.ndarray) -> int:
    """64 bits that name a set of shingles; sums do not depend on their order."""
    total = np.array([W.mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
    return int(W.mix(total + np.uint64(len(values)))[0].astype(np.int64)) if len(values) else 0


def members(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, n, key)`` of every row: the size of its set and the name of that set."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys = [], []
            for values in W.shingle_sets(batch.column(1), k):
                n.append(len(values))
                keys.append(set_key(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64())],
                names=["doc_id", "n", "key"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        name, "doc_id bigint, n bigint, key bigint")


SLICE_BYTES = 4 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Rows in runs of at most ``limit`` bytes, or of one row."""
    for row, _, offsets in W.chunks(texts, limit):
        yield texts.slice(row, len(offsets) - 1)


PIECES = "bucket int, key binary, n binary, run binary, low binary, high binary"
SHARED = "bucket int, key binary, n binary, run binary, token binary, df binary"
SETS = "id bigint, n bigint, tokens binary"


def candidate_sets(docs: DataFrame, bits: int, percent: int, k: int = SHINGLE_WORDS) -> DataFrame:
    """Distinct sets of which enough shingles also occur in another set: ``(id, n, tokens)``.

    A set with a partner shares at least ``percent`` of its shingles with it. All
    shingles are counted over distinct sets, in ``2 ** bits`` buckets by hash; sets
    below the share are done. ``tokens`` are the shared ones, the rarest first (ties
    by hash), as 64-bit numbers.
    """
    buckets = 1 << bits
    low_bits = min(LOW_BITS, 64 - bits)
    low = np.uint64(low_bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in (part for batch in batches for part in slices(batch.column(0))):
            sets, keys = [], {}
            for values in W.shingle_sets(texts, k):
                key = set_key(values)
                if len(values) and key not in keys:  # copies in a slice are sent once
                    keys[key] = None
                    sets.append(values)
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets])
            values = np.concatenate(sets)
            bucket = (values >> np.uint64(64 - bits)).astype(np.int32)
            cut = values >> np.uint64(64 - bits - low_bits)
            owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
            # values of a set ascend, so those of a bucket are one run
            begins = np.flatnonzero(np.diff(owner.astype(np.int64) * buckets + bucket, prepend=-1))
            runs = np.diff(np.append(begins, len(values)))
            names = np.array(list(keys), np.int64)[owner[begins]]
            heads = pack(bucket[begins], buckets, key=names,
                         n=sizes[owner[begins]].astype(np.uint32), run=runs.astype(np.uint32))
            bodies = pack(bucket, buckets, low=cut.astype(np.uint32),
                          high=(cut >> np.uint64(32)).astype(np.uint8))
            for head, body in zip(heads, bodies):
                yield pa.RecordBatch.from_pylist([head | body], schema=piece_schema)
        give_back()

    piece_schema = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in (
        "key", "n", "run", "low", "high"))])
    shared_schema = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in (
        "key", "n", "run", "token", "df"))])

    def count(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        key, n, run = (unpack(rows, c, t) for c, t in (("key", "i8"), ("n", "u4"), ("run", "u4")))
        token = unpack(rows, "low", "u4").astype(np.uint64)
        token |= unpack(rows, "high", "u1").astype(np.uint64) << np.uint64(32)
        once = np.zeros(len(key), bool)
        once[np.unique(key, return_index=True)[1]] = True  # equal sets count as one
        owner = np.repeat(np.arange(len(key), dtype=np.int32), run)
        mine = once[owner]
        token, owner = token[mine], owner[mine]
        del mine
        order = np.argsort(token, kind="stable")
        begins = np.flatnonzero(np.diff(token[order], prepend=~token[order[:1]]))
        counts = np.diff(np.append(begins, len(token)))
        df = np.empty(len(token), np.int32)
        df[order] = np.repeat(counts, counts)
        del order
        many = df > 1
        token, owner, df = token[many], owner[many], df[many]
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        sets, runs = owner[begins], np.diff(np.append(begins, len(owner)))
        target = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        heads = pack(target[sets], buckets, key=key[sets], n=n[sets], run=runs.astype(np.uint32))
        bodies = pack(target[owner], buckets, token=token | (np.uint64(bucket) << low),
                      df=np.minimum(df, 65535).astype(np.uint16))
        out = pa.Table.from_pylist([h | b for h, b in zip(heads, bodies)], schema=shared_schema)
        del key, n, run, token, owner, df, heads, bodies
        give_back()
        return out

    def gather(rows: pa.Table) -> pa.Table:
        key, n, run = (unpack(rows, c, t) for c, t in (("key", "i8"), ("n", "u4"), ("run", "u4")))
        token, df = unpack(rows, "token", "u8"), unpack(rows, "df", "u2")
        names, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        size = n[first].astype(np.int64)
        owner = np.repeat(inverse, run)
        enough = np.bincount(owner, minlength=len(names)) * 100 >= percent * size
        mine = enough[owner]
        owner, token, df = owner[mine], token[mine], df[mine]
        token = token[np.lexsort((token, df, owner))]
        ends = np.cumsum(np.bincount(owner, minlength=len(names)))
        kept = np.flatnonzero(enough)
        tokens = [token[b:e].tobytes() for b, e in zip(np.append(0, ends[:-1])[kept], ends[kept])]
        out = pa.table({"id": names[kept], "n": size[kept],
                        "tokens": pa.array(tokens, pa.binary())})
        del key, n, run, token, owner, df, mine, tokens
        give_back()
        return out

    pieces = docs.select("text").mapInArrow(send, PIECES)
    return (pieces.groupBy("bucket").applyInArrow(count, SHARED)
            .groupBy("bucket").applyInArrow(gather, SETS))


def overlap(left: str, right: str) -> Column:
    def count(x: pa.Array, y: pa.Array) -> pa.Array:
        pairs = ((np.frombuffer(v.as_buffer(), np.uint64) for v in pair) for pair in zip(x, y))
        return pa.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in pairs],
                        pa.int64())
    return F.arrow_udf(count, "bigint")(left, right)


def compared(pairs: DataFrame, sets: DataFrame, *kept: str) -> DataFrame:
    """``pairs (a, b)`` with sizes and the exact overlap ``o``; columns ``kept`` stay."""
    left, right = (sets.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"),
                               F.col("tokens").alias(f"tokens_{s}")) for s in ("a", "b"))
    return pairs.join(right, "b").join(left, "a").select(
        "a", "b", "n_a", "n_b", overlap("tokens_a", "tokens_b").alias("o"), *kept)


def linked(percent: int) -> Column:
    return F.col("o") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("o")) * percent


def first_shingles(tokens: str) -> Column:
    """The smallest of the set's shingles in each of ``STARS`` orders."""
    def smallest(sets: pa.Array) -> pa.Array:
        salts = W.stream(5, STARS)
        return pa.array([[int(W.mix(np.frombuffer(s.as_buffer(), np.uint64) ^ salt).min()
                              .astype(np.int64)) for salt in salts] for s in sets],
                        pa.list_(pa.int64()))
    return F.arrow_udf(smallest, "array<bigint>")(tokens)


def leader_pairs(n: np.ndarray, place: np.ndarray, leader: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of leaders that one index list makes candidates, as rows ``(low, high)``.

    Entries ``(set size, position of the shingle in the set)``. If this is the first
    shingle that two sets share, they share at most the rest of either, and that must
    reach ``percent / (100 + percent)`` of their sizes together: ``reach_a >=
    percent * n_b`` and the reverse. Blocks by position that fail as wholes are skipped.
    """
    reach = 100 * n - (100 + percent) * place
    order = np.argsort(place, kind="stable")
    n, reach, leader = n[order], reach[order], leader[order]
    cuts = np.arange(0, len(n), BLOCK)
    far, small = np.maximum.reduceat(reach, cuts), np.minimum.reduceat(n, cuts)
    found = []
    for i, x in enumerate(cuts):
        near = np.flatnonzero((far[i] >= percent * small[i:]) & (far[i:] >= percent * small[i]))
        a = slice(x, x + BLOCK)
        for j in cuts[i + near]:
            b = slice(j, j + BLOCK)
            ok = ((reach[a][:, None] >= percent * n[b]) & (reach[b] >= percent * n[a][:, None])
                  & (leader[a][:, None] != leader[b]))
            at, to = np.nonzero(ok)
            if len(at):
                x1, x2 = leader[a][at], leader[b][to]
                found.append(np.unique(np.stack([np.minimum(x1, x2), np.maximum(x1, x2)], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)


ENTRIES = "bucket int, token binary, n binary, place binary, leader binary"


def candidate_leaders(sets: DataFrame, bits: int, percent: int) -> DataFrame:
    """Distinct pairs of leaders ``(a, b)`` of sets that may be linked, from the prefix index.

    ``sets (id, n, tokens, leader)``. Linked sets share one of the rarest
    ``n - ceil(percent n / 100) + 1`` shingles of each; those that no other set has
    come first, so only the rest of the prefix is indexed.
    """
    buckets = 1 << bits

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, n, place, leader = [], [], [], []
            for size, tokens, lead in zip(batch.column(0).to_pylist(), batch.column(1),
                                          batch.column(2).to_pylist()):
                shared = np.frombuffer(tokens.as_buffer(), np.uint64)
                alone = size - len(shared)
                prefix = size - -(-percent * size // 100) + 1 - alone
                mine = shared[:max(prefix, 0)]
                token.append(mine)
                place.append(alone + np.arange(len(mine)))
                n.append(np.full(len(mine), size))
                leader.append(np.full(len(mine), lead))
            if not token:
                continue
            token = np.concatenate(token)
            rows = pack((W.mix(token) % np.uint64(buckets)).astype(np.int32), buckets, token=token,
                        n=np.concatenate(n).astype(np.int64),
                        place=np.concatenate(place).astype(np.int64),
                        leader=np.concatenate(leader).astype(np.int64))
            for row in rows:
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in (
        "token", "n", "place", "leader"))])

    def meet(rows: pa.Table) -> pa.Table:
        token = unpack(rows, "token", "u8")
        n, place, leader = (unpack(rows, c, "i8") for c in ("n", "place", "leader"))
        order = np.lexsort((leader, token))
        token, n, place, leader = (x[order] for x in (token, n, place, leader))
        begins = np.flatnonzero(np.diff(token, prepend=~token[:1]))
        ends = np.append(begins[1:], len(token))
        mixed = leader[begins] != leader[ends - 1]
        found = [leader_pairs(n[b:e], place[b:e], leader[b:e], percent)
                 for b, e in zip(begins[mixed], ends[mixed])]
        pairs = np.unique(np.concatenate([*found, np.empty((0, 2), np.int64)]), axis=0)
        del token, n, place, leader, found
        give_back()
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    entries = sets.select("n", "tokens", "leader").mapInArrow(index, ENTRIES)
    return entries.groupBy("bucket").applyInArrow(meet, "a bigint, b bigint").distinct()


def followers(sets: DataFrame, percent: int) -> DataFrame:
    """``(id, leader, extra, link)`` of the sets that follow another, which follows none.

    A set is compared with the smallest of those that share its smallest shingle, and
    follows it if they are linked. Where many share it, sets that are much alike but
    not linked follow too (``link`` is false), and those without a follower try
    further orders of the shingles: so crowds of templates have few leaders.
    """
    values = written(sets.select("id", first_shingles("tokens").alias("values")), "first-shingles")
    alike = F.col("o") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("o")) * ALIKE
    found = None
    for k in range(STARS):
        free = values.select("id", F.col("values")[k].alias("value"))
        if found is None:
            free = free.withColumn("members", F.lit(0).cast("bigint"))
        else:
            size = found.groupBy("leader").agg(F.count(F.lit(1)).alias("members"))
            free = free.join(found.select("id"), "id", "left_anti").join(
                size.withColumnRenamed("leader", "id"), "id", "left").fillna(0, ["members"])
        lead = free.groupBy("value").agg(
            F.max_by("id", F.struct("members", -F.col("id"))).alias("a"),
            F.count(F.lit(1)).alias("n")).filter(F.col("n") >= (CROWD if k else 2))
        stars = free.filter("members = 0").join(lead, "value").filter("id != a").select(
            "a", F.col("id").alias("b"), (F.col("n") >= CROWD).alias("crowd"))
        near = written(
            compared(stars, sets, "crowd").withColumn("link", linked(percent))
            .filter(F.col("link") | (F.col("crowd") & alike)).select(
                F.col("b").alias("id"), F.col("a").alias("leader"),
                (F.col("n_b") - F.col("o")).alias("extra"), "link"), "followers")
        found = near if found is None else found.union(near)
        if k == 0 and not lead.filter(F.col("n") >= CROWD).limit(1).count():
            break
    return found


def set_components(sets: DataFrame, bits: int, percent: int) -> DataFrame:
    """``(id, component)`` of the sets that have links, by exact comparison.

    First sets follow leaders (``followers``). Then leaders are compared where the
    prefix index makes members of both candidates. At last members are looked at where
    they are not in one component by then and the bound ``|A n B| <= |L n M| +
    |A - L| + |B - M|`` leaves room for a link (``probe``). Members that are not linked
    to their leader may be in another component than it, so they are looked at whether
    or not the leaders are linked, and also within their own group.
    """
    led = followers(sets, percent)
    placed = written(sets.join(led, "id", "left").select(
        "id", "n", "tokens", F.coalesce("leader", "id").alias("leader"),
        F.coalesce("extra", F.lit(0)).alias("extra"),
        (~F.coalesce("link", F.lit(True))).alias("loose")), "placed")
    # what a member can add to an overlap beyond its leader's, less what its size asks for
    slack = (100 + percent) * F.col("extra") - percent * F.col("n")
    met = written(compared(candidate_leaders(placed, bits, percent), sets)
                  .withColumn("link", linked(percent)), "met")
    found = components(led.filter("link").select(F.col("leader").alias("a"), F.col("id").alias("b"))
                       .union(met.filter("link").select("a", "b")))
    grouped = placed.groupBy("leader").agg(
        F.max(slack).alias("most"), F.count_if("loose").alias("loose"),
        F.max(F.when(F.col("id") == F.col("leader"), F.col("n"))).alias("n"))
    apart = met.select("a", "b", "o")
    for side in ("a", "b"):
        apart = (apart.join(found.select(F.col("id").alias(side),
                                         F.col("component").alias(f"c_{side}")), side, "left")
                 .join(grouped.select(F.col("leader").alias(side), F.col("most").alias(f"m_{side}"),
                                      F.col("loose").alias(f"l_{side}")), side))
    open_ = apart.withColumn("one", F.coalesce("c_a", "a") == F.coalesce("c_b", "b")).filter(
        (~F.col("one") | (F.col("l_a") + F.col("l_b") > 0))
        & ((100 + percent) * F.col("o") + F.col("m_a") + F.col("m_b") >= 0))
    own = grouped.filter("loose > 0").select(
        F.col("leader").alias("a"), F.col("leader").alias("b"), F.col("n").alias("o"),
        F.col("most").alias("m_a"), F.col("most").alias("m_b"), F.lit(0).cast("bigint").alias("l_a"),
        F.lit(0).cast("bigint").alias("l_b"), F.lit(True).alias("one"))
    named = placed.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    late = written(probe(open_.select(own.columns).union(own), named, percent), "late")
    return components(found.select(F.col("component").alias("a"), F.col("id").alias("b"))
                      .union(late))


def probe(pairs: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between members of two leaders' groups, for pairs of leaders.

    The members of the smaller group are probes of the larger one, whose members lie
    in blocks. Of leaders in ``one`` component with no member of the larger group loose,
    and of a leader with itself, the probes are those not linked to their leader.
    A block is kept as its leader's set and what each member has more and less; a probe
    is compared with the leader once, and its overlap with each member follows from
    that by the differences alone. A block and a part of the probes give a spanning
    forest of their links between components, so the rows are not pairs of members.
    """
    total = 100 + percent
    slack = total * F.col("extra") - percent * F.col("n")
    size = placed.groupBy("leader").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("tokens")).alias("bytes"))
    for side in ("a", "b"):
        pairs = pairs.join(size.select(
            F.col("leader").alias(side), F.col("members").alias(f"k_{side}"),
            F.greatest(F.ceil(F.col("members") / MEMBERS), F.ceil(F.col("bytes") / PART_BYTES))
            .cast("int").alias(f"blocks_{side}")), side)
    first = F.col("k_a") >= F.col("k_b")

    def larger(name: str) -> Column:
        return F.when(first, F.col(f"{name}_a")).otherwise(F.col(f"{name}_b"))

    turned = pairs.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("big"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("small"),
        larger("k").alias("members"), larger("blocks").alias("blocks"),
        (total * F.col("o") + larger("m")).alias("room"),
        (~F.col("one") | (larger("l") > 0)).alias("every"))
    probes = written(turned.filter("members > 1").join(placed.select(
        F.col("leader").alias("small"), "id", "n", "tokens", "loose", "component",
        slack.alias("slack")), "small")
        .filter("room + slack >= 0 and (loose or every)")
        .select("big", "blocks", "id", "n", "tokens", "component"), "probes")
    parts = probes.groupBy("big").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / PROBES),
                   F.ceil(F.sum(F.octet_length("tokens")) / PART_BYTES)).cast("int").alias("parts"),
        F.max("blocks").alias("blocks")).withColumnRenamed("big", "leader")
    where = parts.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn(
        "part", F.explode(F.expr("sequence(0, parts - 1)"))).select("leader", "block", "part")
    columns = ["leader", "block", "part", "id", "n", "tokens", "component"]
    group = placed.filter("id != leader").join(parts, "leader").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    blocks = group.join(where, ["leader", "block"]).select(*columns).union(
        placed.filter("id = leader").join(where, "leader").select(*columns))
    asked = probes.drop("blocks").withColumnRenamed("big", "leader").join(parts, "leader").select(
        "leader", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "n",
        "tokens", "component")

    def derive(key: tuple, mine: pa.Table, probes: pa.Table) -> pa.Table:
        edges = []
        if mine.num_rows and probes.num_rows:
            leader, block = key[0].as_py(), key[1].as_py()
            ids, sizes, names = (mine.column(c).to_numpy() for c in ("id", "n", "component"))
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in mine.column("tokens")]
            at = int(np.flatnonzero(ids == leader)[0])
            head = np.sort(sets[at])
            members = np.array([i for i in range(len(sets)) if i != at or block == 0], np.int64)
            asked = [np.frombuffer(v.as_buffer(), np.uint64) for v in probes.column("tokens")]
            both = overlaps(asked, head, [sets[i] for i in members])
            n, own = probes.column("n").to_numpy(), probes.column("component").to_numpy()
            hit = both * 100 >= (n[:, None] + sizes[members] - both) * percent
            edges = forest(hit, probes.column("id").to_numpy(), own, ids[members], names[members])
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()),
                         "b": pa.array([e[1] for e in edges], pa.int64())})

    keys = ["leader", "block", "part"]
    return blocks.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        derive, "a bigint, b bigint")


def overlaps(probes: list[np.ndarray], head: np.ndarray, members: list[np.ndarray]) -> np.ndarray:
    """Shingles that each probe shares with each member, from what it shares with ``head``.

    Members count by their differences from the head: shingles they have more, and less.
    """
    more = [np.setdiff1d(m, head, assume_unique=True) for m in members]
    less = [np.setdiff1d(head, m, assume_unique=True) for m in members]
    tokens = np.concatenate([*probes, np.empty(0, np.uint64)])
    row = np.repeat(np.arange(len(probes)), [len(p) for p in probes])
    shared = np.bincount(row[contains(head, tokens)], minlength=len(probes))
    both = np.repeat(shared[:, None], len(members), axis=1).astype(np.float64)
    parts = [x for pair in zip(more, less) for x in pair]
    values, column = np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]), return_inverse=True)
    sizes = [len(x) for x in parts]
    owner = np.repeat(np.repeat(np.arange(len(members)), 2), sizes)
    sign = np.repeat(np.tile(np.float32([1, -1]), len(members)), sizes)
    known = contains(values, tokens)
    row, place = row[known], np.searchsorted(values, tokens[known])
    step = max(1, CELLS // (len(probes) + len(members)))
    for low in range(0, len(values), step):
        width = min(step, len(values) - low)
        x = np.zeros((len(probes), width), np.float32)
        d = np.zeros((len(members), width), np.float32)
        here = (place >= low) & (place < low + width)
        x[row[here], place[here] - low] = 1
        here = (column >= low) & (column < low + width)
        d[owner[here], column[here] - low] = sign[here]
        both += x @ d.T
    return both.astype(np.int64)


def forest(hit: np.ndarray, probes: np.ndarray, own: np.ndarray, members: np.ndarray,
           names: np.ndarray) -> list[tuple[int, int]]:
    """Links among those in ``hit`` that join the components of probes and members as all do."""
    label = np.unique(np.concatenate([own, names]), return_inverse=True)[1]
    edges = []
    for i in np.flatnonzero(hit.any(axis=1)):
        linked_ = np.flatnonzero(hit[i])
        reached, first = np.unique(label[len(own) + linked_], return_index=True)
        other = reached != label[i]
        if other.any():
            edges += [(int(probes[i]), int(members[linked_[j]])) for j in first[other]]
            label[np.isin(label, reached[other])] = label[i]
    return edges


def contains(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values occur in an ordered array."""
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values if len(ordered) else np.zeros(len(values), bool)


def join(docs: DataFrame, percent: int = 75, k: int = SHINGLE_WORDS,
         bits: int | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs (doc_id, text)``.

    Two rows link when ``100 |A n B| >= percent |A u B|``; a component is named by its
    smallest ``doc_id``. Sets are compared by 64-bit names of whole sets and hashes
    of at least 45 bits of each shingle. Rows with equal sets are one set throughout,
    however many they are. A null or empty text has an empty set, links with nothing
    and is its own component; a text of fewer than ``k`` words is one shingle.
    Repeated rows each appear. A row without id takes part, but names no component.
    An empty table gives an empty result.
    """
    rows = written(members(docs, k), "members")
    if bits is None:
        total = rows.agg(F.sum("n")).first()[0] or 0
        bits = max(5, (total // TOKENS_PER_BUCKET).bit_length())
    sets = written(candidate_sets(docs, bits, percent, k), "sets")
    found = set_components(sets, bits, percent)
    classes = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = classes.join(found.withColumnRenamed("id", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    # a table of its own, so that the join on a hot component can be split
    smallest = written(named.groupBy("component").agg(F.min("first").alias("component_id")),
                       "component-names")
    names = named.join(smallest, "component").select("key", "component_id")
    return (rows.join(names, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id")))
