"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipframe.llm.common import written

DIMENSIONS = ("size", "tokens", "n_rows")
FINE = 64            # a group above 1/64 of a shard in some dimension is placed by itself
CELLS = 128          # cells of small groups for each shard
SPLIT = 2            # a group above half a shard is cut into parts of about that
BLOCK_ROWS = 1_000_000
TOLERANCE = 0.1      # of the mean, for tokens and rows of a shard when bytes are evened out


def words(text: Column) -> Column:
    """Blank-separated words, the measure of tokens where the caller has no better one."""
    return F.coalesce(F.size(F.split(F.trim(text), r"\s+")), F.lit(0))


def place(loads: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each load vector: largest first, where the dot product with the rest is highest.

    Dimensions count in shares of a shard's capacity, a ``shards``-th of the total.
    Shards that a vector overfills come only after those that it fits.
    """
    capacity = np.maximum(loads.sum(axis=0) / shards, 1e-9)
    shares = loads / capacity
    residual = np.ones((shards, loads.shape[1]))
    chosen = np.zeros(len(loads), np.int64)
    for i in np.argsort(-shares.max(axis=1), kind="stable"):
        score = residual @ shares[i]
        fits = (residual >= shares[i] - 1e-12).all(axis=1)
        if fits.any():
            score[~fits] = -np.inf
        chosen[i] = np.argmax(score)
        residual[chosen[i]] -= shares[i]
    return chosen


def settle(vectors: np.ndarray, chosen: np.ndarray, shards: int, rounds: int = 500) -> np.ndarray:
    """Even out the first dimension: the fullest and the emptiest shard exchange a vector or
    move one.

    Of the exchanges of these two that raise no other dimension above its largest load, or
    above ``TOLERANCE`` and a usual vector more than the mean, the one that leaves them
    nearest to each other.
    """
    chosen, sizes = chosen.copy(), vectors[:, 0]
    others = vectors[:, 1:]
    none = np.zeros((1, others.shape[1]))
    usual = others.sum(axis=0) / shards * (1 + TOLERANCE) + np.median(others, axis=0) if len(
        others) else none[0]
    for _ in range(rounds):
        loads = np.bincount(chosen, sizes, shards)
        high, low = int(loads.argmax()), int(loads.argmin())
        held = np.stack([np.bincount(chosen, d, shards) for d in others.T], axis=1)
        most = np.maximum(held.max(axis=0), usual)
        half = (loads[high] - loads[low]) / 2
        give = np.flatnonzero(chosen == high)
        take = np.append(np.flatnonzero(chosen == low), -1)  # -1: nothing comes back
        back = np.append(sizes[take[:-1]], 0.0)
        order = np.argsort(back, kind="stable")
        want = sizes[give] - half
        at = np.searchsorted(back[order], want)
        best, pair = half, None
        for near in (np.clip(at - 1, 0, len(order) - 1), np.clip(at, 0, len(order) - 1)):
            off = np.abs(back[order][near] - want)
            moved = others[give] - np.concatenate([others[take[:-1]], none])[order][near]
            fits = ((held[high] - moved <= most) & (held[low] + moved <= most)).all(axis=1)
            off[~fits] = np.inf
            i = int(off.argmin()) if len(off) else -1
            if i >= 0 and off[i] < best * 0.999:
                best, pair = off[i], (give[i], take[order[near[i]]])
        if pair is None:
            break
        chosen[pair[0]] = low
        if pair[1] >= 0:
            chosen[pair[1]] = high
    return chosen


def shard(docs: DataFrame, shards: int, tokens: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", row_bytes: int = 8) -> DataFrame:
    """``(id, size, tokens, text_crc32, shard, slot)`` for every row of ``docs``.

    Rows of equal text form a group and stay together, unless the group exceeds
    half a shard: then its rows are dealt by hash into parts of about that.
    Groups above a 64th of a shard (at most 3 x 64 x shards of them, by counting)
    and cells of hashed smaller groups (128 x shards) are the vectors to place, so
    their number does not grow with the input; only their sums reach the driver.
    Exchanges between the fullest and the emptiest shard then even out the bytes, as far
    as no shard gets more tokens or rows than the fullest had or a tolerance allows.

    A null text is an empty payload and forms a group; a null id is kept. Repeated
    rows each get a slot of their own. Other columns are not looked at. An empty
    table gives an empty result.
    """
    text = F.col(text_col)
    rows = written(docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + row_bytes).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(words(text) if tokens is None else tokens, F.lit(0)).cast("long")
        .alias("tokens"),
        F.xxhash64(text.isNull(), text).alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("n_rows")]
    total = rows.agg(*sums).first()
    share = F.greatest(*[F.col(c) * shards / max(total[c] or 0, 1) for c in DIMENSIONS])
    groups = rows.groupBy("key").agg(*sums).select("key", share.alias("share"))
    large = groups.filter(F.col("share") > 1 / FINE).select(
        "key", F.when(F.col("share") > 1 / SPLIT, F.ceil(F.col("share") * SPLIT))
        .otherwise(1).cast("int").alias("parts"))
    units = written(rows.join(F.broadcast(large), "key", "left").select(
        "id", "size", "text_crc32", "tokens", "row",
        F.when(F.col("parts").isNull(), F.pmod("key", F.lit(shards * CELLS)))
        .otherwise(F.xxhash64("key", F.pmod(F.xxhash64("row"), F.col("parts")))).alias("unit"),
        F.col("parts").isNotNull().alias("alone")), "shard-units")
    loads = units.groupBy("alone", "unit").agg(*sums).orderBy("alone", "unit").toPandas()
    vectors = loads[list(DIMENSIONS)].to_numpy(float)
    loads["shard"] = settle(vectors, place(vectors, shards), shards)
    placed = docs.sparkSession.createDataFrame(
        list(loads[["alone", "unit", "shard"]].itertuples(index=False, name=None)),
        "alone boolean, unit bigint, shard int")
    blocks = max(4, -(-(total["n_rows"] or 0) // (shards * BLOCK_ROWS)))
    dealt = units.join(F.broadcast(placed), ["alone", "unit"]).withColumn(
        "block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    counts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    base = counts.selectExpr(
        "shard", "block", "sum(n) over (partition by shard order by block) - n as base")
    slotted = dealt.selectExpr(
        "*", "row_number() over (partition by shard, block order by id, row) - 1 as place")
    return slotted.join(F.broadcast(base), ["shard", "block"]).select(
        F.col("id").alias(id_col), "size", "tokens", "text_crc32", "shard",
        (F.col("base") + F.col("place")).cast("long").alias("slot"))
