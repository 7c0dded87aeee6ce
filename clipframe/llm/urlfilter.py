"""URL filter: rules first, then the likelihood ratio of two character language models.

The models are variable-order Markov models of the accepted and the rejected URLs (what
the rules say of them): interpolated by Witten-Bell, used at the longest order at which
either model has seen the symbol. URLs are folded to ``SYMBOLS``, so a model has at most
``32 ** ORDER_SYMBOLS`` entries, whatever the number of URLs. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipframe.llm.common import free_name, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EDGE = "^"                            # before the first and after the last symbol
SYMBOLS = LOWER + "0./-_" + EDGE      # 0: any digit, _: any other character
ORDER_SYMBOLS = 4                     # of a gram: three of context and the one that follows
CALIBRATION = ("0", "1", "2")         # first digits of the md5 of URLs that set the cut: 3 of 16
UNIT = 1_000_000                      # of a log ratio; whole numbers add up alike in any order
BIN = 10_000                          # units in a bin of the calibration, 0.01 nats


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str     # and its subdomains
    path: str     # begin of the path

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def rest_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matching(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of equal length the first by name."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = (F if rule is None else rule).when(fits, r.name)
        verdict = (F if verdict is None else verdict).when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def folded(text: Column) -> Column:
    """The text in ``SYMBOLS`` without the edge, one for each character."""
    digits = F.regexp_replace(F.translate(text, UPPER, LOWER), "[0-9]", "0")
    return F.regexp_replace(digits, "[^a-z0./-]", "_")


def grams(text: Column) -> Column:
    """Every symbol of a folded text and the end, with the symbols before it."""
    padded = F.concat(F.lit(EDGE * (ORDER_SYMBOLS - 1)), text, F.lit(EDGE))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1),
                       lambda i: F.substring(padded, i, F.lit(ORDER_SYMBOLS)))


def learn(texts: DataFrame) -> DataFrame:
    """``(gram, value)``: log ratio of rejected to accepted for each gram seen, in units.

    ``texts (text, accepted, rejected)`` counts how often a folded text is of a class.
    Grams of all lengths from one symbol on; every single symbol has an entry.
    """
    counts = written(
        texts.select(F.explode(grams(F.col("text"))).alias("gram"), "accepted", "rejected")
        .groupBy("gram").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("b")),
        "url-grams")
    single = counts.sparkSession.createDataFrame([(s,) for s in SYMBOLS], "gram string")
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "ab"]).first()
    last = counts.groupBy(F.right("gram", F.lit(1)).alias("gram")).agg(
        *[F.sum(c).alias(c) for c in "ab"])
    shorter = single.join(last, "gram", "left").select("gram", *[
        ((F.coalesce(c, F.lit(0)) + 1) / F.lit(float(total[c] + len(SYMBOLS)))).alias("p" + c)
        for c in "ab"])
    levels = [shorter]
    for k in range(2, ORDER_SYMBOLS + 1):
        own = counts.groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(
            *[F.sum(c).alias(c) for c in "ab"]).withColumns(
                {"before": F.substring("gram", 1, k - 1), "suffix": F.right("gram", F.lit(k - 1))})
        before = own.groupBy("before").agg(
            *[F.sum(c).alias("n" + c) for c in "ab"],
            *[F.count_if(F.col(c) > 0).alias("t" + c) for c in "ab"])
        backed = shorter.select(F.col("gram").alias("suffix"), F.col("pa").alias("sa"),
                                F.col("pb").alias("sb"))
        shorter = own.join(before, "before").join(backed, "suffix").select("gram", *[
            F.when(F.col("n" + c) > 0, (F.col(c) + F.col("t" + c) * F.col("s" + c))
                   / (F.col("n" + c) + F.col("t" + c))).otherwise(F.col("s" + c)).alias("p" + c)
            for c in "ab"])
        levels.append(shorter)
    model = levels[0]
    for level in levels[1:]:
        model = model.union(level)
    return model.select("gram", F.floor(F.ln(F.col("pb") / F.col("pa")) * UNIT + 0.5)
                        .cast("bigint").alias("value"))


def scores(texts: DataFrame, model: DataFrame) -> DataFrame:
    """``texts`` (distinct rows with ``text``) with ``score``: units for each symbol.

    The parts of the model by gram length are broadcast; together they have at most
    ``32 + 32 ** 2 + 32 ** 3 + 32 ** 4`` rows.
    """
    places = texts.select("*", F.explode(grams(F.col("text"))).alias("gram"))
    found = []
    for k in range(ORDER_SYMBOLS, 0, -1):
        part = model.filter(F.length("gram") == k).select(
            F.col("gram").alias(f"gram_{k}"), F.col("value").alias(f"value_{k}"))
        places = places.join(F.broadcast(part),
                             F.right("gram", F.lit(k)) == F.col(f"gram_{k}"), "left")
        found.append(F.col(f"value_{k}"))
    return places.groupBy(*texts.columns).agg(F.floor(
        F.sum(F.coalesce(*found)) / F.count(F.lit(1)).cast("double")).cast("bigint").alias("score"))


def bin_of(score: Column) -> Column:
    return F.floor(score / float(BIN))


def calibrate(scored: DataFrame) -> int:
    """The bin from which on URLs are rejected: the least sum of both classes' error shares.

    ``scored (score, accepted, rejected)``. Of equal cuts the highest, which rejects
    least. Without both classes the cut is a ratio of one.
    """
    bins = scored.groupBy(bin_of(F.col("score")).alias("bin")).agg(
        F.sum("accepted").alias("a"), F.sum("rejected").alias("b")).filter("a + b > 0")
    bins = bins.union(bins.agg(F.max("bin") + 1, F.lit(0), F.lit(0)).filter("`(max(bin) + 1)` is not null"))
    order = Window.orderBy("bin")  # as many rows as bins of scores
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("missed", "wrong", "all_a", "all_b")}
    best = bins.select(
        "bin", (F.sum("b").over(order) - F.col("b")).alias("missed"),
        (F.sum("a").over(Window.partitionBy()) - F.sum("a").over(order) + F.col("a")).alias("wrong"),
        F.sum("a").over(Window.partitionBy()).alias("all_a"),
        F.sum("b").over(Window.partitionBy()).alias("all_b"),
    ).filter("all_a > 0 and all_b > 0").orderBy(
        wide["missed"] * wide["all_a"] + wide["wrong"] * wide["all_b"], F.desc("bin")).first()
    return 0 if best is None else best["bin"]


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` added.

    The rules' verdicts are the labels: of URLs with a rule, 13 of 16 (by md5) teach the
    models, the others set the cut. A URL without a rule is blocked if its score, the
    log ratio for each symbol, is in the cut's bin or above; if the rules accept none
    or reject none, all of them are allowed. ``score`` is null where a rule decides.

    A null URL or one without ``://`` has an empty host and path and fits no rule; the
    method judges it. Equal URLs have equal verdicts; repeated rows stay. Long URLs are
    judged whole. Columns of ``pages`` stay; those whose names clash with an added one
    are replaced by it. An empty table gives an empty result.
    """
    added = ("host", "path", "rule", "verdict", "score")
    taken = [c for c in pages.columns if c.lower() not in added or c == url_col]
    text, fold = free_name(taken, "text"), free_name(taken, "fold")
    rows = pages.select(*taken)
    if url_col in added:
        rows = rows.withColumnRenamed(url_col, free_name(taken, "url"))
        url_col = free_name(taken, "url")
    rows = rows.withColumns({"host": host_of(F.coalesce(F.col(url_col), F.lit(""))),
                             "path": path_of(F.coalesce(F.col(url_col), F.lit("")))})
    rule, verdict = matching(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({
        "rule": rule, "verdict": verdict, text: folded(F.concat("host", "path")),
        fold: F.substring(F.md5(F.coalesce(F.col(url_col), F.lit(""))), 1, 1).isin(*CALIBRATION)})
    accepted, rejected = F.col("verdict") == "allow", F.col("verdict") == "block"
    model = written(learn(
        rows.filter(F.col("rule").isNotNull() & ~F.col(fold)).groupBy(F.col(text).alias("text"))
        .agg(F.count_if(accepted).alias("accepted"), F.count_if(rejected).alias("rejected"))),
        "url-model")
    known = rows.filter(F.col("rule").isNotNull() & ~F.col(fold)).agg(
        F.count_if(accepted).alias("a"), F.count_if(rejected).alias("b")).first()
    scored = written(scores(
        rows.filter(F.col("rule").isNull() | F.col(fold)).groupBy(F.col(text).alias("text")).agg(
            F.count_if(accepted).alias("accepted"), F.count_if(rejected).alias("rejected")),
        model), "url-scores")
    cut = calibrate(scored) if known["a"] and known["b"] else None
    blocked = F.lit(False) if cut is None else bin_of(F.col("score")) >= cut
    columns = [*(c for c in rows.columns if c not in (text, fold)), "score"]
    ruled = rows.filter("rule is not null").withColumn("score", F.lit(None).cast("bigint"))
    judged = rows.filter("rule is null").join(
        scored.select(F.col("text").alias(text), "score"), text, "left").withColumn(
            "verdict", F.when(blocked, "block").otherwise("allow"))
    return ruled.select(*columns).union(judged.select(*columns))
