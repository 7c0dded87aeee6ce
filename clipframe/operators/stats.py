"""Corpus statistics: durations, formats, loudness, header checks, row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipframe.session import pin, side_table

# Quantile sketch: rank error n / ACCURACY; the bracket around the median is
# five times as wide on either side.
ACCURACY = 10_000
BRACKET = 5 / ACCURACY
# Distinct values around a median that one task may sort; wider brackets are cut again.
MIDDLE = 2_000_000
ROUNDS = 8
STEPS = 200        # ranks of a bracket that a round looks at


def _median_near(near: DataFrame, names: Sequence[str], name: str) -> DataFrame:
    """``(names, median)`` of column ``__v``, exact, averaging the two middle values.

    Each row carries the row count ``__n`` of its group and an interval ``__b``
    from a sketch that holds the middle. Rows below it are counted, those inside
    grouped by value. So a task sorts about a thousandth of the distinct values,
    and a value repeated any number of times is one row.
    """
    low, high = F.col("__b")[0], F.col("__b")[1]
    # NULL stands for everything below the interval
    inside = (
        near.filter(F.col("__v") <= high)
        .groupBy(*names, "__n", F.when(F.col("__v") >= low, F.col("__v")).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c")))
    running = F.sum("__c").over(Window.partitionBy(*names).orderBy(F.col("__v").asc_nulls_first()))
    ranked = inside.withColumn("__upto", running)

    def at_rank(rank: Column) -> Column:
        here = (F.col("__upto") >= rank) & (F.col("__upto") - F.col("__c") < rank)
        return F.max(F.when(here, F.col("__v")))

    lower = F.floor((F.col("__n") + 1) / 2)
    upper = F.floor(F.col("__n") / 2) + 1
    found = ranked.groupBy(*names).agg(at_rank(lower).alias("__l"), at_rank(upper).alias("__u"))
    middle = (F.col("__l") + F.col("__u")) / 2
    return found.select(*names, F.when(middle.isNotNull(), middle).otherwise(
        F.raise_error(F.lit("median fell outside its bracket"))).alias(name))


def _narrowed(data: DataFrame, keys: Sequence[str], brackets: DataFrame) -> DataFrame:
    """``brackets (keys, __n, __b)`` made narrower until each holds few distinct values.

    The first bracket holds about a thousandth of the rows. A round counts what lies
    below it, sketches what lies inside and cuts around the ranks of the middle.
    """
    brackets = brackets.withColumn("__d", (F.col("__n") * 2.5 * BRACKET).cast("bigint"))
    for _ in range(ROUNDS):
        wide = (F.col("__d") > MIDDLE) & (F.col("__b")[0] < F.col("__b")[1])
        if brackets.filter(wide).isEmpty():
            break
        if keys:
            near = _join_groups(data, brackets.filter(wide), keys, "inner")
        else:
            only = brackets.first()
            near = data.withColumns({"__n": F.lit(only["__n"]),
                                     "__b": F.array(*[F.lit(x) for x in only["__b"]])})
        inside = F.when(F.col("__v") >= F.col("__b")[0], F.col("__v").cast("double"))
        seen = near.filter(F.col("__v") <= F.col("__b")[1]).groupBy(*keys, "__n").agg(
            F.count(F.lit(1)).alias("__upto"), F.count(inside).alias("__in"),
            F.percentile_approx(inside, [i / STEPS for i in range(STEPS + 1)], ACCURACY).alias("__s"),
            F.approx_count_distinct(inside).alias("__d"))

        def edge(rank: Column, off: int) -> Column:
            below = F.col("__upto") - F.col("__in")
            step = F.round((rank - below) / F.col("__in") * STEPS).cast("int") + off
            return F.col("__s")[F.least(F.greatest(step, F.lit(0)), F.lit(STEPS))]

        cut = seen.select(*keys, "__n", F.array(
            edge(F.floor((F.col("__n") + 1) / 2), -2),
            edge(F.floor(F.col("__n") / 2) + 1, 2)).alias("__b"),
            F.least("__d", F.ceil(F.col("__d") * 5 / STEPS)).alias("__d"))
        brackets = pin(brackets.filter(~wide).unionByName(cut))
    return brackets.drop("__d")


def _join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on group keys where NULL is a group like any other."""
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return df.join(groups.withColumnsRenamed(names), same, how).drop(*names.values())


def duration_stats(df: DataFrame, duration: str = "duration_s", keys: Sequence[str] = (),
                   exact: bool = True) -> DataFrame:
    """Per group: ``n, min_s, max_s, mean_s, median_s, std_s, total_minutes``.

    ``std_s`` is the population deviation. Empty input gives one row with
    ``n = 0`` and NULLs. The data is read twice: once for everything but the
    median, once around the middle. ``exact=False`` takes the median from the
    sketch of the first pass.
    """
    v = F.col(duration)
    shown = ["n", "min_s", "max_s", "mean_s", "median_s", "std_s", "total_minutes"]
    summary = df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.min(v).alias("min_s"), F.max(v).alias("max_s"),
        F.avg(v).alias("mean_s"), F.stddev_pop(v).alias("std_s"),
        (F.sum(v) / 60).alias("total_minutes"),
        F.percentile_approx(v, [0.5 - BRACKET, 0.5, 0.5 + BRACKET], ACCURACY).alias("__q"))
    if not exact:
        return summary.withColumn("median_s", F.col("__q")[1]).select(*keys, *shown)
    data = df.select(*keys, v.alias("__v")).filter(v.isNotNull())
    bracket = F.array(F.col("__q")[0], F.col("__q")[2])
    if keys:
        summary, fits = side_table(summary)
        summary = summary if fits else pin(summary)
        brackets = _narrowed(data, keys, summary.select(
            *keys, F.col("n").alias("__n"), bracket.cast("array<double>").alias("__b")))
        near = _join_groups(data, F.broadcast(brackets) if fits else brackets, keys, "inner")
        medians = _median_near(near, keys, "median_s")
        return _join_groups(summary, medians, keys, "left").select(*keys, *shown)
    row = summary.first()
    if row["n"] == 0:
        return summary.withColumn("median_s", F.lit(None).cast("double")).select(*shown)
    spark = df.sparkSession
    held = spark.createDataFrame([(row["n"], [float(row["__q"][0]), float(row["__q"][2])])],
                                 "__n bigint, __b array<double>")
    low, high = _narrowed(data, [], held).first()["__b"]
    near = data.withColumns({"__n": F.lit(row["n"]), "__b": F.array(F.lit(low), F.lit(high))})
    known = {c: F.lit(row[c]) for c in shown if c != "median_s"}
    return _median_near(near, [], "median_s").withColumns(known).select(*shown)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(attribute, value, n_clips)``: the distinct rates, channel counts, ..."""
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("bigint").alias("value"))
                      for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.attribute", "p.value").agg(
        F.count(F.lit(1)).alias("n_clips"))


def audit_headers(df: DataFrame, sample_rate: int = 16_000, num_channels: int = 1,
                  min_frames: int = 10) -> DataFrame:
    """One row of violation counts: wrong rate, wrong channels, too few frames, no header."""
    def count(bad: Column) -> Column:
        return F.count(F.when(bad, 1))

    return df.agg(
        F.count(F.lit(1)).alias("n"),
        count(F.col("sample_rate") != sample_rate).alias("wrong_rate"),
        count(F.col("num_channels") != num_channels).alias("wrong_channels"),
        count(F.col("num_frames") <= min_frames).alias("too_short"),
        count(F.col("num_frames").isNull()).alias("no_header"))


def mean_level(df: DataFrame, dbfs: str = "dbfs", keys: Sequence[str] = (),
               rejects: bool = False) -> DataFrame:
    """Plain mean of clip levels in dB; one silent clip (-inf) makes it -inf.

    ``rejects`` adds ``n_rejected``, the clips without a level.
    """
    left_out = [F.count(F.when(F.col(dbfs).isNull(), 1)).alias("n_rejected")] if rejects else []
    return df.groupBy(*keys).agg(F.avg(dbfs).alias("mean_dbfs"), F.count(dbfs).alias("n_clips"),
                                 *left_out)


def corpus_counts(df: DataFrame, corpus: str = "corpus") -> DataFrame:
    return df.groupBy(corpus).agg(F.count(F.lit(1)).alias("n"))


def union_all(parts: Mapping[str, DataFrame], columns: Sequence[str] = ("wav_file", "label"),
              corpus: str = "corpus") -> DataFrame:
    """All rows of all corpora, columns matched by name, with the corpus name."""
    frames = [df.select(F.lit(name).alias(corpus), *columns) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, frames)


def assert_counts(parts: DataFrame, union: DataFrame, corpus: str = "corpus") -> DataFrame:
    """``(corpus, n)`` of the union; raises where a corpus lost or gained rows."""
    before = parts.withColumnRenamed("n", "__before")
    after = corpus_counts(union, corpus)
    joined = before.join(after, corpus, "full_outer")
    message = F.concat(F.lit("row count changed for "), F.col(corpus))
    return joined.select(corpus, F.when(F.col("n").eqNullSafe(F.col("__before")), F.col("n"))
                         .otherwise(F.raise_error(message)).alias("n"))
