"""Exact stratified split without sorting or moving the data.

Rows of a class are ranked by ``md5(seed:key)``, then key; the first ``quota``
rows are the dev side. The quota-th row is located from a histogram of hash
prefixes plus a sort of one small bucket per class. Its rank is then a cut-off
every row is compared with in place: the data itself is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipframe.functions.scores import seeded_hash
from clipframe.session import lookup_join


def class_quotas(counts: DataFrame, label: str, test_share: float) -> DataFrame:
    """``(label, class_rows, quota)`` by largest remainders, ties by label.

    ``counts`` has one row per class: ``(label, class_rows)``. Raises for a
    class with one row, or a side with fewer rows than classes.
    """
    everything = Window.partitionBy()
    total = counts.select(
        label, "class_rows",
        F.sum("class_rows").over(everything).alias("__n"),
        F.count(F.lit(1)).over(everything).alias("__classes"),
        F.min("class_rows").over(everything).alias("__smallest"))
    total = total.withColumn("__dev", F.ceil(F.col("__n") * F.lit(test_share)))
    # whole and fractional part of class_rows * dev / n in integers
    scaled = F.col("class_rows").cast("decimal(38,0)") * F.col("__dev")
    total = total.withColumns({
        "__whole": F.floor(scaled / F.col("__n")).cast("bigint"),
        "__rest": (scaled % F.col("__n")).cast("bigint"),
    })
    by_rest = everything.orderBy(F.col("__rest").desc(), F.col(label).asc())
    spare = F.col("__dev") - F.sum("__whole").over(everything)
    quota = F.col("__whole") + (F.row_number().over(by_rest) <= spare).cast("int")
    bad = (
        F.when(F.col("__smallest") < 2, "a class has fewer than 2 rows")
        .when(F.col("__dev") < F.col("__classes"), "dev side has fewer rows than classes")
        .when(F.col("__n") - F.col("__dev") < F.col("__classes"),
              "train side has fewer rows than classes"))
    checked = F.when(bad.isNotNull(), F.raise_error(bad).cast("bigint")).otherwise(quota)
    return total.select(label, "class_rows", checked.cast("bigint").alias("quota"))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2,
                     seed: int = 42, digits: int = 3, split_col: str = "split") -> DataFrame:
    """Add ``split`` = ``dev`` / ``train`` with exact class quotas.

    ``key`` identifies a row. ``digits`` hex digits make ``16**digits`` buckets
    per class; one bucket of one class is the most a task sorts. Rows without a
    label get no split.
    """
    rank = seeded_hash(seed, F.col(key))
    keyed = df.filter(F.col(label).isNotNull()).select(
        label, F.col(key).alias("__key"), rank.alias("__rank"),
        F.substring(rank, 1, digits).alias("__bucket"))

    histogram = keyed.groupBy(label, "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    in_class = Window.partitionBy(label).orderBy("__bucket")
    before = F.coalesce(F.sum("__rows").over(
        in_class.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = histogram.groupBy(label).agg(F.sum("__rows").alias("class_rows"))
    quotas = class_quotas(counts, label, test_share)
    boundary = (
        histogram.withColumn("__before", before)
        .join(quotas.select(label, "quota"), label)
        .filter((F.col("__before") < F.col("quota"))
                & (F.col("quota") <= F.col("__before") + F.col("__rows")))
        .select(label, "__bucket", (F.col("quota") - F.col("__before")).alias("__take")))

    in_bucket = Window.partitionBy(label).orderBy("__rank", "__key")
    following = F.lead(F.struct("__rank", "__key")).over(in_bucket)
    cut = (
        lookup_join(keyed, boundary, [label, "__bucket"], "inner")
        .select(label, "__rank", "__key", "__take",
                F.row_number().over(in_bucket).alias("__n"), following.alias("__next"))
        .filter(F.col("__n") == F.col("__take"))
        .select(label, F.when(
            F.col("__next") == F.struct("__rank", "__key"),
            F.raise_error(F.lit("split key is not unique"))
            .cast(keyed.select(F.struct("__rank", "__key")).schema[0].dataType),
        ).otherwise(F.struct("__rank", "__key")).alias("__cut")))

    dev = F.struct(rank.alias("__rank"), F.col(key).alias("__key")) <= F.col("__cut")
    side = F.when(F.col(label).isNotNull(),
                  F.when(F.coalesce(dev, F.lit(False)), "dev").otherwise("train"))
    return lookup_join(df, cut, [label]).withColumn(split_col, side).drop("__cut").select(
        *df.columns, split_col)
