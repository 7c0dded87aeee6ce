import hashlib
import math
from collections import Counter

import pytest

from clipframe.operators.split import stratified_split


def brute_split(rows, share=0.2, seed=42):
    """Keys of the dev side by sorting every class."""
    classes = Counter(label for _, label in rows)
    n = len(rows)
    dev = math.ceil(n * share - 1e-9)
    floors = {c: k * dev // n for c, k in classes.items()}
    order = sorted(classes, key=lambda c: (-(classes[c] * dev % n), c))
    for c in order[:dev - sum(floors.values())]:
        floors[c] += 1
    taken = set()
    for c, quota in floors.items():
        keys = sorted((hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k)
                      for k, label in rows if label == c)
        taken |= {k for _, k in keys[:quota]}
    return taken, floors


def make(spark, sizes):
    rows = [(f"{c}/{i}.wav", c) for c, size in sizes.items() for i in range(size)]
    return rows, spark.createDataFrame(rows, "k string, label string")


@pytest.mark.parametrize("sizes", [
    {"a": 129, "b": 106, "c": 620, "d": 145}, {"hot": 4_000, "x": 5, "y": 37}, {"a": 10, "b": 10}])
@pytest.mark.parametrize("digits,partitions", [(1, 1), (3, 7), (4, 3)])
def test_split_equals_sorting(spark, sizes, digits, partitions):
    rows, df = make(spark, sizes)
    taken, quotas = brute_split(rows)
    out = stratified_split(df.repartition(partitions), "label", "k", digits=digits).collect()
    assert len(out) == len(rows)
    assert {r.k for r in out if r.split == "dev"} == taken
    assert {r.k for r in out if r.split == "train"} == {k for k, _ in rows} - taken
    assert Counter(r.label for r in out if r.split == "dev") == Counter(
        {c: q for c, q in quotas.items() if q})


def test_golden_quotas(spark):
    _, df = make(spark, {"de": 129, "es": 106, "en": 620, "fr": 145})
    dev = stratified_split(df, "label", "k").filter("split = 'dev'").groupBy("label").count()
    assert {r.label: r["count"] for r in dev.collect()} == {"de": 26, "es": 21, "en": 124, "fr": 29}


@pytest.mark.parametrize("sizes,message", [
    ({"a": 1, "b": 20}, "fewer than 2 rows"),
    ({"a": 2, "b": 2}, "dev side has fewer rows"),
])
def test_refused_splits(spark, sizes, message):
    _, df = make(spark, sizes)
    with pytest.raises(Exception, match=message):
        stratified_split(df, "label", "k").collect()


def test_too_small_train_side(spark):
    _, df = make(spark, {"a": 5, "b": 5})
    with pytest.raises(Exception, match="train side has fewer rows"):
        stratified_split(df, "label", "k", test_share=0.9).collect()


def test_rows_without_label_get_no_split(spark):
    _, df = make(spark, {"a": 50, "b": 50})
    more = df.union(spark.createDataFrame([("x", None)], df.schema))
    out = stratified_split(more, "label", "k").collect()
    assert len(out) == 101
    assert [r.split for r in out if r.k == "x"] == [None]
    assert sum(r.split == "dev" for r in out) == 20


def test_repeated_keys_are_refused(spark):
    _, df = make(spark, {"a": 50})
    same = df.withColumn("k", df.label)
    with pytest.raises(Exception, match="not unique"):
        stratified_split(same, "label", "k").collect()
