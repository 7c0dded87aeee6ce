"""Exact joins of crowds: many sets that are much alike, below and around the threshold."""

import random

import numpy as np
import pytest

import brute
from clipframe.llm import setjoin


def joined(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(tuple(r) for r in setjoin.join(df).collect())


def template(n, own, seed=0):
    """Pages of one template whose own words leave two of them at 0.73."""
    return [(i, " ".join([f"t{j}" for j in range(120)] + [f"p{seed}x{i}y{j}" for j in range(own)]))
            for i in range(n)]


def test_a_crowd_just_below_the_threshold(spark):
    rows = template(2_000, 22)
    want = [(i, len(brute.shingles(t)), i) for i, t in rows]  # all are at 0.73 to each other
    assert len(brute.shingles(rows[0][1]) & brute.shingles(rows[1][1])) * 100 < 75 * (
        2 * want[0][1] - 116) and joined(spark, rows) == want


def test_few_pairs_leave_the_index(spark):
    rows = template(400, 22)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = setjoin.candidate_sets(df, 5, 75)
    led = setjoin.followers(sets, 75)
    assert led.count() > 390 and led.filter("link").count() == 0
    placed = sets.join(led, "id", "left").selectExpr(
        "id", "n", "tokens", "coalesce(leader, id) as leader")
    assert setjoin.candidate_leaders(placed, 5, 75).count() <= 10


@pytest.mark.parametrize("seed", range(4))
def test_crowds_in_tiny_blocks(spark, monkeypatch, seed):
    for name, value in (("CROWD", 4), ("MEMBERS", 5), ("PROBES", 6), ("CELLS", 500), ("BLOCK", 4)):
        monkeypatch.setattr(setjoin, name, value)
    rng = random.Random(seed)
    rows = []
    for i in range(260):
        words = [f"t{j}" for j in range(60)]
        words += [f"g{rng.randrange(6)}x{j}" for j in range(rng.choice([0, 4, 8]))]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(12)}"
        words += [f"p{i}x{j}" for j in range(rng.randrange(16))]
        rows.append((i, " ".join(words[rng.randrange(6):])))
    assert joined(spark, rows) == sorted(brute.jaccard_components(rows))


def test_members_apart_from_linked_leaders(spark):
    """Leaders of two crowds are linked; of each crowd one member is linked to one of the other only."""
    salt = setjoin.W.stream(5, setjoin.STARS)[0]

    def place(word):  # of the word among the smallest shingles in the first order
        value = next(iter(setjoin.W.shingle_sets(setjoin.pa.array([word]), 1)))
        return int(setjoin.W.mix((value >> np.uint64(64 - 5 - setjoin.LOW_BITS)) ^ salt)[0])

    first, second, *core = sorted((f"w{i}" for i in range(300)), key=place)[:62]
    more = sorted((f"m{i}" for i in range(300)), key=place)[-30:]
    rows = [(1 + 100 * side + i, " ".join([*core, mark, f"own{side}x{i}"]))
            for side, mark in enumerate((first, second)) for i in range(setjoin.CROWD)]
    rows += [(300 + side, " ".join([*core, mark, *more])) for side, mark in enumerate((first, second))]
    sets = setjoin.written(setjoin.candidate_sets(
        spark.createDataFrame(rows, "doc_id long, text string"), 5, 75, 1), "sets")
    led = setjoin.followers(sets, 75)
    assert led.filter("not link").select("leader").distinct().count() == 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in setjoin.join(df, k=1).collect()}
    assert got == {i: 300 if i >= 300 else 1 for i, _ in rows}


def test_overlaps_by_differences():
    rng = np.random.default_rng(2)

    def some():
        return np.sort(rng.choice(60, rng.integers(0, 40), False).astype(np.uint64))

    head, members, probes = some(), [some() for _ in range(9)], [some() for _ in range(7)]
    got = setjoin.overlaps(probes, head, members)
    assert got.tolist() == [[len(np.intersect1d(p, m)) for m in members] for p in probes]


def test_forest_joins_what_all_links_join():
    rng = np.random.default_rng(3)
    for _ in range(50):
        p, m = rng.integers(1, 12, 2)
        hit = rng.random((p, m)) < rng.choice([0.05, 0.2, 0.6])
        own, names = rng.integers(0, 9, p), rng.integers(0, 9, m)
        ids, others = np.arange(p) + 100, np.arange(m) + 200

        def components(edges):
            label = {**{i: f"c{c}" for i, c in zip(ids, own)}, **{i: f"c{c}" for i, c in zip(others, names)}}
            for a, b in edges:
                old, new = label[a], label[b]
                label = {k: new if v == old else v for k, v in label.items()}
            groups = {}
            for k, v in label.items():
                groups.setdefault(v, set()).add(int(k))
            return sorted(map(sorted, groups.values()))

        edges = setjoin.forest(hit, ids, own, others, names)
        whole = [(ids[i], others[j]) for i, j in zip(*np.nonzero(hit))]
        assert components(edges) == components(whole)
        assert len(edges) <= len(set(own) | set(names))
