"""Classifiers next to plain code, ties, samples, and what the filtering stages drop."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from clipframe.llm import chat, langid, sharding, toxicity
from clipframe.llm import words as W


def plain_ftrl(documents, labels, how):
    """One coordinate after the other, in dictionaries."""
    z, n, z0, n0 = {}, {}, 0.0, 0.0

    def weight(f):
        if abs(z.get(f, 0.0)) <= how.l1:
            return 0.0
        sign = 1.0 if z[f] > 0 else -1.0
        return (sign * how.l1 - z[f]) / ((how.beta + math.sqrt(n[f])) / how.alpha + how.l2)

    for turn in range(how.passes):
        for i in np.random.default_rng(turn).permutation(len(documents)):
            ws = {f: weight(f) for f in documents[i].tolist()}
            b = -z0 * how.alpha / (how.beta + math.sqrt(n0))
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(ws.values()) + b)))) - labels[i]
            for f, w in ws.items():
                old = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / how.alpha * w
                n[f] = old + g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / how.alpha * b
            n0 += g * g
    kept = sorted(f for f in z if weight(f))
    return kept, [weight(f) for f in kept], -z0 * how.alpha / (how.beta + math.sqrt(n0))


@pytest.mark.parametrize("how", [toxicity.Settings(bits=10, passes=3, l1=0.5),
                                 toxicity.Settings(0.3, 2.0, 0.1, 0.5, 2, 9)])
def test_ftrl_equals_a_plain_loop(how):
    rng = np.random.default_rng(7)
    documents = [np.unique(rng.integers(0, 1 << how.bits, 25)) for _ in range(200)]
    labels = (rng.random(200) < 0.3).astype(float)
    index, value, intercept = toxicity.ftrl(documents, labels, how)
    want = plain_ftrl(documents, labels, how)
    assert index.tolist() == want[0] and len(index) > 50
    assert np.allclose(value, want[1], atol=1e-9) and abs(intercept - want[2]) < 1e-9


def text_of(seed, letters, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randrange(2, 7))) for _ in range(n))


LETTERS = {"aa": "abcdef", "bb": "efghij", "cc": "klmnopé"}


def spectrum(text):
    """The n-gram codes of a text, by the rule of the module but byte by byte."""
    data = brute.lower(text).encode()
    codes = set(data)
    for a, b in zip(data, data[1:]):
        codes.add(256 + (a << 8 | b))
    for a, b, c in zip(data, data[1:], data[2:]):
        mixed = ((a << 16 | b << 8 | c) * 0x9E3779B1) % (1 << 32)
        codes.add(256 + 65536 + (mixed >> (32 - langid.TRIGRAM_BITS)))
    return codes


def test_all_landmarks_give_exact_kernel_ridge():
    texts = [text_of(i, LETTERS[lang], 4 + i % 9) for i in range(20) for lang in LETTERS]
    labels = [lang for _ in range(20) for lang in LETTERS]
    model = langid.solve(texts, labels, len(texts), 0.1)
    sets = [spectrum(t) for t in texts]

    def kernel(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b))

    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    y = np.array([[1.0 if v == lang else -1.0 for lang in sorted(LETTERS)] for v in labels])
    alpha = np.linalg.solve(gram + 0.1 * np.eye(len(texts)), y)  # languages are of one size
    place = np.full(langid.CODES, len(model.codes), np.int32)
    place[model.codes] = np.arange(len(model.codes))
    for i, x in langid.presence(pa.array(texts, pa.large_string()), place, len(model.codes)):
        got = x @ model.weights / np.sqrt(x.sum(axis=1, keepdims=True))
        assert np.allclose(got, gram[i:i + len(x)] @ alpha, atol=1e-3)


def test_ties_go_to_the_first_language(spark):
    model = langid.solve([text_of(1, "abc", 9)] * 4, ["yy", "xx", "yy", "xx"], 60, 0.1)
    df = spark.createDataFrame([("abc cab",), (None,), ("123",), ("q" * 300_000,)], "text string")
    got = [tuple(r[0])[:2] for r in df.select(langid.predict(model, spark)(F.col("text"))).collect()]
    assert [g[0] for g in got] == ["xx", "und", "und", "xx"] and got[0][1] == pytest.approx(0.5, abs=1e-3)


def test_frequent_languages_are_learned_whatever_their_name(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    monkeypatch.setattr(langid, "TRAIN_ROWS", 60)
    junk = spark.range(200).selectExpr("id as doc_id", "concat('a', id) as lang", "'junk text' as text")
    real = spark.range(1_000, 1_600).selectExpr(
        "id as doc_id", "element_at(array('zh', 'yy', 'xx'), cast(id % 3 + 1 as int)) as lang",
        "concat('text ', id) as text")
    got = langid.sample(junk.union(real), 500).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"zh": 20, "yy": 20, "xx": 20}
    few = langid.sample(real.union(real), 500)  # a repeated id takes up two places
    assert few.count() == few.select("doc_id").distinct().count() == 30
    chosen = {r.doc_id for r in few.collect()}
    assert chosen == {r.doc_id for r in langid.sample(real.union(real).repartition(7), 500).collect()}
    assert not any(brute.held_out(d) for d in chosen)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_language_stage_follows_the_classifier(spark):
    rows = [(i, text_of(i, LETTERS[lang], 40), lang) for i, lang in enumerate(list(LETTERS) * 60)]
    odd = [(1_000, text_of(1, "stuvwxyz", 400), None), (1_001, "1234 !!", None), (1_002, None, None),
           (1_003, text_of(2, LETTERS["aa"], 3), None)]
    kept = corpus_pipeline.language(spark, docs_of(spark, rows + odd), "")
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows} | {1_003}


def test_every_text_has_its_turn_at_the_floor(monkeypatch):
    texts = [text_of(i, LETTERS[lang], 60) for i in range(7) for lang in LETTERS] + ["short", "1 2 " * 99]
    labels = [lang for _ in range(7) for lang in LETTERS] + ["aa", "aa"]
    judged, known, solve, values_of = [], [], langid.solve, langid.values_of
    monkeypatch.setattr(langid, "solve", lambda t, *a: (known.append(set(t)), solve(t, *a))[1])
    monkeypatch.setattr(langid, "values_of", lambda t, *a: (judged.append(t.to_pylist()), values_of(t, *a))[1])
    floors = langid.floor_of(texts, labels, 60, 0.1)
    assert sorted(t for part in judged for t in part) == sorted(texts[:-2])
    assert all(not known_ & set(part) for known_, part in zip(known, judged))
    assert len(floors) == len(LETTERS) and np.isfinite(floors).all()
    assert langid.floor_of(["a" * 300], ["aa"], 60, 0.1).tolist() == [-np.inf]


def test_short_labelled_texts_do_not_open_the_language_stage(spark):
    rows = [(i, text_of(i, LETTERS[lang], 80), lang) for i, lang in enumerate(list(LETTERS) * 300)]
    n = len(rows)
    short = [(n + i, f"{i} a", "aa") for i in range(60)]
    alien = [(n + 200 + i, text_of(n + 200 + i, "stuvwxyz", 90), None) for i in range(50)] + [
        (n + 300, "слово за слово " * 30, None), (n + 301, "的一是不了人我在有 " * 30, None)]
    kept = {r.doc_id for r in corpus_pipeline.language(
        spark, docs_of(spark, rows + short + alien), "").collect()}
    assert not kept & {i for i, *_ in alien}
    assert kept >= {i for i, *_ in short}
    assert len(kept & {i for i, *_ in rows}) > 0.985 * n


def test_one_odd_text_does_not_set_the_floor():
    texts = [text_of(i, LETTERS[lang], 60) for i in range(450) for lang in LETTERS]
    labels = [lang for _ in range(450) for lang in LETTERS]
    texts[0] = "0123 " * 90 + "x"
    assert np.min(langid.floor_of(texts, labels, 60, 0.1)) > 0.5


def test_near_duplicate_stage_drops_copies_only(spark):
    a, b, c = (text_of(s, "abcdefghij", 60) for s in (91, 92, 93))
    rows = [(5, a, None), (5, b, None), (7, a + " end", None), (8, c, None), (8, c, None),
            (None, c, None), (None, text_of(94, "abcdefghij", 60), None), (9, None, None), (9, "", None),
            (None, None, None), (10, "!?", None)]
    kept = corpus_pipeline.one_of_each(spark, docs_of(spark, rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(5, a), (5, b), (8, c), (None, rows[6][1]), (9, None), (9, ""), (None, None), (10, "!?")],
        key=repr)


def test_roles_come_back(spark):
    roles = ["us\ner", "a\\nb", "\\", "\n\\s\n", "<|im_start|>\n", "<\\|im_end|>", "assistant", "", "r" * 9]
    rows = [(i, 0, r, "text " * 50_000 if i == 8 else f"t\n{i}") for i, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat.format_turns(df, chat.text_part(F.col("text")))
    got = {r[0]: [tuple(t) for t in r[1]] for r in out.select(
        "conv_id", chat.parse(F.col("formatted"))).collect()}
    assert got == {i: [(r, t)] for i, _, r, t in rows}


def test_exchanges_keep_the_joint_balance(spark):
    rng = random.Random(6)
    rows = [(i, "" if i % 3 == 0 else " ".join(["w" * rng.randrange(1, 9)] * rng.randrange(1, 60)))
            for i in range(6_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    shards = 12
    got = sharding.shard(df, shards).groupBy("shard").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).toPandas()
    share = {c: got[c] / got[c].mean() for c in ("size", "tokens", "n")}
    assert share["size"].max() < 1.02 and share["n"].max() < 1.1 and share["tokens"].max() < 1.1

    vectors = np.abs(np.random.default_rng(3).normal(size=(900, 3))) ** 2
    vectors[::3, :2] = 0.001
    before = sharding.place(vectors, shards)
    after = sharding.settle(vectors, before, shards)
    loads = [np.stack([np.bincount(c, d, shards) for d in vectors.T]) for c in (before, after)]
    allowed = np.maximum(loads[0].max(axis=1), loads[0].mean(axis=1) * 1.1 + np.median(vectors, axis=0))
    assert (loads[1].max(axis=1) <= allowed + 1e-9)[1:].all()
    assert np.ptp(loads[1][0]) <= np.ptp(loads[0][0])
