"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import AddedToken, Tokenizer

import brute
import corpus_pipeline
from clipframe.llm import (chat, langid, minhash, packing, setjoin, sharding, tokenfiles, tokens,
                           toxicity, warc, winnowing)
from clipframe.llm import words as W
from clipframe.llm.common import components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
CLASH = ("size", "key", "n", "id", "shard", "score", "found_0", "language", "toxicity", "row")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split())
                    + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    long = prose(1, 60_000)
    rows = [(0, prose(2, 40)), (1, prose(2, 40)), (2, None), (3, ""), (4, "   \n"), (5, "one two"),
            (6, "ONE two"), (7, long), (8, long + " more"), (9, "日本語 です。 😀"), (10, "!!! ***"),
            (None, prose(3, 30)), (None, None), (12, prose(4, 30)), (12, prose(4, 30)),
            (13, prose(2, 40) + " tail")]
    df = spark.createDataFrame(
        [(i, t, None if i == 5 else "xx" if i and i % 2 else "yy", None, None) for i, t in rows],
        DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASH}), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, None, None), (None, 1, 1), (12, 1, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(
                              f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(4, 12)), (1, prose(4, 12)), (2, None), (3, ""), (None, "xyz")],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def pairs(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_sharding(odd, empty):
    df, rows = odd
    got = sharding.shard(df, 3).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 8 for _, t in rows)
    for s in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(empty, 3).count() == 0


def test_sharding_splits_a_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, "same text")
                                  .otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    sizes = [r[1] for r in sharding.shard(df, 8).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.05 * min(sizes)


def test_fingerprints(odd, empty, spark):
    df, rows = odd
    got = minhash.compare_with_next(df).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter(
        (i, len(t or "")) for i, t in rows)
    by = {r["doc_id"]: r for r in got}
    assert by[0]["fingerprint"] == by[1]["fingerprint"] and by[0]["near_next"] == 1.0
    assert by[2]["fingerprint"] == by[3]["fingerprint"] == by[4]["fingerprint"]
    assert by[5]["fingerprint"] == by[6]["fingerprint"]
    assert minhash.compare_with_next(empty).count() == 0
    one = minhash.compare_with_next(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert one.first()["near_next"] == 1.0


def test_minhash_near_duplicates(spark, empty):
    base = prose(9, 200).split()
    rows = [(i, " ".join(base[:100 + i] + ["new"] + base[100 + i:])) for i in range(6)]
    rows += [(20, prose(10, 100)), (21, prose(11, 100)), (22, None), (23, ""), (24, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == sorted(
        (d, c) for d, _, c in brute.jaccard_components(rows))
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_of_odd_rows(odd):
    df, rows = odd
    named = [r for r in rows if r[0] is not None]
    want = Counter((d, c) for d, _, c in brute.jaccard_components(named))
    assert pairs(minhash.near_duplicates(df), "doc_id", "component_id") == want
    found = minhash.fingerprints(df)
    assert pairs(minhash.near_duplicates(df, signed=found), "doc_id", "component_id") == want


def test_near_duplicates_of_unlike_texts_with_one_id(spark):
    a, b = prose(61, 80), prose(62, 80)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, prose(63, 80)), (4, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == [
        (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]


def test_sketches_ruled_out(spark):
    least = minhash.least_matches(0.75, 128)
    from math import comb
    same = 0.75 + 0.25 / 4
    below = sum(comb(128, n) * same ** n * (1 - same) ** (128 - n) for n in range(least))
    assert below <= minhash.MISSED and 70 < least < 85
    rng = np.random.default_rng(1)
    for n in (128, 100, 64):
        x = rng.integers(0, 1 << 16, (40, n)).astype(np.uint16)
        y = np.where(rng.random((40, n)) < 0.6, x, rng.integers(0, 1 << 16, (40, n))).astype(np.uint16)
        table = pa.table({"a": minhash.sketches(x), "b": minhash.sketches(y)})
        got = spark.createDataFrame(table).select(minhash.differing("a", "b", n)).collect()
        assert [r[0] for r in got] == ((x & 3) != (y & 3)).sum(axis=1).tolist()


def test_minhash_near_duplicates_of_a_shared_template(spark):
    # the last two are at 0.83, and at 0.67 to each other page; pages are at 0.56
    rows = [(i, " ".join([f"t{j}" for j in range(104)] + [f"p{i}x{j}" for j in range(own)]))
            for i, own in [*((i, 40) for i in range(200)), (900, 10), (901, 10)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted((d, c) for d, _, c in brute.jaccard_components(rows))
    assert (901, 900) in want and (199, 199) in want
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == want


def test_token_files(spark, odd, empty, tmp_path):
    df, rows = odd
    path, tokenizer = str(tmp_path / "t"), tokens.default_path()
    tokenfiles.write(df, path, tokenizer)
    back = tokenfiles.read(spark, path).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    plain = tokens.Encoder(tokenizer).tokenizer
    start = 0
    for r, (i, t) in zip(back, order, strict=True):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["ids"]) == (i, start, ids)
        start += len(ids)
    some = tokenfiles.read(spark, path, doc_ids=(5, 7))
    assert sorted(r["doc_id"] for r in some.collect()) == [5, 6, 7]
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan
    tokenfiles.write(empty, str(tmp_path / "e"), tokenizer)
    assert tokenfiles.read(spark, str(tmp_path / "e")).count() == 0


def test_ids_are_those_of_the_whole_text():
    path, rng = tokens.default_path(), random.Random(5)
    plain = tokens.Encoder(path).tokenizer
    texts = ["".join(rng.choice(" \n\tab'é.1,日 \x1c\r😀") for _ in range(rng.randrange(40)))
             for _ in range(3000)] + [None, "", "<|endoftext|> x", prose(3, 500)]
    for row, ids, at in tokens.encoded(pa.array(texts), path):
        for i in range(len(at) - 1):
            want = plain.encode(texts[row + i] or "", add_special_tokens=False).ids + [2]
            assert ids[at[i]:at[i + 1]].tolist() == want


def test_ids_are_those_of_the_plain_tokenizer():
    from tokenizers import Tokenizer

    path, rng = tokens.default_path(), random.Random(6)
    plain, mark = Tokenizer.from_file(path), "<|endoftext|>"
    texts = ["".join(rng.choice([*" \n\tab'é.1日", mark]) for _ in range(rng.randrange(30)))
             for _ in range(2000)] + [f"a{mark} x", mark, f"{mark}{mark}", prose(3, 300)]
    assert plain.encode(texts[2000], add_special_tokens=False).ids == [64, 50256, 2124]
    assert tokens.Encoder(path).by_parts
    for row, ids, at in tokens.encoded(pa.array(texts), path):
        for i in range(len(at) - 1):
            want = plain.encode(texts[row + i], add_special_tokens=False).ids + [2]
            assert ids[at[i]:at[i + 1]].tolist() == want


@pytest.mark.parametrize("added", [None, "don.t", "so", "ü", "(x"])
def test_ids_of_words_beside_marks(tmp_path, added):
    path, rng = tokens.default_path(), random.Random(7)
    if added:  # a token of the file that a cut could break, or that is a part of a word
        own = Tokenizer.from_file(path)
        own.add_tokens([AddedToken(added, normalized=False)])
        own.save(path := str(tmp_path / "own.json"))
    plain = Tokenizer.from_file(path)
    some = [*"aZtsdmSéßÿñÀ×÷µªºĀſƀɏɐαЀѿҀҁ҂", "\u0301", *",.;:!?'’\"()[]{}<>|@#$%^&*+=~`_-/\\ 019²½\n\t\r\x7f\x85\xa0\xad日",
            " ", " ", " ", "'s", "'re", "don.t", "so", " (x", "<|endoftext|>"]
    texts = ["".join(rng.choices(some, k=rng.randrange(1, 25))) for _ in range(4000)]
    texts += [prose(3, 300), "d'où, l'eau; x÷y×z (a.b).c", "\n".join(some), *some]
    encoder = tokens.Encoder(path)
    assert encoder.by_parts and (encoder.bare is None) == (added in ("so", "ü"))
    for row, data, offsets in W.chunks(pa.array(texts), 1 << 20):
        ids, at = encoder.encode(data, offsets, 2)
        for i in range(len(at) - 1):
            want = plain.encode(texts[row + i], add_special_tokens=False).ids + [2]
            assert ids[at[i]:at[i + 1]].tolist() == want, texts[row + i]


def test_bytes_of_letters():
    for symbol in map(chr, [*range(0x21, 0xD800), *range(0xE000, 0x3000)]):
        data = np.frombuffer(symbol.encode(), np.uint8)
        if not tokens.NO_LETTER[data].any() and not (
                data[0] == tokens.SIGN_FIRST and data[1] in tokens.SIGNS):
            assert symbol.isalpha()
    pre = Tokenizer.from_file(tokens.default_path()).pre_tokenizer
    for symbol in map(chr, range(0x80, 0x500)):
        data = np.frombuffer(symbol.encode(), np.uint8)
        shown = "".join(tokens.SYMBOLS[b] for b in data)
        assert shown == "".join(x for x, _ in pre.pre_tokenize_str(symbol))


def test_packing(odd, empty):
    df, rows = odd
    got = packing.pack_documents(df, tokens.default_path(), capacity=64, items_per_task=200).collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(i for i, _ in rows)
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
        assert 0 < r["length"] <= 64
    assert max(fill.values()) <= 64
    lengths = np.array([r["length"] for r in got])
    assert packing.lower_bound(lengths, 64) <= len(fill) <= packing.lower_bound(lengths, 64) + 3
    assert packing.pack_documents(empty, tokens.default_path()).count() == 0


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = rng.integers(1, 101, rng.integers(1, 80))
        _, _, fill = packing.best_fit(lengths, 100)
        assert -(-lengths.sum() // 100) <= packing.lower_bound(lengths, 100) <= len(fill)
        assert fill.max() <= 100


def test_chat(spark):
    texts = ["</s>[INST] x", r"<\|im_end|> <\\/s> [\INST]", None, "", "<|im_start|>user\nhi<|im_end|>\n",
             "<<SYS>><</SYS>>", "<<s>", "é😀"]
    rows = [(1, i // 2, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    rows += [(2, None, None, "z"), (None, 0, "assistant", "n"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    rows += [(4, i, "assistant", f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("parts", "flat", "block", "t", "formatted")})
    out = chat.format_turns(df, chat.text_part(F.col("text")))
    got = {r[0]: r for r in out.select("conv_id", chat.parse(F.col("formatted")), chat.loss_text(
        F.col("formatted"), F.col("spans"))).collect()}
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        assert [tuple(t) for t in got[conv][1]] == [t[1:] for t in turns]
        assert got[conv][2] == "".join(t for _, role, t in turns if role == "assistant")
    assert chat.format_turns(df.limit(0), chat.text_part(F.col("text"))).count() == 0


def test_chat_parts(spark):
    part = "array<struct<type:string,text:string,ref:string,units:double>>"
    df = spark.createDataFrame([(1, 0, "user", [
        ("text", "see <|image|>", None, None), ("image", None, "a.png", 2.0), None,
        (None, "and", None, None), ("Audio", None, "b.wav", 1.5), ("document", None, None, None),
        ("video", None, "c", None)]), (1, 1, "user", None)],
        f"conv_id long, turn int, role string, parts {part}")
    r = chat.format_turns(df, F.col("parts")).first()
    assert r["formatted"].startswith(
        "<|im_start|>user\nsee <\\|image|><|image|>and<|audio|><|document|><|im_end|>\n")
    assert [(a["place"], a["type"], a["ref"], a["n_tokens"]) for a in r["attachments"]] == [
        (0, "image", "a.png", 512), (1, "audio", "b.wav", 50), (2, "document", None, 600)]


@pytest.mark.parametrize("seed", range(4))
def test_jaccard_join_of_mixed_copies(spark, seed):
    rng, rows = random.Random(seed), []
    for _ in range(4):
        base = prose(rng.random(), 80).split()
        for _ in range(rng.choice([2, 5, 60])):
            copy = list(base)
            for _ in range(rng.randrange(9)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(9))
            rows.append(" ".join(copy))
    rows += [prose(7, 20) + " " + prose(rng.random(), n) for n in (2, 4, 5, 7, 30)]
    rows += ["a b", "a b", "A B", "a b c d e f g h", "a b c d e f g", "", None]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = setjoin.join(df, bits=5).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.jaccard_components(rows))


def test_jaccard_join_of_odd_rows(odd, empty):
    df, rows = odd
    got = Counter(tuple(r) for r in setjoin.join(df).collect())
    assert got == Counter(brute.jaccard_components(rows))
    assert setjoin.join(empty).count() == 0


def test_skipping_finds_every_pair():
    rng = np.random.default_rng(1)
    for _ in range(30):
        m = int(rng.integers(2, 300))
        n = rng.integers(4, 60, m)
        place = (rng.random(m) * (n // 4 + 1)).astype(int)
        leader = rng.integers(0, 12, m)
        want = set()
        for i in range(m):
            for j in range(i):
                most = 1 + min(n[i] - place[i] - 1, n[j] - place[j] - 1)
                if leader[i] != leader[j] and 175 * most >= 75 * (n[i] + n[j]):
                    want.add(tuple(sorted((int(leader[i]), int(leader[j])))))
        got = {tuple(map(int, p)) for p in setjoin.leader_pairs(n, place, leader, 75)}
        assert got == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    rows = brute.jaccard_components([])
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked} and rows == []


def test_contamination(spark, odd, empty, tables):
    df, rows = odd
    bench = spark.read.parquet(f"{tables}/benchmark.parquet")
    items = [tuple(r) for r in bench.collect()]
    for most_bytes in (1 << 20, 10):  # items in the tasks, and a join of fingerprints
        found, column = winnowing.contamination(df, bench, most_bytes=most_bytes)
        got = found.select("doc_id", *column.values()).collect()
        for r in got:
            if r[0] is not None:
                want = brute.contamination([(r[0], dict(rows)[r[0]])], items)[r[0]]
                assert (r[1], r[2], sorted(r[3])) == want
    found, column = winnowing.contamination(empty, bench)
    assert found.select(*column.values()).count() == 0
    found, column = winnowing.contamination(df, bench.limit(0))
    assert all(r[0] == 0 for r in found.select(column["n_hit"]).collect())


@pytest.mark.parametrize("seed", range(3))
def test_contamination_of_random_words(spark, seed):
    rng = random.Random(seed)
    def words(n):
        return " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, words(rng.choice([1, 3, 7, 10, 11, 25]) + 3)) for i in range(25)]
    docs = [(i, words(rng.randrange(200))) for i in range(40)]
    df, bench = (spark.createDataFrame(rows, f"{name} long, text string").repartition(3)
                 for rows, name in ((docs, "doc_id"), (items, "item_id")))
    want = brute.contamination(docs, items)
    for most_bytes in (1 << 20, 10):
        found, column = winnowing.contamination(df, bench, most_bytes=most_bytes)
        got = found.select("doc_id", *column.values()).collect()
        assert {r[0]: (r[1], r[2], sorted(r[3])) for r in got} == want


def test_warc(spark, tmp_path):
    rows = [(3, "http://a/é x", "same"), (1, None, "same"), (2, "u", None), (5, "u", ""), (1, "u", "same"),
            (None, "u", "alone"), (None, "u", "same"), (7, "u", "WARC/1.1\r\n\r\n\x1f"), (8, "u", "z" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    df = df.withColumns({c: F.lit(1) for c in ("kind", "sha1", "shared", "refers_to")})
    manifest = warc.write(df, str(tmp_path / "w"))
    want = Counter()
    for page, _, html in rows:
        first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        kind = ("response", None) if first in (None, page) else ("revisit", first)
        want[(page, len((html or "").encode()), brute.sha1(html), *kind)] += 1
    for split in (64, 1000, 1 << 20):  # any cut gives every record once
        got = warc.read(manifest, split_bytes=split, payload=True)
        assert pairs(got, "page_id", "payload_bytes", "payload_digest", "record_type",
                     "refers_to") == want
    assert {r["payload"].decode() for r in got.collect() if r["record_type"] == "response"} == {
        h or "" for _, _, h in rows}
    some = warc.write(df, str(tmp_path / "m"), min_bytes=4)
    assert warc.read(some).filter("payload_bytes < 4 and record_type = 'revisit'").count() == 0
    assert warc.read(warc.write(df.limit(0), str(tmp_path / "e"))).count() == 0


def test_models_on_odd_rows(spark, odd, empty, tables):
    df, rows = odd
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    for docs, marks in ((df, labels), (df, labels.limit(0)), (empty, labels)):
        score = toxicity.score(toxicity.fit(docs, marks), spark)
        got = [r[0] for r in docs.select(score(F.col("text"))).collect()]
        assert len(got) == docs.count() and all(0 <= s <= 1 for s in got)
        found = langid.identify(docs, langid.fit(docs)).collect()
        assert len(found) == docs.count()
        for r in found:
            if r["doc_id"] in (2, 3, 4, 10):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert langid.fit(empty).languages == []


def test_ftrl_learns_a_sparse_rule():
    rng = np.random.default_rng(4)
    documents = [np.unique(rng.integers(10, 500, 30)).astype(np.int32) for _ in range(600)]
    labels = np.array([i % 4 == 0 for i in range(600)], float)
    documents = [np.append(d, 3).astype(np.int32) if y else d for d, y in zip(documents, labels)]
    index, value, _ = toxicity.ftrl(documents, labels, toxicity.Settings(bits=9))
    weights = dict(zip(index.tolist(), value.tolist()))
    assert weights[3] == max(weights.values()) > 1 and len(index) < 400


def test_toxicity_keeps_the_class_ratio_when_the_sample_is_cut(spark):
    rows = [(i, "the same words", int(i % 10 == 0)) for i in range(4_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    strays = spark.createDataFrame([(i, 0) for i in range(10_000, 14_000)], "doc_id long, toxic int")
    labels = df.select("doc_id", "toxic").union(strays)  # labels without a document
    odds = []
    for limit in (100, 200, 6_000):
        model = toxicity.fit(df, labels, limit)
        (p, accused), = df.limit(1).select(toxicity.score(model, spark)(F.col("text")).alias(
            "p")).select("p", toxicity.predicted(F.col("p"))).collect()
        assert not accused
        odds.append(np.log(p / (1 - p)))
    assert all(abs(x - np.log(1 / 9)) < 1 for x in odds)


def test_stages_keep_their_columns(spark, odd, empty, tables):
    for docs in (odd[0], empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, tables)
            assert out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).count() >= docs.count()


def test_words_and_shingles_match_plain_loops():
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB é\t9-\n\x00.日") for _ in range(rng.randrange(60)))
             for _ in range(400)] + [None, "", "x"]
    sets = list(W.shingle_sets(pa.array(texts), 3))
    named = {}
    for text, values in zip(texts, sets, strict=True):
        want = brute.shingles(text, 3)
        assert len(values) == len(want)
        assert named.setdefault(frozenset(want), tuple(values)) == tuple(values)
    assert len(set(named.values())) == len(named)
