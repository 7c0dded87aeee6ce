"""A text and its complement of a build that sums of powers cannot tell apart."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import brute
from clipframe.llm import minhash, packing, setjoin, tokenfiles, tokens, winnowing
from clipframe.llm import words as W

SIZES = (1024, 2048, 4096)
SWAP = str.maketrans("ab", "ba")


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [x for i, n in enumerate(SIZES)
            for x in ((2 * i, thue_morse(n)), (2 * i + 1, thue_morse(n).translate(SWAP)))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_hashes_differ():
    strings = [thue_morse(n) for n in SIZES] + [thue_morse(n).translate(SWAP) for n in SIZES]
    strings += ["a" * n for n in range(1, 200)] + ["b" * n for n in range(1, 200)]
    data = np.frombuffer("".join(strings).encode(), np.uint8)
    starts = np.cumsum([0] + [len(s) for s in strings[:-1]])
    hashes = W.string_hashes(data, starts)
    assert len(set(hashes.tolist())) == len(strings)
    for s, h in zip(strings, hashes):  # whatever lies around it
        assert W.string_hashes(np.frombuffer(s.encode(), np.uint8), np.array([0]))[0] == h


def test_token_ids(spark, pairs, tmp_path):
    rows, df = pairs
    plain = Tokenizer.from_file(tokens.default_path())
    want = {i: [*plain.encode(t, add_special_tokens=False).ids, 2] for i, t in rows}
    tokenfiles.write(df, str(tmp_path / "t"), tokens.default_path())
    got = tokenfiles.read(spark, str(tmp_path / "t")).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want
    packed = packing.pack_documents(df, tokens.default_path()).filter("piece = 0").collect()
    for r in packed:
        ids = np.array(want[r["doc_id"]][:r["length"]], "<u4")
        assert r["ids_crc32"] == brute.crc(ids.tobytes())


def test_strings_of_added_tokens_as_plain_text():
    text = "a<|endoftext|> x\n<|endoftext|>"
    reference = Tokenizer.from_file(tokens.default_path())
    reference.encode_special_tokens = True
    for plain, same in ((True, reference), (False, Tokenizer.from_file(tokens.default_path()))):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = tokens.Encoder(tokens.default_path(), plain).encode(
            data, np.array([0, len(data)]), 2)
        assert ids.tolist() == [*same.encode(text, add_special_tokens=False).ids, 2]


def test_no_links(spark, pairs):
    rows, df = pairs
    alone = [(i, i) for i, _ in rows]
    assert sorted((r["doc_id"], r["component_id"]) for r in setjoin.join(df).collect()) == alone
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == alone
    prints = minhash.signatures(pa.array([t for _, t in rows]), 5, 128)
    assert len({row.tobytes() for row in prints}) == len(rows)


def test_no_hits(spark, pairs):
    rows, df = pairs
    items = df.filter("doc_id % 2 = 0").selectExpr("doc_id as item_id", "text")
    found, column = winnowing.contamination(df, items)
    got = found.select("doc_id", column["n_hit"].alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {i: 1 - i % 2 for i, _ in rows}
