"""Source divergence, URL filter and token alignment: plain loops, odd rows, tiny parts."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict
from math import log

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from clipframe.llm import align, divergence, tokens, urlfilter
from clipframe.llm import queries as Q
from clipframe.llm.slices import from_planes, planes

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows_of(name, *columns):
    return [tuple(r[c] for c in columns) for r in pq.read_table(f"{SF}/{name}.parquet").to_pylist()]


def collected(df):
    return Counter(tuple(r) for r in df.collect())


def test_planes():
    for dtype in ("<u4", "<u8"):
        values = np.array([0, 1, 255, 256, 65_536, 2**32 - 1], dtype)
        assert from_planes(planes(values, dtype), dtype).tolist() == values.tolist()
    assert from_planes(planes(np.empty(0))).tolist() == []


# source divergence

def divergence_rows(docs, least=3, ranks=200):
    """``docs``: (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(t)) for _, _, t in docs]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [(s, w) for (g, s, _), w in zip(docs, words) if g == lang]
        seen = Counter(t for _, w in mine for t in set(w))
        kept = {t for t, n in seen.items() if n >= least}
        counts = {s: Counter() for s, _ in mine}
        for s, w in mine:
            counts[s].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
             for s, c in [*counts.items(), (None, whole)]}
        for s, c in counts.items():
            def f(t, q, s=s):
                return (p[s][t] - q[t]) ** 2 // q[t]

            pairs = sorted((-sum(f(t, p[o]) for t in kept), o.encode()) for o in counts if o != s)
            terms = sorted((-f(t, p[None]), t.encode()) for t in kept
                           if c[t] and p[s][t] > p[None][t])[:ranks]
            out += [(lang, s, part, item.decode(), -v, i + 1)
                    for part, found in (("pair", pairs), ("term", terms))
                    for i, (v, item) in enumerate(found)]
    return Counter(out)


def odd_sources():
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "gam-ma", "d2e", "été", "x\u00a0y", "z\u3000", "(eta)", "THETA,"]
    rows = [(rng.choice(["en", "", None, "de"]), rng.choice(["s1", "s2", None, ""]),
             rng.choice([" ", "\n\t", "\x0b"]).join(rng.choices(vocabulary, k=rng.randrange(30))))
            for _ in range(120)]
    rows += [("en", "s1", None), ("en", "only", ""), ("xx", "a", "one two"), ("xx", "b", "!!! 12"),
             ("en", "s1", "long " * 30_000 + "tail"), *[("en", "s2", "same same copy")] * 5]
    return rows


@pytest.fixture(scope="module")
def sources(spark):
    rows = odd_sources()
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    return rows, df.withColumns({c: F.lit("clash") for c in ("slice", "bucket", "term", "rank", "p")})


def test_divergence_of_odd_rows(sources):
    rows, df = sources
    want = divergence_rows(rows)
    assert collected(divergence.audit(df.repartition(3))) == want
    assert any(k[2] == "pair" and k[4] == 0 for k in want)


def test_divergence_in_tiny_parts(sources, monkeypatch):
    rows, df = sources
    for name, value in (("SLICE_BYTES", 300), ("FAN_IN", 3), ("BLOCK_SOURCES", 2),
                        ("BUCKET_ROWS", 7), ("CELLS", 5)):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.audit(df.repartition(2), least=2, ranks=3, bucket_bytes=20_000)
    assert collected(got) == divergence_rows(rows, least=2, ranks=3)


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(empty).count() == 0


@needs_tables
def test_divergence_query(spark):
    assert collected(Q.op11_divergence(spark, SF)) == divergence_rows(
        rows_of("documents", "lang", "source", "text"))


# URL filter

RULES = [(r.verdict, r.host, r.path) for r in Q.URL_RULES]


def parted(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return brute.lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


def url_rows(rows, rules=RULES):
    """``rows``: (id, url); a list of (id, host, path, rule, verdict)."""
    order, judged = urlfilter.ORDER_SYMBOLS, []
    for page, url in rows:
        host, path = parted(url)
        fits = [(len(h + p), h + p, v) for v, h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        text = re.sub(r"[^a-z0./-]", "_", re.sub("[0-9]", "0", brute.lower(host + path)))
        fold = hashlib.md5((url or "").encode()).hexdigest()[0] in "012"
        judged.append((page, host, path, *(max(fits)[1:] if fits else (None, None)), text, fold))
    counts = {c: Counter() for c in ("allow", "block")}
    after = {c: defaultdict(set) for c in counts}

    def grams(text):
        padded = "^" * (order - 1) + text + "^"
        return [padded[i:i + order] for i in range(len(text) + 1)]

    for *_, rule, verdict, text, fold in judged:
        if rule and not fold:
            for g in grams(text):
                for k in range(order):
                    counts[verdict][g[k:]] += 1
                    counts[verdict][g[k:-1], "all"] += 1
                    after[verdict][g[k:-1]].add(g[-1])

    def p(c, g):
        if len(g) == 1:
            return (counts[c][g] + 1) / (counts[c]["", "all"] + len(urlfilter.SYMBOLS))
        n, kinds = counts[c][g[:-1], "all"], len(after[c][g[:-1]])
        return (counts[c][g] + kinds * p(c, g[1:])) / (n + kinds) if n else p(c, g[1:])

    def score(text):
        total = 0
        for g in grams(text):
            while len(g) > 1 and not (counts["allow"][g] or counts["block"][g]):
                g = g[1:]
            total += int(np.floor(log(p("block", g) / p("allow", g)) * 1_000_000 + 0.5))
        return int(np.floor(total / len(grams(text))))

    both = all(counts[c]["", "all"] for c in counts)
    bins = [(score(t) // urlfilter.BIN, v) for *_, rule, v, t, fold in judged if rule and fold]
    a, b = (sum(v == c for _, v in bins) for c in ("allow", "block"))
    cut = 0
    if a and b:
        steps = {x for x, _ in bins} | {max(x for x, _ in bins) + 1}
        cut = min(steps, key=lambda s: (
            sum(v == "block" and x < s for x, v in bins) * a
            + sum(v == "allow" and x >= s for x, v in bins) * b, -s))
    return Counter(
        (page, host, path, rule, verdict if rule else
         "block" if both and score(text) // urlfilter.BIN >= cut else "allow")
        for page, host, path, rule, verdict, text, _ in judged)


def judged(df):
    return collected(df.select("page_id", "host", "path", "rule", "verdict"))


ODD_URLS = [None, "", "no scheme", "http://", "https://COM/", "https://com", "a://b.COM", "x://com/?q",
            "http://Example.COM/en/x", "http://www.example.com/en/", "http://www.example.com/enx",
            "http://b.www.example.com/en/1#f", "http://notexample.com/en/", "ftp://a.net/es/", "s://net/fr/",
            "http://net/es", "http://a.org/日本語/é?x", "http://a.org:80/%20/" + "y" * 5000,
            "http://u@h.org#//x.com/", "two://a.com/://b.net/es/", "http://a.org/\n/x", "http://a.org/"]


def test_rules_and_odd_urls(spark):
    rng = random.Random(5)
    rows = list(enumerate(ODD_URLS)) + [(None, "http://a.org/"), (7, "http://a.org/")]
    rows += [(100 + i, f"http://{rng.choice(['shop', 'casino', 'news'])}{rng.randrange(9)}."
              f"{rng.choice(['com/', 'net/es/', 'net/', 'org/'])}{'free-bets' if i % 3 else 'page'}/{i}")
             for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("clash") for c in ("host", "Path", "text", "fold", "gram", "score", "value")})
    want = url_rows(rows)
    assert judged(urlfilter.judge(df.repartition(3), Q.URL_RULES)) == want
    verdicts = {k[1] + k[2]: k[3:] for k in want}
    assert verdicts["com"][0] is None and verdicts["com/"] == ("com/", "allow")
    assert verdicts["example.com/en/x"] == ("example.com/en/", "block")
    assert verdicts["b.www.example.com/en/1"] == ("www.example.com/en/", "allow")
    assert verdicts["notexample.com/en/"] == ("com/", "allow")
    assert {k[4] for k in want if k[3] is None} == {"allow", "block"}


def test_urls_without_labels(spark):
    rows = [(1, "http://a.org/x"), (2, "http://b.com/"), (3, None)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert judged(urlfilter.judge(df, Q.URL_RULES)) == url_rows(rows)
    assert {r["verdict"] for r in urlfilter.judge(df, []).collect()} == {"allow"}
    assert urlfilter.judge(df.limit(0), Q.URL_RULES).count() == 0


def test_url_filter_runs_without_python_workers(spark):
    rows = [(i, f"http://a{i}.{t}/fr/") for i in range(40) for t in ("com", "net", "org")]
    plan = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string"), Q.URL_RULES)
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


@needs_tables
def test_url_query(spark):
    assert collected(Q.op12_url_filter(spark, SF)) == url_rows(rows_of("pages", "page_id", "url"))


# token alignment

def alignment_rows(rows):
    """``rows``: (doc_id, text)."""
    first = Tokenizer.from_file(tokens.default_path())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(
        model_file=tokens.default_path("piece_bpe_32k.model"))
    alphabet, found, docs = align.byte_alphabet(), [], defaultdict(int)

    def shown(piece):
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    for doc, text in rows:
        a = b = []
        if text:
            ids_a = first.encode(" " + text, add_special_tokens=False).ids
            ids_b = second.encode(text)
            a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in ids_a]
            b = [(i, shown(second.id_to_piece(i))) for i in ids_b]
            if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
                a = b = []
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(x) for _, x in side]).tolist()
            spans.append([(i, e - len(x), e) for (i, x), e in zip(side, ends)])
        links, j = Counter(), 0
        for i, begin, end in spans[0]:
            while spans[1][j][2] <= begin:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < end:
                links[i, spans[1][k][0]] += 1
                k += 1
        for pair in links:
            docs[pair] += 1
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        text = ";".join("|".join(",".join(str(i) for i, _, e in side if low < e <= high)
                                 for side in spans) for low, high in zip([0, *cuts], cuts))
        found.append((doc, len(a), len(b), len(cuts), links, brute.digest(text) if a else ""))
    top = defaultdict(int)
    for (i, _), n in docs.items():
        top[i] = max(top[i], n)
    return Counter((doc, n_a, n_b, groups, sum(links.values()),
                    sum(n for pair, n in links.items() if docs[pair] == top[pair[0]]),
                    sum(n * docs[pair] for pair, n in links.items()), digest)
                   for doc, n_a, n_b, groups, links, digest in found)


def odd_texts():
    rng = random.Random(11)
    pool = ["word", "Éclair", "日本語", " ", "  ", "\n", "\n\n", "\t", "\r\n", "▁", "<s>", "</s>", "<unk>",
            "<0x41>", "<|endoftext|>", "😀", "\u00a0", "\u2003", "don't", "12345", "x", "...", "--", "\x00",
            "\u0301", "ﬁ", "ａ", "𝒳", "İ", "\u200b", "\ufeff", "ñandú", "thing", "ing", "."]
    rows = [(i, "".join(rng.choices(pool, k=rng.randrange(1, 25)))) for i in range(150)]
    rows += [(200 + i, " ".join(rng.choices(pool, k=40))) for i in range(40)]
    return rows + [(900, None), (901, ""), (902, " "), (903, "\n"), (None, "no id"), (None, None),
                   (904, "same text"), (904, "same text"), (905, "long words " * 9_000 + "end"),
                   (906, "a" * 3000), (907, "▁"), (908, "plain then ▁ mark")]


def test_alignment_of_odd_texts(spark):
    rows = odd_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("slice", "number", "pair", "count", "best")})
    paths = tokens.default_path(), tokens.default_path("piece_bpe_32k.model")
    want = alignment_rows(rows)
    assert collected(align.alignments(df.repartition(3), *paths)) == want
    assert any(k[0] == 907 and k[1] == 0 and k[7] == "" for k in want)
    assert align.alignments(df.limit(0), *paths).count() == 0


def test_alignment_in_tiny_slices(spark, monkeypatch):
    rows = odd_texts()[140:]
    for name, value in (("SLICE_BYTES", 500), ("BATCH_BYTES", 120), ("REMEMBERED", 60)):
        monkeypatch.setattr(align, name, value)
    paths = tokens.default_path(), tokens.default_path("piece_bpe_32k.model")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(tokens, "worker_state", lambda key, make: make())
    assert collected(align.alignments(df, *paths)) == alignment_rows(rows)


@needs_tables
def test_alignment_query(spark):
    assert collected(Q.op13_alignment(spark, SF)) == alignment_rows(
        rows_of("documents", "doc_id", "text"))
