import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.contract import ORACLES, QUERIES, URL_RULES
from millrace.llm.sharding import OVERHEAD, shard_by_bytes
from millrace.llm.token_counts import TextCounter, count_tokens
from millrace.llm.url_rules import Rule, RuleTrie, join_rules, judge_urls, split_url
from tests.oracle import compare

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
COUNTER = TextCounter(PATH)


def lib_count(text):
    return len(LIB.encode(text or "", add_special_tokens=False).ids)


def test_counts_and_cache(spark, tmp_path):
    texts = [None, "", "a b  c", "it's <|endoftext|> x\n y", "z" * 100000, "a b  c", "a b  c"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(2, "a b  c", 1)], "doc_id bigint, text string, digest int")
    cache = f"file://{tmp_path}/cache"
    got = sorted(tuple(r) for r in count_tokens(df, PATH, cache, keep=["digest"]).collect())
    want = sorted((i, 1, len((t or "").encode()), lib_count(t)) for i, t in [*enumerate(texts), (2, "a b  c")])
    assert got == want
    stored = spark.read.parquet(f"{tmp_path}/cache")
    assert stored.count() == 4
    more = spark.createDataFrame([(1, "a b  c"), (2, "new text")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in count_tokens(more, PATH, cache).collect()) == [(1, 6, lib_count("a b  c")), (2, 8, lib_count("new text"))]
    assert spark.read.parquet(f"{tmp_path}/cache").count() == 5
    files = len(list((tmp_path / "cache").rglob("*.parquet")))
    assert sorted(tuple(r) for r in count_tokens(more, PATH, cache).collect())[1][2] == lib_count("new text")
    assert len(list((tmp_path / "cache").rglob("*.parquet"))) == files  # nothing was missing, so nothing was written
    assert count_tokens(df.limit(0), PATH).count() == 0


NUL_TEXTS = ["a \0b", "x \0b \0c", "a \0b b", "\0b", "\0b \0b", " \0", "b \0", "\0", "a b", "b a", " b", "  b", "b"]


def test_chunks_that_begin_with_nul():
    assert TextCounter(PATH).counts(NUL_TEXTS * 2) == [lib_count(t) for t in NUL_TEXTS * 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \0\n\té'ß1<|>") | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=6))
def test_counts_like_the_library(texts):
    assert COUNTER.counts(texts) == [lib_count(t) for t in texts]


def test_other_tokenizers():
    import sentencepiece

    texts = ["", "Hello <|endoftext|> world's\n\n x", "ünï  ß 12"]
    p = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(p)
    assert TextCounter(p).counts(texts) == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    p = public_tokenizers.path("piece_bpe_32k.model")
    assert TextCounter(p).counts(texts) == [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=p).encode(texts)]


def test_op1_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_token_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n = lib_count(texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


def check_shards(rows, shards, groups=None, few=False):
    """Law and slots; groups: the text of each row. few: little but heavy groups."""
    total, by, of = sum(r["size"] for r in rows), {}, {}
    for k, r in enumerate(rows):
        by.setdefault(r["shard"], []).append(r)
        of.setdefault(groups[k] if groups else r["text_crc32"], []).append(r)
    largest = max((r["size"] for r in rows), default=0)
    if few:
        largest = max([largest, *(s for g in of.values() if (s := sum(r["size"] for r in g)) <= total // shards)])
    for s in range(shards):
        mine = by.get(s, [])
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / shards) <= largest + 2 * 0.002 * total / shards + 2
    for g in of.values():
        if sum(r["size"] for r in g) <= total // shards:
            assert len({r["shard"] for r in g}) == 1, "a group that fits a shard is split"


def test_shards(spark):
    rnd = random.Random(3)
    texts = ["same"] * 700 + [None, ""] + ["w" * rnd.randint(1, 3000) for _ in range(1300)] + ["v" * 900] * 2000 + ["u" * 50] * 900
    df = spark.createDataFrame([(i % 1900, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, shard string").repartition(7)
    got = shard_by_bytes(df, 8).collect()
    assert len(got) == len(texts) and "text" in got[0].asDict()
    check_shards(got, 8, [r["text"] or "" for r in got])
    for r in got:
        t = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t) + OVERHEAD, zlib.crc32(t), "bytes", None)
    assert len({r["shard"] for r in got if r["text"] == "v" * 900}) >= 3  # larger than a shard
    assert shard_by_bytes(df.limit(0), 8).count() == 0


def test_shards_of_repeated_rows_and_fine_cuts(spark, monkeypatch):
    import millrace.llm.sharding as m

    df = spark.createDataFrame([(1, "t")] * 1000 + [(2, "u" * 50)] * 10, "doc_id bigint, text string")
    check_shards(shard_by_bytes(df, 5).collect(), 5, few=True)
    monkeypatch.setattr(m, "TASK_ROWS", 20)
    got = shard_by_bytes(df, 5, keep=[]).collect()
    assert len(got) == 1010
    check_shards(got, 5, few=True)
    assert len(shard_by_bytes(df.limit(2), 40).collect()) == 2


def test_many_small_rows_stay_within_the_tolerance(spark):
    df = spark.range(60_000).selectExpr("id AS doc_id", "repeat('ab', CAST(id % 90 AS INT)) || CAST(id DIV 3 AS STRING) AS text")
    got = shard_by_bytes(df, 10, keep=[]).collect()
    check_shards(got, 10)


def test_probing_that_does_not_settle_is_an_error(spark, monkeypatch):
    import millrace.llm.sharding as m

    monkeypatch.setattr(m, "MAX_ROUNDS", 0)
    with pytest.raises(RuntimeError, match="tolerance"):
        shard_by_bytes(spark.range(50_000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text"), 3)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_op2_whole_table(spark, sf):
    got = QUERIES["op2_histogram_sharding"](spark, f"/root/testdata/{sf}").collect()
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in docs.items()}
    check_shards(got, 40, [docs[r["doc_id"]] for r in got], few=sf == "sf0.001")


RULES = [Rule.parse(t, v) for t, v in [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "block"), ("example.net/de/8", "block"), ("a.example.net/", "allow"), ("org/", "allow"), ("org/", "block"), ("org/x/y", "allow")]]
URLS = [None, "", "no scheme", "http://", "https://COM/en/x", "http://b.example.com/en/77?q", "http://notexample.com/en/7", "http://xcom/en/1", "http://example.net/de/8", "http://a.example.net/de/8", "http://example.net/de/", "http://example.net/de", "http://o.org", "http://o.org/x/yz", "http://o.org/x/Y", "http://x.com?/en/", "http://x.com#/en/", "http://u:p@x.com:80/en/", "a://b://com/en/", "http://.com/en//", "http://x.com/en/%20#f?"]


def brute(url):
    h, p = split_url(url)
    fits = [r for r in RULES if h and (h == r.host or h.endswith("." + r.host)) and p.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host), len(r.path), r.verdict == "block"), default=None)
    return h, p, best and best.text, best.verdict if best else "allow"


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, 5) for i, u in enumerate(URLS)], "page_id bigint, url string, rule int")
    want = {i: brute(u) for i, u in enumerate(URLS)}
    assert {r["page_id"]: tuple(r)[1:] for r in judge_urls(df, RULES).collect()} == want
    table = spark.createDataFrame([(r.host, r.path, r.verdict) for r in RULES], "host string, path string, verdict string")
    assert {r["page_id"]: tuple(r)[1:] for r in join_rules(df, table).collect()} == want
    assert judge_urls(df.limit(0), RULES).count() == 0 and len(judge_urls(df.union(df), RULES, keep=["url"]).collect()) == 2 * len(URLS)
    with pytest.raises(ValueError):
        RuleTrie([Rule("h", "/" + "x" * 200, "block")] * 90_000)


def test_op4_oracle(spark):
    compare(QUERIES["op4_url_filters"](spark, "/root/testdata/sf0.01"), ORACLES["op4_url_filters"], "/root/testdata/sf0.01")


def test_url_rules_with_odd_ids_and_long_urls(spark):
    long = "http://" + "a." * 20_000 + "com/en/" + "x/" * 50_000
    rows = [(1, "http://x.com/en/1"), (1, "http://fine.com/"), (None, "http://x.com/en/1"), (None, None), (2, long)]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    table = spark.createDataFrame([(r.host, r.path, r.verdict) for r in RULES], "host string, path string, verdict string")
    want = sorted((i or 0, *brute(u)) for i, u in rows)
    for out in (judge_urls(df, RULES), join_rules(df.where("page_id IS NULL OR page_id < 2"), table)):
        got = sorted((r[0] or 0, *r[1:]) for r in out.collect())
        assert got == [w for w in want if len(got) == 5 or w[0] < 2]


def by_contract(url):
    """Host, path, rule and verdict of a url by the contract's words, byte by byte."""
    if url is None or b"://" not in url:
        return b"", b"", None, "allow"
    rest = url[url.index(b"://") + 3 :]
    i = next((k for k, c in enumerate(rest) if c in b"/?#"), len(rest))
    j = next((k for k in range(i, len(rest)) if rest[k] in b"?#"), len(rest))
    host, path = bytes(c + 32 if 65 <= c <= 90 else c for c in rest[:i]), rest[i:j]
    split = [(t.encode().partition(b"/"), t, v) for t, v in URL_RULES]
    fits = [(t, v) for (h, _, p), t, v in split if (host == h or host.endswith(b"." + h)) and path.startswith(b"/" + p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, "allow"))


def test_op4_by_its_contract_on_odd_urls(spark, tmp_path):
    rnd = random.Random(9)
    parts = [t.encode() for t in "://|/|?|#|com|net|org|example|.|en|de|es|7|8|EXAMPLE|Com|\0|\n|é|İ|K|@|:80|\\| |%2F|http|//|/en/|/de/8|/en/7|/es/|example.com|example.net".split("|")] + [b"\xff", b"\xc3", b"\xed\xa0\x80"]
    urls = [None, b""] + [rnd.choice([b"", b"http://a.", b"http://A.com/en/", b"x://b.Example.com/en/7", b"http://\xffb.net/de/", b"http://example.net/de/8", b"http://org/es"]) + b"".join(rnd.choices(parts, k=rnd.randint(1, 9))) for _ in range(6000)]
    rows = [(rnd.choice([None, k // 2]), u) for k, u in enumerate(urls)]
    df = spark.createDataFrame([(i, u if u is None else bytearray(u)) for i, u in rows], "page_id bigint, url binary")
    df.select("page_id", F.col("url").cast("string"), F.lit("x").alias("html")).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op4_url_filters"](spark, str(tmp_path)).select("page_id", F.col("host").cast("binary"), F.col("path").cast("binary"), "rule", "verdict").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted([(i, *by_contract(u)) for i, u in rows], key=key)
    assert sorted([(r[0], bytes(r[1]), bytes(r[2]), r[3], r[4]) for r in got], key=key) == want
    assert 200 < sum(w[3] is not None for w in want)
