import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm.bpe import Encoder, PairTree, Vocabulary, encode_documents, merge_long, merge_short

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
ENC = Encoder(Vocabulary(PATH))


def check(texts):
    want = [LIB.encode(t, add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(b, "<u4").tolist() for b in ENC.encode(texts)]
    for t, g, w in zip(texts, got, want):
        assert g == w, (t[:80], g[:10], w[:10])
        assert ENC.decode(np.array(g, "<u4").tobytes()) == LIB.decode(w, skip_special_tokens=False)


def test_hand_picked():
    check(["", " ", "a", "  a  b ", "it's I'll we'D\n\n x", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>", " x 　 y", "tab\t x\x1c y", "x" * 5000, "ab" * 3000 + " " + "é" * 999, "日本語 text 😀😀", "1234 56²½ Ⅷ", "a \nb", "!!! ??  !", " lead", "trail "])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'abetho.,!1é"), st.characters(codec="utf-8")), max_size=60))
def test_like_the_library(t):
    check([t])


def test_pieces_merge_alike_in_both_ways():
    rnd = random.Random(1)
    for width in (1, 2, 4, 16, 32):
        pieces = [bytes(rnd.choices(b"thean rio", k=rnd.randint(1, width + 1))) for _ in range(200)]
        assert [np.frombuffer(x, "<u4").tolist() for x in merge_short(ENC.v, pieces, width)] == [merge_long(ENC.v, p) for p in pieces]


def test_tree_yields_leftmost_lowest():
    t = PairTree([5, 3, 3, 9])
    assert t.least() == (3, 1)
    t.put(1, 10)
    assert t.least() == (3, 2)


def test_small_table_gives_the_same_ids():
    e = Encoder(ENC.v, 3)
    texts = [f"word{i} other{i % 3} thing" for i in range(50)]
    assert [e.encode([t])[0] for t in texts] == ENC.encode(texts)


def test_documents(spark):
    rows = [(1, "a b", 7), (2, None, 8), (2, None, 8), (3, "", 9), (None, "x" * 200000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = encode_documents(df, PATH, with_ids=True).collect()
    assert len(got) == 5
    by = {r["doc_id"]: r for r in got}
    assert by[2]["n_tokens"] == by[3]["n_tokens"] == 0 and by[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[1]["ids"] == LIB.encode("a b").ids and by[None]["decoded"] == "x" * 200000
    assert encode_documents(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_whole_table_round_trip(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in encode_documents(docs, PATH).collect():
        ids = LIB.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()
