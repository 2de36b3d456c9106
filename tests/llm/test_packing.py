import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.packing import WordIds, pack, pack_documents, place, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def slow_place(lengths, capacity):
    """Every possible place is tried and the whole sum of squares counted."""
    bins, out = [], []  # fill of each sequence
    total = lambda: sum(n * n for n in np.unique([capacity - f for f in bins if f < capacity], return_counts=True)[1].tolist())
    for s in lengths:
        options = []
        for k, f in enumerate(bins):
            if f + s <= capacity and f < capacity:
                bins[k] += s
                options.append((total(), 0, capacity - f, -k, k))
                bins[k] -= s
        bins.append(s)
        options.append((total(), 1, 0, 0, len(bins) - 1))
        bins.pop()
        best = min(options)
        k = best[-1]
        out.append((best[0], bins[k] if k < len(bins) else 0))
        if k == len(bins):
            bins.append(s)
        else:
            bins[k] += s
    return out, bins


def test_places_by_brute_force():
    rnd = random.Random(2)
    for _ in range(60):
        capacity = rnd.choice([5, 12, 40])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 60))]
        where, offset = place(np.array(lengths, np.int64), capacity)
        want, bins = slow_place(lengths, capacity)
        fill = {}
        for s, w, o, (squares, at) in zip(lengths, where.tolist(), offset.tolist(), want, strict=True):
            assert o == fill.get(w, 0) == at
            fill[w] = o + s
            gaps = np.unique([capacity - f for f in fill.values() if f < capacity], return_counts=True)[1]
            assert squares == (gaps**2).sum()
        assert sorted(fill.values()) == sorted(bins)


def check(rows, texts, capacity):
    """The pieces of each text, in order, and sequences without gaps or overlaps."""
    tokenizer = Tokenizer.from_file(PATH)
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str)
    want = []
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    assert got == sorted(want, key=str)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), -(-sum(r["length"] for r in rows) // capacity)


ODD = ["a.b ..c, D.,", "It's We'LL <|endoftext|> <|EndOfText|>x", "é é ́x", " a b\x85c\x1cd", "Σİﬁ ٣中 12", "\x00 \U0001f600. ,.", " . ", ".", "X, y.", "﻿​", "<|startoftext|>a. B"]


def test_pack_documents(spark):
    rnd = random.Random(3)
    texts = [(i, " ".join(rnd.choice(["Tree", "water,", "Is", "x9", "über", "end."]) for _ in range(rnd.randint(0, 90)))) for i in range(700)]
    texts += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (2001, ""), (None, "no id"), (None, "no id"), (5, "again"), (2002, "long word. " * 200_000), (2003, "z" * 60_000)]
    docs = spark.createDataFrame([(i, t, 0, "clash") for i, t in texts], "doc_id bigint, text string, length int, _key string").repartition(3)
    used, least = check(pack_documents(docs, PATH, capacity=128, group=1 << 20).collect(), texts, 128)
    assert used <= 1.01 * least + 1
    rows = pack_documents(docs, PATH, capacity=128, group=64, with_ids=True)  # several groups and rounds
    used, least = check(rows.collect(), texts, 128)
    assert used <= 1.03 * least + 2
    whole = {r["sequence_id"]: r["ids"] for r in sequences(rows).collect()}
    assert len(whole) == used and max(map(len, whole.values())) <= 128 and all(i is not None for ids in whole.values() for i in ids)
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_rounds_join_what_groups_leave_open(spark):
    """Groups of few items each leave an open sequence; together these fill whole ones."""
    lengths = spark.range(40000).selectExpr("id AS _key", "CAST(7 + id % 13 AS bigint) AS length")
    rows = pack(lengths, 100, 200).collect()
    alone = place(np.sort(np.array([7 + k % 13 for k in range(40000)]))[::-1], 100)[0].max() + 1
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], 7 + r["_key"] % 13))
    assert len(rows) == 40000 and all(sum(n for _, n in v) <= 100 for v in held.values())
    assert all(sum(n for _, n in sorted(v)[:k]) == sorted(v)[k][0] for v in held.values() for k in range(len(v)))
    assert len(held) <= 1.01 * alone + 1


def test_words_like_whole_texts():
    rnd, table, tokenizer = random.Random(4), WordIds(PATH), Tokenizer.from_file(PATH)
    parts = ["a", "B", "é", "é", "́", " ", "\n", "\x85", " ", "'", "'s", "'LL", ".", ",", "..", "<|endoftext|>", "<|EndOfText|>", "<|", "|>", "1", "Σ", "İ", "ǅ", "\x1c", "\x00", "x.", "X,", "\U0001f600"]
    for _ in range(4000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(table.encode([t.encode()])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        WordIds(public_tokenizers.path("byte_bpe_50k.json"))
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        WordIds(str(tmp_path / "t.json"))
