import random

import numpy as np
import pytest

from millrace.llm import order_minhash as m
from millrace.llm.components import connected
from millrace.llm.order_minhash import aligned, kmers, near_duplicates, sketch
from millrace.llm.packed import Bloom


def sketched(texts):
    """Word hashes' bins and tuples of texts, as sets."""
    import pyarrow as pa

    from millrace.llm.bytewords import words

    w = words(pa.array(texts))
    n = np.bincount(w.text, minlength=len(texts))
    bins, bands = m.word_bins(w.hashes, n), sketch(w.hashes, n)
    return bins, [set(np.frombuffer(x, "<u8").tolist()) for x in bands]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("wide", [1 << 14, 4, 1])
def test_alignment_like_dynamic_programming(monkeypatch, wide):
    monkeypatch.setattr(m, "WIDE", wide)
    rnd = random.Random(4)
    for _ in range(600):
        a = rnd.choices("abcdefgh", k=rnd.randint(0, 30))
        b = list(a)
        for _ in range(rnd.randint(0, 9)):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randint(0, 2)] = rnd.choices("abcdefgh", k=rnd.randint(0, 2))
        assert aligned(a, b) == (5 * lcs(a, b) >= 4 * max(len(a), len(b))) and m.matched(a, b) == lcs(a, b)


def test_order_matters_and_occurrences_count():
    w = [f"w{i}" for i in range(400)]
    _, (one, two, again) = sketched([" ".join(w), " ".join(w[200:] + w[:200]), " ".join(w).upper()])
    assert one == again and len(one & two) < 0.75 * len(one)
    assert len(set(kmers(np.array([1, 2, 3, 4, 5] * 3 + [1, 2, 3, 4, 5], np.uint64), np.array([15, 5]))[0].tolist())) == 11
    assert kmers(np.arange(7, dtype=np.uint64), np.array([0, 3, 4]))[1].tolist() == [0, 1, 1]


def test_strides_change_nothing(monkeypatch):
    texts = [" ".join(f"w{i % 700}" for i in range(n)) for n in (12, 13, 1000, 1004, 1005)]
    whole = sketched(texts)[1]
    monkeypatch.setattr(m, "STRIDE", 8)
    assert sketched(texts)[1] == whole


def corpus(rnd):
    vocab = [f"v{i}" for i in range(3000)]
    docs, passage = [], rnd.choices(vocab, k=60)
    for g in range(25):
        base = rnd.choices(vocab, k=rnd.choice([3, 8, 40, 150, 400]))
        for c in range(rnd.choice([1, 1, 2, 6, 40])):
            w = list(base)
            for _ in range(int(len(w) * 0.04 * (c > 0))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            docs.append(" ".join(w))
    docs += [" ".join(rnd.choices(vocab, k=70) + passage + rnd.choices(vocab, k=70)) for _ in range(40)]
    docs += [docs[0], docs[0].upper(), None, "", " \n", "one", "one", "x " * 30000, "x " * 29000]
    return docs


def classes(texts):
    words = [(t or "").lower().split() for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if words[i] == words[j] or words[i] and words[j] and len(words[i]) < 1000 and aligned(words[i], words[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [1024, 3])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK", block)
    texts = corpus(random.Random(9))
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id bigint, text string, kept string").repartition(6)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_duplicates(df).collect()}
    want = classes(texts)
    want[-1] = len(texts) - 2
    assert [got[i][0] for i in range(len(texts))] == want
    assert all(k == (c == i) for i, (c, k) in got.items())


def test_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "q"), (1, "other words here"), (7, "other words here")], "doc_id bigint, text string")
    got = near_duplicates(df).collect()
    assert len(got) == 5 and sum(r["kept"] for r in got) == 3 and len({r["class_no"] for r in got}) == 3
    assert [r["class_id"] for r in got if r["doc_id"] == 7] == [1]
    assert near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103)]
    got = {r["node"]: r["label"] for r in connected(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in (100, 103, 105)} == {100}


def test_bloom_has_no_misses(spark):
    keys = [(i * 7, i % 5) for i in range(5000)]
    b = Bloom.over(spark.createDataFrame(keys, "row bigint, line int"), len(keys))
    rows, lines = (np.array(x) for x in zip(*keys))
    assert b.has(rows, lines).all() and b.has(rows + 1, lines).mean() < 0.05


def test_planted_copies_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(texts)
    want = classes([texts[i] for i in ids])
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    assert [got[i] for i in ids] == [ids[c] for c in want]


def test_scattered_edits_are_decided_by_alignment(spark):
    """A word in ten replaced: the k-mers hardly resemble each other, the alignment matches 0.9."""
    rnd = random.Random(3)
    texts = []
    for _ in range(40):
        base = [f"u{rnd.randrange(10**6)}" for _ in range(300)]
        other = [f"e{rnd.randrange(10**6)}" if i % 10 == rnd.randrange(4, 6) else w for i, w in enumerate(base)]
        texts += [" ".join(base), " ".join(other)]
    _, bands = sketched(texts)
    want = [i - 1 if i % 2 and bands[i] & bands[i - 1] and aligned(texts[i].split(), texts[i - 1].split()) else i for i in range(len(texts))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == want and sum(c != i for i, c in enumerate(want)) > 25


def test_bins_never_count_less_than_alignments():
    rnd = random.Random(6)
    for _ in range(200):
        a, b = (rnd.choices("abcdefgh" * 3 + "z", k=rnd.choice([5, 40, 900])) for _ in "ab")
        x, y = sketched([" ".join(a), " ".join(b)])[0]
        assert m.in_common(x[None], y[None], np.array([lcs(a, b) if len(a) < 100 and len(b) < 100 else sum(min(a.count(c), b.count(c)) for c in set(a))]))[0]


@pytest.mark.parametrize(("share", "least"), [(0.95, 0.99), (0.9, 0.99), (0.85, 0.95), (0.8, 0.8)])
def test_recall_with_scattered_edits(spark, share, least):
    """Words at random places replaced, 300 words: the share of pairs aligned at the threshold or more that are linked."""
    rnd = random.Random(int(share * 100))
    texts = []
    for _ in range(60):
        base = [f"u{rnd.randrange(10**6)}" for _ in range(300)]
        other = list(base)
        for i in rnd.sample(range(300), round(300 * (1 - share))):
            other[i] = f"e{rnd.randrange(10**6)}"
        texts += [" ".join(base), " ".join(other)]
    pairs = [i for i in range(0, 120, 2) if aligned(texts[i].split(), texts[i + 1].split())]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    found = sum(got[i] == got[i + 1] for i in pairs)
    print(f"aligned at {share}: {found} of {len(pairs)}")
    assert len(pairs) == 60 and found >= least * 60


def test_regular_edits_meet():
    """Every tenth word replaced: a pair that aligns at 0.9 shares a tuple."""
    rnd, texts = random.Random(5), []
    for _ in range(60):
        base = [f"u{rnd.randrange(10**6)}" for _ in range(300)]
        texts += [" ".join(base), " ".join(f"e{rnd.randrange(10**6)}" if i % 10 == 0 else w for i, w in enumerate(base))]
    _, bands = sketched(texts)
    assert sum(bool(bands[i] & bands[i + 1]) for i in range(0, 120, 2)) >= 57
