import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import periodic_runs as m
from millrace.llm.periodic_runs import best_run, factors, find_runs, mark_runs, planted, run_digests, runs_of, stretches


def brute(x, min_length, exponent):
    """Every period's maximal stretches, the smallest period of each."""
    x, out = np.asarray(x), {}
    for q in range(1, len(x) // exponent + 1):
        edge = np.flatnonzero(np.diff(np.r_[False, x[q:] == x[:-q], False]))
        for s, t in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if t - s + q >= max(min_length, exponent * q):
                out.setdefault((s, t - s + q), q)
    return sorted(((s, size, q) for (s, size), q in out.items()), key=lambda r: (r[0], r[2]))


def samples(n, seed):
    rnd = random.Random(seed)
    for _ in range(n):
        k, x = rnd.choice([1, 2, 2, 3, 5]), []
        if rnd.random() < 0.4:
            x = [rnd.randrange(k) for _ in range(rnd.randint(0, 70))]
        while rnd.random() < 0.85:
            x += [rnd.randrange(k) for _ in range(rnd.randint(1, 9))] * rnd.randint(1, 6) + [9] * rnd.randint(0, 1)
        yield x + x[: rnd.randint(0, len(x))]


@pytest.mark.parametrize("min_length,exponent", [(1, 2), (1, 3), (7, 3), (24, 3), (12, 2), (1, 4)])
def test_all_runs_by_brute_force(min_length, exponent):
    for x in samples(300, min_length):
        want = brute(x, min_length, exponent)
        assert runs_of(x, min_length, exponent) == want, x
        assert find_runs([b"%d" % c for c in x], min_length, exponent) == want, x


def test_fibonacci_word_has_its_known_cubes():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    assert runs_of(b, 1, 3) == brute(b, 1, 3) and len(runs_of(b, 1, 2)) == len(brute(b, 1, 2))


def test_factors_are_earlier_and_longest():
    for x in samples(80, 3):
        at = 0
        for b, e, source in factors(x):
            assert b == at and e > b
            longest = max((j for j in range(len(x) - b + 1) if any(x[i : i + j] == x[b : b + j] for i in range(b))), default=0) if b else 0
            assert e - b == max(1, longest) and (source < 0 if not longest else x[source : source + e - b] == x[b:e] and source < b)
            at = e
        assert at == len(x)


def test_stretches_leave_prose_alone_and_keep_runs():
    rnd = random.Random(1)
    prose = [b"%d" % rnd.randrange(40) for _ in range(5000)]
    assert stretches(m.numbers(prose)) == []
    line = prose[:15]  # a line that comes again every hundred words is in no run
    apart = [w for i in range(30) for w in [*line, *prose[100 + 100 * i : 200 + 100 * i]]]
    assert stretches(m.numbers(apart)) == [] and find_runs(apart) == []
    x = prose[:300] + prose[:11] * 4 + prose[300:400]
    assert find_runs(x) == brute(m.numbers(x), 24, 3) != []


def test_best_and_ties():
    assert best_run([(0, 24, 8), (40, 27, 9), (80, 31, 10)]) == (80, 31, 10)
    assert best_run([(5, 30, 10), (2, 30, 10)]) == (5, 30, 10) and best_run([]) is None


def expected(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute([ids[w] for w in words], 24, 3)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_like_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(0, 300)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, "a b " * 40), (203, "ab ab " * 30), (203, "ab ab " * 30), (204, "x y z\x0b" * 9), (205, ("one two three " * 5 + "four ") * 9), (206, "na " * 30_000), (207, "q" * 100_000)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id bigint, text string, runs string, n_runs int").repartition(3)
    got = sorted(map(tuple, run_digests(mark_runs(docs, prepare=planted)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in rows), key=str)
    assert mark_runs(docs.limit(0)).count() == 0
    # without preparation the texts are judged as they are
    plain = {r["doc_id"]: r for r in mark_runs(docs.where("doc_id IN (204, 206)")).collect()}
    assert plain[206]["collapsed"] == "na" and plain[204]["collapsed"] == "x y z" and tuple(plain[204]["best"]) == (0, 27, 3)
