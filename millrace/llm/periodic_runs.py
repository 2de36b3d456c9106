"""Operator 12, periodic runs of words: Kolpakov and Kucherov's algorithm.

A run is a stretch of words with smallest period q that repeats at least a given number
of times (exponent) and can't be extended. Each stretch that may hold runs is cut into
the factors of its LZ factorisation, found by a suffix automaton; Main's algorithm
finds the runs that touch or cross the beginning of a factor, from the longest common
extensions around it; the runs that lie inside a factor are copied from the factor's
earlier occurrence. All of it is linear in the stretch but for the runs themselves.

Every window of MIN_LENGTH * (e - 2) / e + 1 words (nine) inside a run of exponent e
comes again at most a third of the run away, so words between windows that don't are
in no run; only what is left between them, the stretches, goes through the algorithm.
Hashes of windows decide here: a false match only makes a stretch longer.

One narrow pass, no shuffle. Memory goes with the longest text: about 60 bytes a word,
and 500 a word of the longest stretch (the automaton).

Nulls: a null text has no words; the hash of a null id is that of the empty text. Empty
texts have no run and collapse to the empty text. Very long texts are read whole. Ties:
the smallest start, then the smallest period. Repeated rows give repeated results,
empty tables empty ones. Columns of docs beyond the id and the text don't matter.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import slices

MIN_LENGTH, MIN_EXPONENT = 24, 3
_ODD = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen = dict.fromkeys(words)
    for i, w in enumerate(seen):
        seen[w] = i
    return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))


def stretches(x: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[tuple[int, int]]:
    """Disjoint parts of x outside of which no run can lie."""
    k, n = min_length * (exponent - 2) // exponent + 1, len(x)
    if n < max(min_length, 2, k):
        return []
    m = n - k + 1
    with np.errstate(over="ignore"):
        h = np.zeros(m, np.uint64)
        for i in range(k):
            h = (h + x[i : i + m].astype(np.uint64) + np.uint64(1)) * _ODD
            h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same, gap = h[order[1:]] == h[order[:-1]], np.diff(order)
    near = np.full(m, n + 1, np.int64)  # from each window to the nearest equal one
    near[order[1:][same]] = gap[same]
    before = order[:-1][same]
    near[before] = np.minimum(near[before], gap[same])
    good = near <= n // exponent
    while good.any():
        edge = np.flatnonzero(np.diff(np.r_[False, good, False]))
        begin, end = edge[::2], edge[1::2]
        size = end - begin + k - 1
        allowed = np.where(size >= min_length, size // exponent, 0)
        left = good.copy()
        left[good] = near[good] <= np.repeat(allowed, end - begin)
        if (left == good).all():
            return list(zip(begin.tolist(), (end + k - 1).tolist(), strict=True))
        good = left
    return []


def automaton(x: list[int]) -> tuple[list[dict[int, int]], list[int]]:
    """The suffix automaton of x: transitions, and where the first occurrence of each state's words ends."""
    to: list[dict[int, int]] = [{}]
    link, length, first, last = [-1], [0], [-1], 0
    for i, c in enumerate(x):
        cur = len(to)
        to.append({})
        link.append(0)
        length.append(i + 1)
        first.append(i)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] != length[p] + 1:
                twin = len(to)
                to.append(to[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                first.append(first[q])
                link[q] = twin
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = twin
                    p = link[p]
                q = twin
            link[cur] = q
        last = cur
    return to, first


def factors(x: list[int]) -> list[tuple[int, int, int]]:
    """The LZ factorisation: (begin, end, begin of an earlier occurrence, which may overlap; -1 for a new word)."""
    to, first = automaton(x)
    out, b, n = [], 0, len(x)
    while b < n:
        state, j, source = 0, 0, -1
        while b + j < n:
            state = to[state][x[b + j]]
            if first[state] - j >= b:
                break
            source = first[state] - j
            j += 1
        j = max(j, 1)
        out.append((b, b + j, source))
        b += j
    return out


def z_values(s: list[int]) -> list[int]:
    """For each place of s, how far it goes on like the beginning of s."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def crossing(x: list[int], a: int, b: int, e: int, min_length: int, exponent: int) -> Iterator[Run]:
    """Runs that cross or touch b and end in the factor [b, e); [a, b) is the factor before. Periods ascend.

    Such a run begins less than a period before a, as the earlier factor would else go on
    beyond b; so windows around b hold it and one word on either side.
    """
    most = (e - a) // (exponent - 1)
    if e - a + most < min_length:
        return
    low, high = max(0, a - most - 1), min(len(x), e + 1)
    u, v = x[low:b], x[b:high]
    m, r = len(u), len(v)
    ahead = z_values([*v, -1, *u, *v])
    back = z_values([*u[::-1], -1, *v[::-1], *u[::-1]])
    for p in range(1, most + 1):
        for start, gone_on, gone_back in (
            (b, ahead[p] if p < r else 0, back[m + 1 + r - p] if p <= r else -1),  # b against b + p
            (b - p, ahead[r + 1 + m - p] if p <= m else -1, back[p] if p < m else 0),  # b - p against b
        ):
            if gone_on < 0 or gone_back < 0 or gone_on + gone_back + p < max(min_length, exponent * p):
                continue
            s, t = start - gone_back, start + p + gone_on
            if t <= e and (s > low or low == 0):  # else it belongs to another boundary
                yield s, t - s, p


def runs_of(x: list[int], min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[Run]:
    """All runs of x with length >= max(min_length, exponent * period), by start, then period."""
    found: dict[tuple[int, int], int] = {}  # (start, length): period
    ends: dict[int, list[int]] = {}
    starts: list[int] = []

    def add(s: int, size: int, p: int) -> None:
        if (s, size) not in found:
            found[s, size] = p
            if s not in ends:
                ends[s] = []
                insort(starts, s)
            ends[s].append(s + size)
        elif p < found[s, size]:
            found[s, size] = p

    a = 0
    for b, e, source in factors(x):
        if b:
            for run in crossing(x, a, b, e, min_length, exponent):
                add(*run)
        if source >= 0 and starts:
            i, shift = bisect_right(starts, source), b - source
            while i < len(starts) and starts[i] < e - shift:  # starts that are added on the way lie further on
                for t in [t for t in ends[starts[i]] if t < e - shift]:
                    add(starts[i] + shift, t - starts[i], found[starts[i], t - starts[i]])
                i += 1
        a = b
    if x:  # the runs that end with x
        for run in crossing(x, a, len(x), len(x), min_length, exponent):
            add(*run)
    return sorted(((s, size, p) for (s, size), p in found.items()), key=lambda r: (r[0], r[2]))


def find_runs(words: list[bytes], min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[Run]:
    """All runs of a text's words."""
    x = numbers(words)
    out = []
    for lo, hi in stretches(x, min_length, exponent):
        out += [(lo + s, size, p) for s, size, p in runs_of(x[lo:hi].tolist(), min_length, exponent)]
    return out


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest exponent, exactly; the first of equals."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without what a run repeats after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, size, p in runs:
        keep[s + p : s + size] = False
    return [words[i] for i in np.flatnonzero(keep)]


def planted(id_text: str, words: list[bytes]) -> list[bytes]:
    """The words that the query judges: a tenth of the documents, by the hash of their ids, end in a made run."""
    h, n = zlib.crc32(id_text.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


@dataclass(frozen=True)
class Runs:
    """Smallest length and exponent of a run."""

    min_length: int = MIN_LENGTH
    exponent: int = MIN_EXPONENT


def mark_runs(docs: DataFrame, limits: Runs = Runs(), id_col: str = "doc_id", text_col: str = "text", prepare: Callable[[str, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """id, n_words, runs (array of start, length, period; by start, then period), best (the run with the greatest exponent) and collapsed (the text without repeats).

    prepare changes the words of a text before they are judged; it gets the id as text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    named = lambda r: r and dict(zip(("start", "length", "period"), r, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_raw"):
            n_words, all_runs, best, collapsed = [], [], [], []
            for id_text, raw in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                words = (raw.as_py() or b"").split()
                if prepare:
                    words = prepare(id_text or "", words)
                found = find_runs(words, limits.min_length, limits.exponent)
                n_words.append(len(words))
                all_runs.append([named(r) for r in found])
                best.append(named(best_run(found)))
                collapsed.append(b" ".join(kept_words(words, found)))
            texts = pa.array(collapsed, pa.binary()).view(pa.string())  # as they came, checked by nobody
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(all_runs, pa.list_(run_type)), pa.array(best, run_type), texts], ["_id", "n_words", "runs", "best", "collapsed"])

    one = "struct<start: bigint, length: bigint, period: bigint>"
    read = docs.select(F.col(id_col).alias("_id"), F.col(id_col).cast("string").alias("_name"), F.col(text_col).cast("binary").alias("_raw"))
    out = read.mapInArrow(run, f"_id {kind}, n_words bigint, runs array<{one}>, best {one}, collapsed string")
    return out.withColumnRenamed("_id", id_col)


def run_digests(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query's columns: counts, the best run, digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return marked.select(
        id_col,
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
