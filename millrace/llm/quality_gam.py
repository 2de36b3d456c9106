"""Operator 5, a quality classifier: generalised additive model with pairwise interactions.

Texts are described by shares and counts that don't depend on the language. Each
feature is cut into quantile bins. Cyclic boosting visits one feature after the
other, fits a shallow tree on the bins' gradient sums and adds a small step to
that feature's lookup table; then the pairs of features whose interaction explains
most of the rest get tables of their own. A score is the sum of one table entry
per feature and pair, through the logistic function: binning and additions over
whole batches.

Labels come from at most MAX_TRAIN rows (those with the least hash of their id, a
bound that the caller can set), all others are scored only. Ids, languages,
sources and labels are never inputs of a score.

Nulls are empty texts; those have a score too. Very long texts are counted whole.
Repeated labels of a document are averaged; repeated rows and equal texts get equal
scores; rows without an id are scored, never trained on. Ties: a score at the
threshold is accepted, and equal gains split at the first place. Without labels
every score is the prior of 0.5. Empty tables give empty results; other columns
don't matter, and one named score is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import slices

MAX_TRAIN, BINS, PAIR_BINS, PAIRS, ROUNDS, RATE, LEAVES, THRESHOLD = 20_000, 48, 12, 6, 150, 0.08, 4, 0.3
FEATURES = [
    "log_words", "log_chars", "mean_word", "distinct_share", "top_share", "repeat_share", "upper_share", "digit_share", "stop_share",
    "bang_share", "symbol_share", "bar_share", "log_lines", "mean_line", "distinct_lines", "title_share", "wide_share",
]
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOPS = [ord(c) for c in ".,;:?'\"-()"]


def features(text: str) -> list[float]:
    """FEATURES of one whole text."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    words, lines = text.split(), text.split("\n")
    n, chars = len(words), max(1, len(text))
    letters = max(1, int(raw[65:91].sum() + raw[97:123].sum() + raw[192:].sum()))
    seen = Counter(words)
    many = max(1, n)
    return [
        np.log1p(n),
        np.log1p(len(text)),
        sum(map(len, words)) / many,
        len(seen) / many,
        max(seen.values(), default=0) / many,
        sum(map(eq, words, words[1:])) / many,
        raw[65:91].sum() / letters,
        raw[48:58].sum() / chars,
        raw[_STOPS].sum() / many,
        raw[33] / many,
        (raw[_PUNCT].sum() - raw[_STOPS].sum() - raw[33]) / many,
        raw[124] / many,
        np.log1p(len(lines)),
        n / len(lines),
        len(set(lines)) / len(lines),
        sum(map(str.istitle, words)) / many,
        raw[128:].sum() / chars,
    ]


@dataclass
class Model:
    """Bin edges and lookup tables; pairs use coarser edges."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for k, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, k])]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[np.searchsorted(self.coarse[i], x[:, i]) * PAIR_BINS + np.searchsorted(self.coarse[j], x[:, j])]
        return 1 / (1 + np.exp(-z))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins))


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES, ridge: float = 1.0) -> np.ndarray:
    """Leaf values per bin of a tree on ordered bins, split greedily where the loss falls most."""
    cuts, n = [0, len(g)], len(g)
    sg, sh = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]
    gain_of = lambda a, b: (sg[b] - sg[a]) ** 2 / (sh[b] - sh[a] + ridge)
    for _ in range(leaves - 1):
        best = (1e-9, 0)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                m = np.arange(a + 1, b)
                gain = gain_of(a, m) + gain_of(m, b) - gain_of(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(m[k])))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(n)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (sg[b] - sg[a]) / (sh[b] - sh[a] + ridge)
    return out


def _grid_step(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """One cut on either axis of a grid: four leaves."""
    g, h = g.reshape(PAIR_BINS, PAIR_BINS), h.reshape(PAIR_BINS, PAIR_BINS)
    sg, sh = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h))
    inner, last = slice(1, -1), slice(-1, None)

    def quads(s: np.ndarray) -> tuple[np.ndarray, ...]:
        a, b, c, d = s[inner, inner], s[inner, last], s[last, inner], s[last, last]
        return a, b - a, c - a, d - b - c + a

    gain = sum(a**2 / (b + ridge) for a, b in zip(quads(sg), quads(sh), strict=True))
    a, b = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, a + 1), slice(a + 1, None)):
        for cols in (slice(0, b + 1), slice(b + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
    return out.ravel()


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Cyclic boosting of the logistic loss on a bounded sample."""
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    none = [np.empty(0)] * k
    if not len(y) or y.min() == y.max():
        mean = (y.sum() + 0.5) / (len(y) + 1)
        return Model(float(np.log(mean / (1 - mean))), none, [np.zeros(1)] * k, none, [], [])
    base = float(np.log(y.mean() / (1 - y.mean())))
    edges, coarse = [_edges(x[:, i], BINS) for i in range(k)], [_edges(x[:, i], PAIR_BINS) for i in range(k)]
    bins = [np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]
    tables, z = [np.zeros(len(e) + 1) for e in edges], np.full(len(y), base)

    def sums(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n)

    for _ in range(rounds):
        for i in range(k):
            step = RATE * shallow_tree(*sums(bins[i], len(tables[i])))
            tables[i] += step
            z += step[bins[i]]
    grid = [np.searchsorted(c, x[:, i]) for i, c in enumerate(coarse)]
    gains = []
    for i in range(k):
        for j in range(i):
            g, h = sums(grid[i] * PAIR_BINS + grid[j], PAIR_BINS**2)
            gains.append((float((_grid_step(g, h) * g).sum()), i, j))
    pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros(PAIR_BINS**2) for _ in pairs]
    for _ in range(rounds // 3):
        for (i, j), t in zip(pairs, pair_tables, strict=True):
            at = grid[i] * PAIR_BINS + grid[j]
            step = RATE * _grid_step(*sums(at, PAIR_BINS**2))
            t += step
            z += step[at]
    return Model(base, edges, tables, coarse, pairs, pair_tables)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def feature_rows(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    kept = docs.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["_x array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            x = [features(t or "") for t in b.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(kept))], pa.array(x, pa.list_(pa.float64()))], [*kept.names, "_x"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MAX_TRAIN) -> Model:
    """A model from at most `most` labelled rows outside the held-out fold; the driver gets their features only."""
    wanted = labels.where((fold(id_col) != 0) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_y"))
    sample = wanted.orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).join(F.broadcast(sample), F.col("_i") == F.col("_id"))  # at most `most` ids
    rows = feature_rows(texts, "_t", ["_i", "_y"]).orderBy("_i").toArrow()
    x = np.array(rows.column("_x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, np.asarray(rows.column("_y").to_pylist(), float))


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] = ("doc_id",), least: float | None = None) -> DataFrame:
    """keep and score per row; with least, only rows that reach it. One narrow pass over whole texts."""
    shared, kept = docs.sparkSession.sparkContext.broadcast(model), docs.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            score = shared.value.score(np.array([features(t or "") for t in b.column(len(kept)).to_pylist()], float))
            out = pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(kept))], pa.array(score)], [*kept.names, "score"])
            yield out if least is None else out.filter(pa.array(score >= least))

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every row."""
    out = scored(docs, train(docs, labels, id_col, text_col), text_col, [id_col])
    return out.select(id_col, (fold(id_col) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the classifier doesn't reject, with their columns."""
    names = [c for c in docs.columns if c != "score"]
    return scored(docs.select(*names), train(docs, labels, id_col, text_col), text_col, names, THRESHOLD).select(*names)
