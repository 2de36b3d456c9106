"""Operator 6, approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots, a bounded sample of the
vectors. It is posted, with the pivot's rank, in the inverted files of its POSTED
nearest pivots; a query reads the files of its READ nearest ones only. The footrule
distance between the two orders (a pivot that isn't posted counts as the first rank
beyond) is summed up from these postings, and the best are reranked by exact
distance in double precision.

Equal vectors are one entry of the index that lists its k + 1 smallest ids, which
is all that a result of k can need: one very frequent vector costs one entry.
Entries are dealt into blocks by hash; every block holds its inverted files, and
the stated query set passes all blocks in chunks, so nothing is sent to a task but
one block and a stream of queries.

Vectors that are null, zero, or hold a null or non-finite component take no part,
as queries or candidates. Vectors of several lengths are apart: a query finds those
of its own length; a length too rare to have pivots in the sample is searched
without files. Repeated rows of one id count once, by the least vector. Ties go to
smaller ids. Null ids take no part. Empty tables give empty results; other columns
don't matter. Very long vectors only make blocks larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import stored

#: Pivots (a sample of this many distinct vectors, but one in PIVOT_SHARE at most, and FEW at least); files a vector is posted in and files a query reads; share of a block's entries that is reranked.
PIVOTS, PIVOT_SHARE, FEW, POSTED, READ, SHARE = 2048, 2, 32, 64, 14, 0.3
#: Rows per block: as many as keep 64 blocks busy, within these limits.
LEAST_BLOCK, MOST_BLOCK, CHUNK = 4096, 1 << 20, 256


def nearest_pivots(pivots: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row of x, nearest first."""
    d = (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T
    most = min(most, len(pivots))
    near = np.argpartition(d, most - 1, 1)[:, :most]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), 1, kind="stable"), 1)


class Block:
    """The entries of a block with the inverted files of the pivots; without pivots, every entry is a candidate.

    share of the entries is reranked, at least so many that a result can be full; None: all.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray | None, share: float | None = SHARE):
        self.ids, self.x, self.touched, self.share = ids, x, 0, share
        self.pivots = pivots = None if share is None else pivots
        if pivots is None:
            return
        near = np.concatenate([nearest_pivots(pivots, x[lo : lo + 4096], POSTED) for lo in range(0, len(x), 4096)])
        at = np.argsort(near.ravel(), kind="stable")
        self.posted = near.shape[1]
        self.entries, self.ranks = at // self.posted, (at % self.posted).astype(np.int16)
        self.ends = np.searchsorted(near.ravel()[at], np.arange(len(pivots) + 1))

    def candidates(self, files: np.ndarray, k: int) -> np.ndarray:
        """Entries posted in the files, or the best of them by footrule; entries in none of the files make up for too few."""
        parts = [slice(self.ends[p], self.ends[p + 1]) for p in files.tolist()]
        closer = [(self.posted - r) - np.abs(self.ranks[s] - r) for r, s in enumerate(parts)]  # than an entry without the pivot
        score = np.bincount(np.concatenate([self.entries[s] for s in parts]), np.concatenate(closer), len(self.ids))
        found = np.flatnonzero(score)
        self.touched += len(found)
        most = max(k, int(self.share * len(self.ids)))
        if len(found) < min(k, len(self.ids)):
            return np.arange(len(self.ids))
        if len(found) > most:  # all that tie with the last one are reranked too
            s = score[found]
            found = found[s >= np.partition(s, len(s) - most)[len(s) - most]]
        return found

    def search(self, q: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and exact distances of the k best entries found for each row of q."""
        whole = self.pivots is None
        files = None if whole else nearest_pivots(self.pivots, q, READ)
        for i in range(len(q)):
            found = slice(None) if whole else self.candidates(files[i], k)
            d = np.sqrt(((self.x[found] - q[i]) ** 2).sum(1))
            ids = self.ids[found]
            best = np.lexsort((ids, d))[:k]
            yield ids[best], d[best]


def _matrix(column: pa.Array) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


def entries(df: DataFrame, id_col: str, vec_col: str, k: int, is_query) -> DataFrame:
    """(rep, vec, members, asks): distinct valid vectors as bytes, their k + 1 smallest ids, and whether a query is among all of their ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, vecs = [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if v and None not in v:
                    x = np.array(v, np.float64) + 0.0  # -0 and 0 are equal
                    if np.isfinite(x).all() and x.any():
                        ids.append(i), vecs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())], ["id", "vec"])

    source = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"))
    rows = source.mapInArrow(pack, "id bigint, vec binary").groupBy("id").agg(F.min("vec").alias("vec"))
    return stored(rows.withColumn("asks", is_query(F.col("id"))), "vectors")


def nearest(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", share: float | None = SHARE) -> DataFrame:
    """query_id, rank, id and score: the k nearest others found for every id for which is_query(column) holds.

    share is the part of a block's entries that is reranked at most; None reranks all of
    them, which is exact.
    """
    spark = df.sparkSession
    rows = entries(df, id_col, vec_col, k, is_query)
    key = F.sha2("vec", 256)
    smallest = rows.select("id", "vec", key.alias("key")).withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("n") <= k + 1)
    grouped = smallest.groupBy("key").agg(F.min("id").alias("rep"), F.min("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("members"))
    asked = rows.where("asks").select(F.col("id").alias("query_id"), key.alias("key"))
    index = stored(grouped.join(asked.select("key").distinct().withColumn("q", F.lit(True)), "key", "left").withColumn("asks", F.col("q").isNotNull()).drop("q"), "index-entries")

    n = index.count()
    blocks = max(-(-n // MOST_BLOCK), min(64, -(-n // LEAST_BLOCK)), 1)
    sample: dict[int, list[np.ndarray]] = {}
    for r in index.orderBy(F.xxhash64("key"), "key").limit(min(PIVOTS, max(FEW, n // PIVOT_SHARE))).select("vec").collect():
        sample.setdefault(len(r["vec"]), []).append(np.frombuffer(r["vec"], "<f8"))
    shared = spark.sparkContext.broadcast({size: np.array(v) for size, v in sample.items() if len(v) >= FEW})

    entry = index.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"), F.octet_length("vec").alias("size"), F.lit(0).alias("kind"), "rep", "vec")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    ask = index.where("asks").select(everywhere, F.octet_length("vec").alias("size"), F.lit(1).alias("kind"), "rep", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None  # number and size, parts and index of the current block
        for b in batches:
            number, size, kind = (b.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (size[1:] != size[:-1]) | (kind[1:] != kind[:-1])]) if len(number) else []
            for lo, hi in zip(cuts, [*cuts[1:], b.num_rows], strict=True):
                if (number[lo], size[lo]) != at:
                    at, held, block = (number[lo], size[lo]), [], None
                ids, vecs = b.column(3)[lo:hi].to_numpy(), b.column(4)[lo:hi]
                if kind[lo] == 0:
                    held.append((ids, _matrix(vecs)))
                    continue
                if block is None and held:
                    block, held = Block(*(np.concatenate(p) for p in zip(*held, strict=True)), shared.value.get(int(size[lo])), share), []
                if block is None:
                    continue
                x = _matrix(vecs)
                for c in range(0, len(ids), CHUNK):
                    found = list(block.search(x[c : c + CHUNK], k + 1))
                    counts = [len(f[0]) for f in found]
                    arrays = [np.repeat(ids[c : c + CHUNK], counts), *(np.concatenate(p) for p in zip(*found, strict=True))]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["asked", "rep", "score"])

    dealt = entry.union(ask).repartition(blocks, "block").sortWithinPartitions("block", "size", "kind")
    local = dealt.mapInArrow(run, "asked bigint, rep bigint, score double")

    def first(d: DataFrame, by: str, who: str, most: int) -> DataFrame:
        w = Window.partitionBy(by).orderBy("score", who)
        return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)

    best = first(local, "asked", "rep", k + 1).drop("rank").join(index.select("rep", "members"), "rep")
    ids = first(best.select("asked", F.explode("members").alias(id_col), "score"), "asked", id_col, k + 1).drop("rank")
    queries = asked.join(index.select("key", F.col("rep").alias("asked")), "key").select("query_id", "asked")
    others = queries.join(ids, "asked").where(F.col("query_id") != F.col(id_col))
    return first(others, "query_id", id_col, k).select("query_id", F.col("rank").cast("int").alias("rank"), id_col, "score")
