"""Operator 2, sharding by histogram sort.

Rows are ordered by a 24-byte key: a hash of the text (equal texts are
neighbours), a hash of the id, and a row number that tells copies apart. Rounds of
probing count the exact bytes below candidate boundaries in every partition;
each round narrows the interval of every boundary by interpolation, until the
bytes below it are within tolerance of its target. Then one exchange moves the
rows, cut finer than the shards so that no task has to sort a whole shard; slots
follow from the counts of the tasks before.

Equal texts stay together. A group of more bytes than the tolerance, but no more
than a shard, is heavy: heavy groups (a bounded number, as their bytes are) are
dealt whole, largest first, each to the shard with most room, and the boundaries
between the other groups are chosen for the room that is left. Boundaries are
sought between texts' hashes; only a group larger than a shard, which no shard can
hold, is cut between its rows.

Law `bytes`: each shard's bytes differ from total / shards by at most twice the
tolerance (a share of a shard) plus the largest row, or, where there is little but
heavy groups, by no more than the largest of these (the bound of largest-first
dealing). Probing that doesn't settle is an error.

Nulls have no bytes of text; very long texts are one row each; empty tables give
empty results; repeated rows are told apart by the row number and each get a slot of
their own; null ids are hashed like others.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import stored, text_or_empty

OVERHEAD = 16
KEY_BITS = 192
GROUP_BITS = 128  # of a key, below the hash of its text
#: Candidate boundaries per open interval and round; rounds; rows per sorting task; most cuts (bounds what is broadcast: 24 bytes each).
PROBES, MAX_ROUNDS, TASK_ROWS, MAX_CUTS = 16, 80, 2_000_000, 1 << 13


def keyed(df: DataFrame, text_col: str, id_col: str, keep: list[str]) -> DataFrame:
    """Sizes and keys; stored once, so that row numbers never change afterwards."""
    text = text_or_empty(text_col)
    unsigned = lambda c: F.lpad(F.hex(c), 16, "0")
    out = df.select(
        *keep,
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_group"),
        F.unhex(F.concat(unsigned(F.xxhash64(text)), unsigned(F.xxhash64(F.col(id_col))), unsigned(F.monotonically_increasing_id()))).alias("_key"),
    )
    return stored(out, "shard-keys")


def _as_bytes(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(KEY_BITS // 8, "big") for k in keys], dtype=object)


def bytes_below(rows: DataFrame, probes: list[int]) -> np.ndarray:
    """Exact (bytes, rows) with a key below each probe; probes ascend. Every task adds its histogram, then one sum."""
    edges = rows.sparkSession.sparkContext.broadcast([k.to_bytes(KEY_BITS // 8, "big") for k in probes])

    def count(batches):
        fixed = np.array(edges.value, dtype="S24")
        total = np.zeros((len(fixed) + 1, 2), np.int64)
        for b in batches:
            if b.num_rows:
                at = _search(fixed, b.column(0))
                total[:, 0] += np.bincount(at, b.column(1).to_numpy(zero_copy_only=False), len(total)).astype(np.int64)
                total[:, 1] += np.bincount(at, minlength=len(total))
        hit = np.flatnonzero(total[:, 1])
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit, 0]), pa.array(total[hit, 1])], ["bin", "size", "n"])

    got = rows.select("_key", "size").mapInArrow(count, "bin bigint, size bigint, n bigint").groupBy("bin").agg(F.sum("size"), F.sum("n")).collect()
    total = np.zeros((len(probes) + 1, 2), np.int64)
    for i, size, n in got:
        total[i] = size, n
    edges.unpersist()
    return np.cumsum(total, axis=0)


def _search(edges: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Number of edges at or below each key. Keys are compared as three unsigned words, since trailing zero bytes count."""
    n = len(keys)
    words = np.frombuffer(b"".join(keys.to_pylist()), ">u8").reshape(n, 3)
    cut = np.frombuffer(edges.tobytes(), ">u8").reshape(-1, 3)
    order = lambda w: np.rec.fromarrays([w[:, i].astype("u8") for i in range(3)])
    lo = np.searchsorted(cut[:, 0].astype("u8"), words[:, 0].astype("u8"), "left")
    hi = np.searchsorted(cut[:, 0].astype("u8"), words[:, 0].astype("u8"), "right")
    out = lo.copy()
    tied = np.flatnonzero(hi > lo)
    if len(tied):  # the first word equals some edge's: compare the rest
        e, w = order(cut), order(words[tied])
        both = np.concatenate([e, w])
        rank = np.empty(len(both), np.int64)
        idx = np.lexsort((both["f2"], both["f1"], both["f0"]))
        s = both[idx]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        rank[idx] = np.cumsum(new)
        out[tied] = np.searchsorted(rank[: len(e)], rank[len(e) :], "right")
    return out


@dataclass
class Cuts:
    """Ascending boundaries: rows with a key in [keys[i-1], keys[i]) go to task i; bytes below each."""

    keys: list[int]
    below: list[int]
    rounds: int


def find_cuts(rows: DataFrame, targets: list[int], tolerance: int, total: tuple[int, int]) -> Cuts:
    """A boundary for each target number of bytes below, refined until it is within tolerance.

    Boundaries lie between the hashes of texts; where the two hashes around a target
    are neighbours and neither is within tolerance, a group larger than that is in
    the way, and the boundary goes between its rows.
    """
    n, least = len(targets), 1 << GROUP_BITS
    low = [(0, 0, 0)] * n  # key, bytes below, rows below
    high = [(1 << KEY_BITS, total[0], total[1])] * n
    best: list[tuple[int, int, int] | None] = [None] * n
    rounds = 0
    while True:
        for i in range(n):
            if best[i] is None:
                near = min(low[i], high[i], key=lambda p: abs(p[1] - targets[i]))
                if abs(near[1] - targets[i]) <= tolerance or high[i][2] - low[i][2] <= 1 or high[i][0] - low[i][0] <= 1:
                    best[i] = near
        if all(b is not None for b in best):
            return Cuts([b[0] for b in best], [b[1] for b in best], rounds)
        if rounds == MAX_ROUNDS:
            raise RuntimeError(f"{sum(b is None for b in best)} boundaries are not within tolerance after {rounds} rounds")
        probes: set[int] = set()
        for i in range(n):
            if best[i] is not None:
                continue
            (a, below_a, _), (b, below_b, _) = low[i], high[i]
            unit = least if b - a > least else 1
            share = (targets[i] - below_a) / max(1, below_b - below_a)
            guess, step = a + int((b - a) * share), max(1, (b - a) >> (3 + rounds))
            spread = [guess + step * k // (PROBES // 2) for k in range(-PROBES // 2, PROBES // 2)]
            even = [a + (b - a) * k // PROBES for k in range(1, PROBES)]
            found = {p // unit * unit for p in spread + even}
            found |= {p + unit for p in found}
            probes.update(p for p in found if a < p < b)
        rounds += 1
        ordered = sorted(probes)
        below = bytes_below(rows, ordered)
        sums = below[:-1, 0]
        for i in range(n):
            if best[i] is not None:
                continue
            k = int(np.searchsorted(sums, targets[i], "right"))
            for j in (k - 1, k):
                if 0 <= j < len(ordered):
                    p = (ordered[j], int(below[j, 0]), int(below[j, 1]))
                    if p[1] <= targets[i] and p[0] > low[i][0]:
                        low[i] = p
                    elif p[1] > targets[i] and p[0] < high[i][0]:
                        high[i] = p


def deal_heavy(groups: list[tuple[int, int]], shards: int) -> tuple[dict[int, int], list[int]]:
    """Shard of each heavy group (hash, bytes), largest first to the shard with most room, and the bytes dealt to each shard."""
    filled, where = [(0, s) for s in range(shards)], {}
    for group, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        used, s = heapq.heappop(filled)
        where[group] = s
        heapq.heappush(filled, (used + size, s))
    dealt = [0] * shards
    for used, s in filled:
        dealt[s] = used
    return where, dealt


def shard_by_bytes(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, tolerance: float = 0.002) -> DataFrame:
    """keep (all columns if None), size, text_crc32, law, shard, slot and grown_shard of every row.

    With keep=None the texts travel too, so that the result can be written with
    partitionBy("shard"); columns of df named like one of the outputs are left out.
    """
    outputs = {"size", "text_crc32", "law", "shard", "slot", "grown_shard", "_key", "_group", "_home", "_task"}
    keep = [c for c in (df.columns if keep is None else keep) if c not in outputs]
    spark, rows = df.sparkSession, keyed(df, text_col, id_col, keep)
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    slack = max(1, int(tolerance * size / shards))
    # groups over the slack are at most size / slack, that is shards / tolerance
    sizes = rows.groupBy("_group").agg(F.sum("size").alias("bytes")).where((F.col("bytes") > slack) & (F.col("bytes") <= max(slack, size // shards)))
    where, dealt = deal_heavy([tuple(r) for r in sizes.collect()], shards)
    heavy = spark.createDataFrame(pd.DataFrame({"_group": np.array(list(where), np.int64), "_home": np.array(list(where.values()), np.int32)}), "_group bigint, _home int")
    rows = rows.join(F.broadcast(heavy), "_group", "left")  # at most shards / tolerance rows of 12 bytes
    light = rows.where("_home IS NULL")
    n_light, light_size = light.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    room = [max(0.0, size / shards - d) for d in dealt]
    room = [r * light_size / max(1.0, sum(room)) for r in room]  # shards that heavy groups overfill leave less for the others
    fine = max(1, min(MAX_CUTS // shards, -(-n // (shards * TASK_ROWS))))  # tasks per shard
    edges_at = np.cumsum(np.repeat(np.array(room) / fine, fine))[:-1]
    cuts = find_cuts(light, [int(x) for x in edges_at], slack, (light_size, n_light))
    edges = spark.sparkContext.broadcast([k.to_bytes(KEY_BITS // 8 + 1, "big") for k in cuts.keys])

    @F.pandas_udf("int")
    def task(key: pd.Series) -> pd.Series:
        top = [e for e in edges.value if e[0]]  # a boundary at the very end lies above all keys
        inner = np.array([e[1:] for e in edges.value if not e[0]], dtype="S24")
        assert len(top) + len(inner) == len(edges.value)
        if not len(inner):
            return pd.Series(np.zeros(len(key), np.int32))
        return pd.Series(_search(inner, pa.array(key)).astype(np.int32))

    # a heavy group is one task's, spread over its shard's tasks by its hash
    home = F.col("_home") * fine + F.pmod("_group", F.lit(fine)).cast("int")
    placed = rows.withColumn("_task", F.coalesce(home, task("_key")))
    counts = dict(tuple(r) for r in placed.groupBy("_task").count().collect())  # at most MAX_CUTS rows
    parts = shards * fine
    starts = np.concatenate([[0], np.cumsum([counts.get(t, 0) for t in range(parts)])])
    offset = [int(starts[t] - starts[t - t % fine]) for t in range(parts)]
    offsets = spark.createDataFrame(pd.DataFrame({"_task": np.arange(parts, dtype=np.int32), "_off": np.array(offset, np.int64)}))
    order = Window.partitionBy("_task").orderBy("_key")
    ranked = placed.withColumn("_at", F.row_number().over(order) - 1)
    return ranked.join(F.broadcast(offsets), "_task").select(  # at most MAX_CUTS rows
        *keep,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.floor(F.col("_task") / fine).cast("int").alias("shard"),
        (F.col("_off") + F.col("_at")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
