"""Packed exchanges: millions of small fixed-width records move as compressed column blocks.

A mapping task sorts its records by target and sends one block per target; a
receiving task gets whole columns back. The JVM moves a few large binaries
instead of many small rows. Also here: a Bloom filter of bounded size over
(row, line) keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import stored

BLOCKS_SCHEMA = "kind int, target int, block binary"
MIX1, MIX2, MIX3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; seeds give independent hashes."""
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64) + MIX1 * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * MIX2
        x = (x ^ (x >> np.uint64(27))) * MIX3
        return x ^ (x >> np.uint64(31))


class Packer:
    """Buffers records of one kind and cuts them into a block per target."""

    def __init__(self, kind: int, targets: int, limit: int = 1 << 18):
        self.kind, self.targets, self.limit = kind, targets, limit
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n = 0
        self.zip = zstandard.ZstdCompressor(level=1)

    def add(self, hashes: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        """hashes choose the target; columns are fixed-width arrays."""
        if len(hashes):
            self.held.append(((hashes % np.uint64(self.targets)).astype(np.int32), *columns))
            self.n += len(hashes)
        if self.n >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        target, *columns = (np.concatenate(c) for c in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        order = np.argsort(target, kind="stable")
        target, columns = target[order], [c[order] for c in columns]
        starts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        ends = np.r_[starts[1:], len(target)]
        blocks = [self.zip.compress(b"".join(c[a:b].tobytes() for c in columns)) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(starts), self.kind, np.int32)), pa.array(target[starts]), pa.array(blocks, pa.binary())], ["kind", "target", "block"]
        )


def unpack(blocks: list[bytes], dtypes: list[str]) -> list[np.ndarray]:
    """The columns of all blocks of one kind."""
    width = sum(np.dtype(d).itemsize for d in dtypes)
    parts: list[list[np.ndarray]] = [[] for _ in dtypes]
    unzip = zstandard.ZstdDecompressor()
    for block in blocks:
        raw = unzip.decompress(block)
        n, at = len(raw) // width, 0
        for i, d in enumerate(dtypes):
            parts[i].append(np.frombuffer(raw, d, n, at))
            at += n * np.dtype(d).itemsize
    return [np.concatenate(p) if p else np.empty(0, d) for p, d in zip(parts, dtypes, strict=True)]


def targets_for(df: DataFrame) -> int:
    """Targets of an exchange: a few for each shuffle partition, so that any split of them is even."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def exchange(blocks: DataFrame) -> DataFrame:
    return blocks.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), "target")


def gather(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    """Blocks of a task by kind, still compressed."""
    held: dict[int, list[bytes]] = {}
    for b in batches:
        for kind, block in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            held.setdefault(kind, []).append(block)
    return held


def key_hash(rows: np.ndarray, lines: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(rows.astype(np.int64).view(np.uint64)) + lines.astype(np.uint64))


def deal(rows: DataFrame, ids: list[str], blocks: str, rests: str, special: Column) -> DataFrame:
    """rows dealt to the tasks (b1, b2) of their group, so that every special row meets every row once.

    A group is cut into `blocks` blocks of rows (b1) and `rests` blocks of its special rows
    (b2). side says of which block of a task a row is: 0 of the rows', 1 of the special
    ones', 2 of both (a group with one task). A group of n rows with one special row is
    dealt n times and once more for each block.
    """
    single = (F.col(blocks) == 1) & (F.col(rests) == 1)
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own, of_rest = F.pmod(F.xxhash64(*ids), F.col(blocks)).cast("int"), F.pmod(F.xxhash64(*ids, F.lit(1)), F.col(rests)).cast("int")
    place = lambda x, y, side: F.struct(x.cast("int").alias("b1"), y.cast("int").alias("b2"), side.alias("side"))
    as_row = F.transform(numbers(rests), lambda r: place(own, r, F.when(single & special, 2).otherwise(0)))
    as_special = F.when(special & ~single, F.transform(numbers(blocks), lambda b: place(b, of_rest, F.lit(1)))).otherwise(F.array().cast("array<struct<b1: int, b2: int, side: int>>"))
    return rows.withColumn("_at", F.explode(F.concat(as_row, as_special))).select("*", "_at.*").drop("_at")


class Bloom:
    """Membership of (row, line) keys with few false hits and no misses; at most 2^26 bits (8 MB)."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
        for k in range(3):
            yield mix(h, k) & np.uint64(size - 1)

    @classmethod
    def over(cls, keys: DataFrame, n: int) -> Bloom:
        """keys: (row bigint, line int), n of them. Tasks send the words they have set; a sum of ORs joins them."""
        size = 1 << min(26, max(16, (16 * n).bit_length()))

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size, bool)
            for b in batches:
                h = key_hash(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False))
                for at in cls.places(h, size):
                    bits[at] = True
            words = np.packbits(bits).view(np.int64)
            hit = np.flatnonzero(words)
            for lo in range(0, len(hit), 100_000):
                part = hit[lo : lo + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(words[part])], ["at", "word"])

        merged = keys.mapInArrow(build, "at int, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
        words = np.zeros(size // 64, np.int64)
        if merged.num_rows:
            words[merged.column(0).to_numpy()] = merged.column(1).to_numpy()
        return cls(words.view(np.uint8))

    def has(self, rows: np.ndarray, lines: np.ndarray) -> np.ndarray:
        h, size = key_hash(rows, lines), len(self.bits) * 8
        found = np.ones(len(h), bool)
        for at in self.places(h, size):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return found


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs (with _row) but for the rows of gone (_row). Only rows that a Bloom filter can't clear are shuffled."""
    keys = stored(gone.select("_row", F.lit(0).alias("line")).distinct(), "dropped-rows")
    shared = docs.sparkSession.sparkContext.broadcast(Bloom.over(keys, keys.count()))
    at = docs.columns.index("_row")

    def part(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = b.column(at).to_numpy(zero_copy_only=False)
                yield b.filter(pa.array(shared.value.has(rows, np.zeros(len(rows), np.int64)) == inside))

        return docs.mapInArrow(run, docs.schema)

    return part(False).union(part(True).join(keys.select("_row"), "_row", "left_anti").select(docs.columns))
