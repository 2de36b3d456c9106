"""Operator 9, line dedup: an exact set-similarity join over lines.

A line is the set of its words: runs of bytes other than ASCII white space, A-Z
lower-cased. A line is removed if an earlier line (smaller doc_id, then smaller
line number), kept or not, has a word set with Jaccard similarity of at least 4/5.
Lines without words stay.

Steps:
1. a frequency sketch of all words (fixed size) gives every word a rarity code;
   the order (code, hash) is the same everywhere, which is all that the prefix
   filter needs for exactness, and rare words come first, which keeps lists short.
   A second sketch tells which words surely occur once; those need no posting;
2. each line sends its set's digest (equal sets are told by 128 bits; what a task has
   sent before is known to come again) and, for each word of its prefix, a posting;
   postings of a word meet and pairs pass length,
   positional and bit filters. A line that has more than FIRST partners on a list
   names FIRST of them; on a very long list it tries the earliest lines only;
3. the texts of candidate lines are fetched and Jaccard is verified on the words;
4. lines that had more partners, and no verified match so far, are compared with
   all earlier lines of those lists, texts at hand, in pairs of blocks of bounded
   size; only the numbers of matched lines leave a task;
5. documents that lose lines are joined with the numbers of those lines.

A group of n near copies thus costs about n candidates, not n squared, and no
match is missed: a line without a verified match has tried all its candidates.

Nulls: a null text has no lines and stays null; an empty text has one line without
words. Null or repeated ids: the rows count as separate documents in the order of
their ids (nulls first), then of their contents, so equal rows alone may change
places, which doesn't show. Ties: of equal lines the earliest stays. Very long texts
are handled a slice of lines at a time where they share a batch, else whole, in
arrays of their words. Empty tables give empty results. Other columns are
untouched; those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import slices
from millrace.llm.bytewords import Words, words
from millrace.llm.packed import BLOCKS_SCHEMA, Bloom, Packer, deal, exchange, gather, mix, targets_for, unpack
from millrace.llm.shared import discard, numbered, stored

#: Similarity threshold as a fraction; sketch cells, and bits of the sketch of repeated words.
NUM, DEN = 4, 5
CELLS, BITS, CHUNKS = 1 << 20, 1 << 25, 64
#: Bytes of text handled at a time; bounds a task's memory.
SLICE = 1_000_000
#: Smallest set that can be similar to a different one.
LEAST = -(-NUM // (DEN - NUM))
#: Lines of a slice whose number fits a sort key.
KEY_LINES = 1 << 22
#: Sets that a task remembers as sent.
SEEN = 500_000
LINES, POSTINGS, AGAIN = 0, 1, 2
LINE_TYPES = ["<u8", "<u8", "<i8", "<u4"]  # digest (2), row, line
AGAIN_TYPES = ["<i8", "<u4"]  # row, line
POSTING_TYPES = ["<u4", "<u4", "<u8", "<u8", "<i8", "<u4", "<u4", "<u4"]  # word, digest, bits (2), row, line, size, position


@dataclass(frozen=True)
class Limits:
    """List length up to which all pairs are filtered at once; partners named at first; earliest lines tried on longer lists; lines and bytes of a block. None of them changes the result."""

    short_list: int = 4096
    first: int = 3
    leaders: int = 8
    block: int = 2048
    block_bytes: int = 1 << 23


@dataclass
class Sketch:
    """A rarity code per hash cell (1 MB) and one bit per place that two words or more fall on (4 MB)."""

    codes: np.ndarray
    repeated: np.ndarray

    def code(self, h: np.ndarray) -> np.ndarray:
        return self.codes[(h & np.uint64(CELLS - 1)).astype(np.int64)]

    def maybe_repeated(self, h: np.ndarray) -> np.ndarray:
        at = (h >> np.uint64(20) & np.uint64(BITS - 1)).astype(np.int64)
        return self.repeated[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1


SKETCH_SCHEMA = "chunk int, counts binary, once binary, twice binary"


def word_sketch(docs: DataFrame, text_col: str) -> Sketch:
    """Counts of all words of all rows in CELLS hash cells, and which of BITS places repeat; the driver gets CHUNKS rows of fixed size."""

    def pack(k: int, counts: np.ndarray, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
        zip_ = zstandard.ZstdCompressor(level=1)
        blobs = [pa.array([zip_.compress(x.tobytes())], pa.binary()) for x in (counts, once, twice)]
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *blobs], ["chunk", "counts", "once", "twice"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, once, twice = np.zeros(CELLS, np.int64), np.zeros(BITS, bool), np.zeros(BITS, bool)
        for b in slices(batches, "_text", SLICE):
            h = words(b.column(0)).hashes
            total += np.bincount((h & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
            at = np.sort((h >> np.uint64(20) & np.uint64(BITS - 1)).astype(np.uint32))
            twice[at[1:][at[1:] == at[:-1]]] = True
            twice[at[once[at]]] = True
            once[at] = True
        if total.any():
            for k, (c, o, t) in enumerate(zip(np.split(total, CHUNKS), np.split(np.packbits(once), CHUNKS), np.split(np.packbits(twice), CHUNKS), strict=True)):
                yield pack(k, c, o, t)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, sums = zstandard.ZstdDecompressor(), {}
        for b in batches:
            for k, *blobs in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                c, o, t = (np.frombuffer(unzip.decompress(x), d) for x, d in zip(blobs, (np.int64, np.uint8, np.uint8), strict=True))
                if k in sums:
                    c0, o0, t0 = sums[k]
                    c, o, t = c + c0, o | o0, t | t0 | (o & o0)
                sums[k] = (c, o, t)
        for k, arrays in sums.items():
            yield pack(k, *arrays)

    parts = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, SKETCH_SCHEMA)
    # joined over salted groups of tasks, then once per chunk
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16))).repartition("chunk", "salt").drop("salt").mapInArrow(add, SKETCH_SCHEMA)
    counts, repeated = np.zeros((CHUNKS, CELLS // CHUNKS), np.int64), np.zeros((CHUNKS, BITS // 8 // CHUNKS), np.uint8)
    unzip = zstandard.ZstdDecompressor()
    for k, c, t in salted.repartition("chunk").mapInArrow(add, SKETCH_SCHEMA).select("chunk", "counts", "twice").collect():
        counts[k], repeated[k] = np.frombuffer(unzip.decompress(bytes(c)), np.int64), np.frombuffer(unzip.decompress(bytes(t)), np.uint8)
    return Sketch(rarity(counts.ravel()), repeated.ravel())


def rarity(counts: np.ndarray) -> np.ndarray:
    """Codes of a byte that rise with the count, five for each doubling: they tell counts apart up to 2^51, more words than any corpus has."""
    return np.minimum(255, np.ceil(5 * np.log2(counts.astype(np.float64) + 1))).astype(np.uint8)


def line_sets(w: Words, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each line, rarest first: (hashes, line of each, start of each line, size of each line); lines without words have size 0."""
    if len(w.line_text) < KEY_LINES:
        order = np.argsort(w.line.astype(np.uint64) << np.uint64(42) | codes.astype(np.uint64) << np.uint64(34) | w.hashes >> np.uint64(30))
    else:
        order = np.lexsort((w.hashes, codes, w.line))
    h, line = w.hashes[order], w.line  # lines stay in place, as their number leads the key
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    h, line = h[first], line[first]
    n = np.bincount(line, minlength=len(w.line_text))
    return h, line, np.cumsum(n) - n, n


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (NUM * n + DEN - 1) // DEN + 1


def overlap_needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (NUM * (a + b) + NUM + DEN - 1) // (NUM + DEN)


def send_lines(docs: DataFrame, text_col: str, sketch: Sketch) -> DataFrame:
    """Blocks of line digests and postings, of the earliest line of equal sets of a task only; of the others, that they come again.

    So a line that very many documents have costs its target a record a task.
    """
    shared, targets = docs.sparkSession.sparkContext.broadcast(sketch), targets_for(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, postings, repeats = Packer(LINES, targets), Packer(POSTINGS, targets), Packer(AGAIN, targets)
        seen: dict[bytes, int] = {}  # earliest row of the sets that this task has sent
        for b in slices(batches, "_text", SLICE):
            w = words(b.column(1))
            row_of, number = b.column(0).to_numpy(zero_copy_only=False)[w.line_text], w.line_number
            h, line, start, n = line_sets(w, shared.value.code(w.hashes))
            full = np.flatnonzero(n)
            if not len(full):
                continue
            with np.errstate(over="ignore"):
                at = start[full]
                d1, d2 = np.add.reduceat(mix(h, 1), at), np.add.reduceat(mix(h, 2), at)
            # the earliest line of each set, unless this task has sent an earlier one
            order = np.lexsort((number[full], row_of[full], d2, d1))
            x, y = d1[order], d2[order]
            pick = order[np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]]
            keys, rows, last = np.stack([d1[pick], d2[pick]], 1).view("S16").ravel().tolist(), row_of[full[pick]].tolist(), np.iinfo(np.int64).max
            new = np.fromiter((r < seen.get(k, last) for k, r in zip(keys, rows, strict=True)), bool, len(pick))
            if len(seen) < SEEN:  # bounds the task's memory; a set sent again is merged by its receiver
                seen.update((k, r) for k, r, f in zip(keys, rows, new.tolist(), strict=True) if f)
            sent = pick[new]
            yield from lines.add(d1[sent], d1[sent], d2[sent], row_of[full[sent]], number[full[sent]].astype("<u4"))
            again = np.ones(len(full), bool)
            again[sent] = False
            again = full[again]
            yield from repeats.add(mix(row_of[again].view(np.uint64), 5), row_of[again].astype("<i8"), number[again].astype("<u4"))
            fresh = sent[n[full[sent]] >= LEAST]
            chosen = np.zeros(len(n), bool)
            chosen[full[fresh]] = True
            pos = np.arange(len(h)) - start[line]
            sel = np.flatnonzero(chosen[line] & (pos < prefix_length(n)[line]))
            sel = sel[shared.value.maybe_repeated(h[sel])]
            bits, digest = np.zeros((2, len(n)), np.uint64), np.zeros(len(n), "<u4")
            place, upper = np.uint64(1) << (h >> np.uint64(57) & np.uint64(63)), h >> np.uint64(63) == 1
            bits[0, full] = np.bitwise_or.reduceat(np.where(upper, np.uint64(0), place), at)
            bits[1, full] = np.bitwise_or.reduceat(np.where(upper, place, np.uint64(0)), at)
            digest[full] = d2.astype("<u4")
            l, x = line[sel], (h[sel] & np.uint64(0xFFFFFFFF)).astype("<u4")
            yield from postings.add(mix(x), x, digest[l], bits[0, l], bits[1, l], row_of[l], number[l].astype("<u4"), n[l].astype("<u4"), pos[sel].astype("<u4"))
        yield from lines.flush()
        yield from postings.flush()
        yield from repeats.flush()

    return docs.select("_row", F.col(text_col).alias("_text")).mapInArrow(run, BLOCKS_SCHEMA)


def may_match(size: np.ndarray, pos: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length, positional and bit filters for pairs (i, j); a bit that only one set has stands for a word that only it has."""
    a, b = size[i], size[j]
    need = overlap_needed(a, b)
    ok = (np.minimum(a, b) * DEN >= np.maximum(a, b) * NUM) & (np.minimum(a - pos[i], b - pos[j]) >= need)
    at = np.flatnonzero(ok)
    x, y, i, j = bits[0, i[at]], bits[0, j[at]], bits[1, i[at]], bits[1, j[at]]
    count = lambda v, w: np.bitwise_count(v & ~w).astype(np.int64)
    ok[at] = (a[at] - count(x, y) - count(i, j) >= need[at]) & (b[at] - count(y, x) - count(j, i) >= need[at])
    return ok


def meeting(limits: Limits):
    """The receiving side of send_lines: repeated sets (kind 0), candidate pairs (1) and the postings of lists on which a line has more partners than it names (2; size counts, line1 marks such lines)."""

    def out(kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = ["word", "row1", "line1", "row2", "line2", "size", "pos", "bits0", "bits1"]
        for lo in range(0, len(columns[0]), 200_000):
            arrays = [pa.array(np.full(len(columns[0][lo : lo + 200_000]), kind, np.int32))]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(c[lo : lo + 200_000].astype(np.int64)) for c in columns], ["kind", *names])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = gather(batches)
        row, number = unpack(held.pop(AGAIN, []), AGAIN_TYPES)
        none = np.zeros(len(row), np.int64)
        yield from out(0, none, none, none, row, number, none, none, none, none)
        d1, d2, row, number = unpack(held.pop(LINES, []), LINE_TYPES)
        order = np.lexsort((number, row, d2, d1))
        d1, d2, row, number = d1[order], d2[order], row[order], number[order]
        again = np.flatnonzero((d1[1:] == d1[:-1]) & (d2[1:] == d2[:-1])) + 1
        none = np.zeros(len(again), np.int64)
        yield from out(0, none, none, none, row[again], number[again], none, none, none, none)
        del d1, d2, order, again, none

        word, digest, b0, b1, row, number, size, pos = unpack(held.pop(POSTINGS, []), POSTING_TYPES)
        if not len(word):
            return
        lists = word.astype(np.uint64) << np.uint64(32) | size
        copies = digest.astype(np.uint64) << np.uint64(32) | (mix(b0, 1) ^ mix(b1, 2)) >> np.uint64(32)
        order = np.lexsort((number, row, copies, lists))  # by word, then size; copies of a set from several tasks side by side
        lists, copies = lists[order], copies[order]
        first = np.r_[True, (lists[1:] != lists[:-1]) | (copies[1:] != copies[:-1])]
        kept = order[first]
        word, row, number, size, pos = word[kept], row[kept], number[kept], size[kept].astype(np.int64), pos[kept].astype(np.int64)
        bits = np.stack([b0[kept], b1[kept]])
        del lists, copies, order, kept, b0, b1, digest
        start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        length = np.diff(np.r_[start, len(word)])
        begin, count = np.repeat(start, length), np.repeat(length, length)
        age = np.empty(len(word), np.int64)
        age[np.lexsort((number, row))] = np.arange(len(word))
        named, more = np.zeros(len(word), np.int64), np.zeros(len(word), bool)

        def pairs(i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
            ok = may_match(size, pos, bits, i, j)
            i, j = i[ok], j[ok]
            early, late = np.where(age[i] < age[j], i, j), np.where(age[i] < age[j], j, i)
            more[late[named[late] >= limits.first]] = True
            new = named[late] < limits.first
            early, late = early[new], late[new]
            np.add.at(named, late, 1)
            zero = np.zeros(len(late), np.int64)
            if len(late):
                yield from out(1, zero, row[early], number[early], row[late], number[late], zero, zero, zero, zero)

        active, shift = np.flatnonzero((count <= limits.short_list) & (count > 1)), 0
        while len(active):
            shift += 1
            active = active[active - shift >= begin[active]]
            active = active[size[active - shift] * DEN >= size[active] * NUM]
            if len(active):
                yield from pairs(active - shift, active)
        long = length > limits.short_list
        for s, n in zip(start[long].tolist(), length[long].tolist(), strict=True):
            members = s + np.argsort(age[s : s + n])
            for k in range(limits.leaders):
                yield from pairs(np.full(n - k - 1, members[k]), members[k + 1 :])
            more[members] = True
        hot = np.flatnonzero(np.logical_or.reduceat(more, start).repeat(length))
        yield from out(2, word[hot], np.zeros(len(hot), np.int64), more[hot], row[hot], number[hot], size[hot], pos[hot], *bits[:, hot].view(np.int64))

    return meet


MEET_SCHEMA = "kind int, word bigint, row1 bigint, line1 bigint, row2 bigint, line2 bigint, size bigint, pos bigint, bits0 bigint, bits1 bigint"


def fetch_lines(docs: DataFrame, text_col: str, ends: DataFrame) -> DataFrame:
    """(row, line, text) of the lines in ends, which must be stored, and of few others: texts without any aren't split."""
    keys = ends.select("row", "line").union(ends.select("row", F.lit(-1)))
    shared = docs.sparkSession.sparkContext.broadcast(Bloom.over(keys, 2 * ends.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", SLICE):
            rows = b.column(0).to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(shared.value.has(rows, np.full(len(rows), -1))))
            lines = [t.split("\n") if t is not None else [] for t in b.column(1).to_pylist()]
            n = np.fromiter(map(len, lines), np.int64, len(lines))
            rows = np.repeat(b.column(0).to_numpy(zero_copy_only=False), n)
            number = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            hit = np.flatnonzero(shared.value.has(rows, number))
            if len(hit):
                flat = list(chain.from_iterable(lines))
                yield pa.RecordBatch.from_arrays([pa.array(rows[hit]), pa.array(number[hit].astype(np.int32)), pa.array([flat[i] for i in hit.tolist()], pa.string())], ["row", "line", "text"])

    return stored(docs.select("_row", F.col(text_col).alias("_text")).mapInArrow(run, "row bigint, line int, text string"), "candidate-lines")


def alike(x: set[bytes], y: set[bytes]) -> bool:
    shared = len(x & y)
    return DEN * shared >= NUM * (len(x) + len(y) - shared)


def similar(a: str, b: str) -> bool:
    return alike(set(a.encode().lower().split()), set(b.encode().lower().split()))


def verify(docs: DataFrame, text_col: str, pairs: DataFrame) -> DataFrame:
    """Distinct (row, line) of the later lines of verified pairs. pairs must be stored."""
    ends = stored(pairs.select(F.col("row1").alias("row"), F.col("line1").alias("line")).union(pairs.select("row2", "line2")).distinct(), "pair-ends")
    lines = fetch_lines(docs, text_col, ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [i for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)) if similar(x, y)]
            if ok:
                t = b.take(pa.array(ok))
                yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], ["row", "line"])

    one = lines.select(F.col("row").alias("row1"), F.col("line").alias("line1"), F.col("text").alias("a"))
    two = lines.select(F.col("row").alias("row2"), F.col("line").alias("line2"), F.col("text").alias("b"))
    joined = pairs.join(one, ["row1", "line1"]).join(two, ["row2", "line2"])
    out = stored(joined.select("row2", "line2", "a", "b").mapInArrow(run, "row bigint, line int").distinct(), "lines-verified")
    discard(ends, lines)
    return out


def match_blocks(docs: DataFrame, text_col: str, hot: DataFrame, decided: DataFrame, limits: Limits) -> DataFrame:
    """Distinct (row, line) of lines that have a match on a long list and none before.

    A task holds a block of a list and a block of its open lines, those without a match so
    far; so a list of a million lines with one open line is dealt about once.
    """
    flagged = hot.join(decided.withColumn("done", F.lit(True)), ["row", "line"], "left").withColumn("open", F.col("more") & F.col("done").isNull()).drop("done", "more")
    # tables of one row a word are stored, so that the joins with them can be split where a word is hot
    live = stored(flagged.groupBy("word").agg(F.bool_or("open").alias("any")).where("any").select("word"), "open-words")
    flagged = stored(flagged.join(live, "word"), "open-lists")
    ends = stored(flagged.select("row", "line").distinct(), "open-lines")
    lines = fetch_lines(docs, text_col, ends)
    listed = stored(flagged.join(lines, ["row", "line"]), "listed-lines")
    size_of = F.octet_length("text")
    blocks_of = lambda n, size: F.ceil(F.greatest(n / limits.block, size / limits.block_bytes, F.lit(1.0))).cast("int")
    blocks = listed.groupBy("word").agg(blocks_of(F.count(F.lit(1)), F.sum(size_of)).alias("blocks"), blocks_of(F.count_if("open"), F.coalesce(F.sum(F.when(F.col("open"), size_of)), F.lit(0))).alias("opens"))
    blocks = stored(blocks, "open-blocks")
    dealt = deal(listed.join(blocks, "word"), ["row", "line"], "blocks", "opens", F.col("open"))
    dealt = dealt.select("word", "b1", "b2", "side", "row", "line", "size", "pos", "bits0", "bits1", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("size")
        row, line, side, size, pos = (table.column(c).to_numpy() for c in ("row", "line", "side", "size", "pos"))
        bits = np.stack([table.column(c).to_numpy().view(np.uint64) for c in ("bits0", "bits1")])
        text, known, hit = table.column("text"), {}, []

        def words_of(i: int) -> set[bytes]:
            if i not in known:
                known[i] = set(text[i].as_py().encode().lower().split())
            return known[i]

        todo = np.flatnonzero(side > 0)
        least, most = np.searchsorted(size, -(-size[todo] * NUM // DEN)), np.searchsorted(size, size[todo] * DEN // NUM, "right")
        for y, lo, hi in zip(todo.tolist(), least.tolist(), most.tolist(), strict=True):
            near = slice(lo, hi)
            before = (row[near] < row[y]) | ((row[near] == row[y]) & (line[near] < line[y]))
            x = lo + np.flatnonzero(before & (side[near] != 1))
            x = x[may_match(size, pos, bits, x, np.full(len(x), y))]
            if any(alike(words_of(i), words_of(y)) for i in x.tolist()):
                hit.append(y)
        if hit:
            yield pa.RecordBatch.from_arrays([pa.array(row[hit]), pa.array(line[hit])], ["row", "line"])

    out = stored(dealt.repartition("word", "b1", "b2").groupBy("word", "b1", "b2").applyInArrow(run, "row bigint, line int").distinct(), "lines-matched")
    discard(live, flagged, ends, lines, listed, blocks)
    return out


def removed_lines(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Distinct (row, line) of lines with an earlier match; docs has _row."""
    sketch = word_sketch(docs, text_col)
    met = stored(exchange(send_lines(docs, text_col, sketch)).mapInArrow(meeting(limits), MEET_SCHEMA), "line-meet")
    later = [F.col("row2").alias("row"), F.col("line2").cast("int").alias("line")]
    pairs = stored(met.where("kind = 1").select("row1", F.col("line1").cast("int"), "row2", F.col("line2").cast("int")).distinct(), "line-pairs")
    found = verify(docs, text_col, pairs)
    decided = stored(met.where("kind = 0").select(*later).union(found).distinct(), "lines-removed")
    hot = met.where("kind = 2").select("word", *later, (F.col("line1") == 1).alias("more"), "size", "pos", "bits0", "bits1")
    rest = match_blocks(docs, text_col, hot, decided, limits)
    out = stored(decided.union(rest), "lines-removed")  # rest has no line that is decided
    discard(met, pairs, found, decided, rest)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """docs with their remaining lines in text_col, plus n_lines and n_removed."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = numbered(docs.select(*names), id_col)
    gone = removed_lines(rows, text_col, limits)
    per_doc = stored(gone.groupBy("row").agg(F.collect_list("line").alias("_gone")), "removed-by-document")
    discard(gone)
    # the same plan at every size: what is removed grows with the documents and is never broadcast
    joined = rows.join(per_doc.hint("merge"), rows["_row"] == per_doc["row"], "left").select(*names, "_gone")
    at = names.index(text_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema] + ["n_lines int", "n_removed int"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n, removed = [], [], []
            for t, gone in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist(), strict=True):
                if t is None:
                    texts.append(None), n.append(0), removed.append(0)
                    continue
                lines = t.split("\n")
                out = set(gone or ())
                texts.append("\n".join([x for i, x in enumerate(lines) if i not in out]) if out else t)
                n.append(len(lines)), removed.append(len(out))
            columns = [b.column(i) if i != at else pa.array(texts, pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int32()), pa.array(removed, pa.int32())], [*names, "n_lines", "n_removed"])

    return joined.mapInArrow(cut, schema)
