"""Operator 10, near-duplicate documents by Order MinHash with banded alignment.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; a k-mer is
five words with its occurrence number, so that repeated passages count as often as
they occur. For each of BANDS hash functions, the ORDER least k-mers are taken in
the order in which they stand in the text; texts that have one such tuple in
common, order included, are candidates. A candidate pair is linked when a banded
alignment of its words matches at least 4/5 of the longer text. Classes are the
connected components of the links.

Steps: equal word sequences collapse to their least row. Then, ROUNDS times, every
row names one partner, the leader (least row) with which it shares most buckets
among those of other classes that it has not tried, and the classes of partners
that align are joined: a group of n near copies costs about n alignments. At last,
members of one bucket that are still in different classes are compared with each
other, texts at hand, in pairs of blocks of bounded size, so no candidate is
dropped and only links leave a task.

The alignment decides every candidate that meets two conditions of its threshold:
like length, and words in common, counted by bins of their hashes, which never
count less than the alignment can match. How much the k-mers of a candidate
resemble each other doesn't matter. Texts that share no tuple are no candidates:
with edits at random places, a text of some hundred words meets a copy that aligns
at 0.9 practically always and one at 0.8 in about nine of ten cases; a text whose
edits leave no five words in a row is never found.

Texts with fewer than five words have one k-mer, the whole text. Null texts and
texts without words are all alike. Very long texts are handled in strides; only
their words' hashes are in memory. Null or repeated ids: rows count separately, in
the order of their ids (nulls first), then by content; class_no numbers the
classes. Of equal texts the first row stays; which of two rows that are equal in
every column comes first doesn't show in the result. Empty tables give empty
results; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import slices
from millrace.llm.bytewords import words
from millrace.llm.components import connected
from millrace.llm.packed import BLOCKS_SCHEMA, Bloom, Packer, deal, exchange, gather, mix, targets_for, unpack, without_rows
from millrace.llm.shared import discard, numbered, stored

#: k-mer words; hash functions whose tuples are compared; k-mers in a tuple; similarity as a fraction; rounds of naming partners; rows and bytes of text in a block; bins of words; bytes of text handled at a time.
K, BANDS, ORDER = 5, 64, 2
NUM, DEN = 4, 5
ROUNDS = 2
BLOCK, BLOCK_BYTES = 1024, 1 << 23
BINS = 512
SLICE = 2_000_000
SKETCH_SCHEMA = "row bigint, d1 bigint, d2 bigint, n int, size bigint, bands binary"
_SEEDS = (mix(np.arange(BANDS, dtype=np.uint64), 77) >> np.uint64(32)).astype(np.uint32)[:, None]
_ODD = (mix(np.arange(BANDS, dtype=np.uint64), 78) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
_ROWS = np.arange(BANDS)
#: k-mers hashed at a time (bounds memory for very long texts).
STRIDE = 1 << 14
#: Words of a text whose places are kept as bits of one number at a time.
WIDE = 1 << 14
#: Words after which an alignment's band moves on.
BAND_STEP = 512


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k words in a row."""
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        s = h[:n].copy()
        for i in range(1, k):
            s = (s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i : n + i]
    return s


def kmers(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k-mers of texts of n words each, whose word hashes are h, labelled with their occurrence number within a text; and how many each text has."""
    text = np.repeat(np.arange(len(n)), n)
    parts, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    if len(h) >= K:
        whole = np.flatnonzero(text[: len(h) - K + 1] == text[K - 1 :])
        parts.append(grams(h, K)[whole]), owners.append(text[whole])
    ends = np.cumsum(n)
    for i in np.flatnonzero((n < K) & (n > 0)).tolist():
        parts.append(grams(h[ends[i] - n[i] : ends[i]], int(n[i]))), owners.append(np.array([i]))
    s, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    s, owner = s[order], owner[order]
    with np.errstate(over="ignore"):
        own = s ^ mix(owner.astype(np.uint64), 4)
        sorted_ = np.sort(own)
        again = sorted_[1:][sorted_[1:] == sorted_[:-1]]
        if len(again):
            at = np.flatnonzero(np.isin(own, again))
            at = at[np.argsort(own[at], kind="stable")]
            x = own[at]
            start = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            number = np.arange(len(x)) - np.repeat(start, np.diff(np.r_[start, len(x)]))
            s[at] += number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(s, 5), np.bincount(owner, minlength=len(n))


def least_two(s: np.ndarray) -> np.ndarray:
    """Positions of the two least k-mers under each hash function, in text order; a text with one k-mer names it twice."""
    if len(s) == 1:
        return np.zeros((BANDS, ORDER), np.int64)
    if len(s) > STRIDE:
        at = np.concatenate([lo + least_two(s[lo : lo + STRIDE]) for lo in range(0, len(s), STRIDE)], axis=1)
    else:
        at = None
    x = (s[None] if at is None else s[at]).astype(np.uint32)
    x = (x ^ _SEEDS) * _ODD
    one = x.argmin(1)
    if at is not None:  # a stride of one k-mer names it twice
        x[at == at[_ROWS, one][:, None]] = np.iinfo(np.uint32).max
    x[_ROWS, one] = np.iinfo(np.uint32).max
    two = x.argmin(1)
    pair = np.stack([one, two], 1) if at is None else np.stack([at[_ROWS, one], at[_ROWS, two]], 1)
    return np.sort(pair, axis=1)


def word_bins(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of texts of n words each, with hashes h: words in each of BINS bins, 255 for more."""
    text = np.repeat(np.arange(len(n)), n)
    bins = np.bincount(text * BINS + (h & np.uint64(BINS - 1)).astype(np.int64), minlength=len(n) * BINS).reshape(len(n), BINS)
    return np.minimum(bins, 255).astype(np.uint8)


def sketch(h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The distinct tuples of the hash functions of each text (64 bits each, in their order)."""
    s, count = kmers(h, n)
    ends = np.cumsum(count)
    some = np.flatnonzero(count)
    picked = np.empty((len(some), BANDS, ORDER), np.uint64)
    for k, (lo, hi) in enumerate(zip((ends - count)[some].tolist(), ends[some].tolist(), strict=True)):
        part = s[lo:hi]
        picked[k] = part[least_two(part)]
    tuples = np.full((len(some), BANDS), K, np.uint64)
    for i in range(ORDER):
        tuples = mix(tuples ^ picked[:, :, i], i)
    tuples.sort(axis=1)
    new = np.ones(tuples.shape, bool)
    new[:, 1:] = tuples[:, 1:] != tuples[:, :-1]
    bands = [b""] * len(n)
    for k, i in enumerate(some.tolist()):
        bands[i] = tuples[k][new[k]].tobytes()
    return bands


def sketches(docs: DataFrame, text_col: str) -> DataFrame:
    """One narrow row per document: digest of its words, their number, bytes of the text and tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", SLICE):
            w = words(b.column(1))
            n = np.bincount(w.text, minlength=b.num_rows)
            bands = sketch(w.hashes, n)
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            ends = (np.cumsum(n) * 8).tolist()
            raw = memoryview(w.hashes.tobytes())
            digests = [xxhash.xxh3_128_digest(raw[lo:hi]) for lo, hi in zip([0, *ends], ends, strict=False)]
            d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(n, pa.int32()), size, pa.array(bands, pa.binary())],
                ["row", "d1", "d2", "n", "size", "bands"],
            )

    return docs.select("_row", F.col(text_col).alias("_text")).mapInArrow(run, SKETCH_SCHEMA)


def buckets(reps: DataFrame) -> DataFrame:
    """kind 1: (leader, row) pairs of the buckets and in how many of a task's they occur; kind 2: (bucket, row) of buckets with several members."""
    targets = targets_for(reps)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(0, targets)
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column(2).to_pylist()
            size = np.fromiter((len(x) // 8 for x in raw), np.int64, len(raw))
            band = np.frombuffer(b"".join(raw), "<u8")
            row, n = (np.repeat(b.column(i).to_numpy(zero_copy_only=False), size) for i in (0, 1))
            yield from packer.add(mix(band, 3), band, row.astype("<i8"), n.astype("<u4"))
        yield from packer.flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, row, n = unpack(gather(batches).pop(0, []), ["<u8", "<i8", "<u4"])
        order = np.lexsort((row, band))
        band, row, n = band[order], row[order], n[order].astype(np.int64)
        if not len(band):
            return
        start = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
        length = np.diff(np.r_[start, len(band)])
        lead, count = np.repeat(start, length), np.repeat(length, length)
        star = np.flatnonzero((np.arange(len(band)) > lead) & (np.minimum(n, n[lead]) * DEN >= np.maximum(n, n[lead]) * NUM))
        pairs, times = np.unique(np.stack([row[lead[star]], row[star]], 1), axis=0, return_counts=True)
        many = np.flatnonzero(count > 1)
        for kind, x, y, z in ((1, pairs[:, 0], pairs[:, 1], times), (2, band[many].view(np.int64), row[many], count[many])):
            for lo in range(0, len(x), 200_000):
                part = slice(lo, lo + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x[part]), kind, np.int32)), pa.array(x[part]), pa.array(y[part]), pa.array(z[part])], ["kind", "x", "y", "times"])

    return exchange(reps.select("row", "n", "bands").mapInArrow(send, BLOCKS_SCHEMA)).mapInArrow(meet, "kind int, x bigint, y bigint, times bigint")


def in_common(a: np.ndarray, b: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Whether rows of bins may have as many words in common as an alignment has to match."""
    return (np.minimum(a, b).sum(-1, dtype=np.int64) >= need) | ((a == 255) & (b == 255)).any(-1)


def places(a: list) -> dict:
    """The places of each word of a, as bits of one number."""
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    return at


def matched(a: list, b: list) -> int:
    """Length of the longest common subsequence, with one bit per word of a: each word of b updates all bits of a row at once.

    A long a is cut into stretches of WIDE words; what a row carries from one into
    the next is kept, so memory follows the lengths, not their product.
    """
    total, carried = 0, bytearray(len(b))
    for lo in range(0, len(a), WIDE):
        part = a[lo : lo + WIDE]
        at, size, last = places(part), len(part), lo + WIDE >= len(a)
        free = full = (1 << size) - 1
        for j, w in enumerate(b):
            hits = at.get(w, 0)
            if hits or carried[j]:
                use = free & hits
                row = free + use + carried[j]
                carried[j] = 0 if last else row >> size
                free = (row | free ^ use) & full
        total += size - free.bit_count()
    return total


class Aligner:
    """One text, as a list of words or of their hashes, against many others."""

    def __init__(self, a: list):
        self.a, self.at = a, places(a) if len(a) <= WIDE else None

    def matches(self, b: list) -> bool:
        """Whether an alignment matches 4/5 of the longer text.

        A sufficient one leaves at most m - need words of b and n - need words of a
        unmatched, so it stays in a band of that many places before and behind the
        diagonal. The bits of a row are those of the band for BAND_STEP words of b; then it
        moves on, and the words of a that it leaves behind are counted.
        """
        n, m = len(self.a), len(b)
        need = -(-NUM * max(n, m) // DEN)
        if min(n, m) < need:
            return False
        if self.at is None:
            return _long_match(self.a, b, need)
        get = self.at.get
        rows = [get(w, 0) for w in b]
        if m - rows.count(0) < need:
            return False
        done = free = low = high = 0  # words of a that are matched for good; which words of a[low:high] are still free
        for j in range(0, m, BAND_STEP):
            begin, end = max(0, j - (m - need)), min(n, j + BAND_STEP + n - need)
            if begin > low:
                done += begin - low - (free & (1 << begin - low) - 1).bit_count()
                free, low = free >> begin - low, begin
            free |= (1 << end - high) - 1 << high - low
            high, mask = end, (1 << end - low) - 1
            step = rows[j : j + BAND_STEP]
            for hits in step if not low and high == n else [h >> low & mask for h in step]:
                if hits:
                    use = free & hits
                    free = free + use | free ^ use  # bits beyond the band do no harm
            free &= mask
        return done + high - low - free.bit_count() >= need


def _long_match(a: list, b: list, need: int) -> bool:
    """Equal beginnings and ends need no table."""
    n, m, lo, hi = len(a), len(b), 0, 0
    while lo < min(n, m) and a[lo] == b[lo]:
        lo += 1
    while hi < min(n, m) - lo and a[n - 1 - hi] == b[m - 1 - hi]:
        hi += 1
    need -= lo + hi
    if need <= 0:
        return True
    a, b = a[lo : n - hi], b[lo : m - hi]
    known = set(a)
    return sum(w in known for w in b) >= need and matched(a, b) >= need


def aligned(a: list, b: list) -> bool:
    """Aligner(a).matches(b)."""
    return Aligner(a).matches(b)


def texts_of(docs: DataFrame, text_col: str, ends: DataFrame) -> DataFrame:
    """(_row, t) of the rows of ends, which must be stored, and a few more: only texts of candidates are moved."""
    wanted = docs.sparkSession.sparkContext.broadcast(Bloom.over(ends.select("row", F.lit(0).alias("line")), ends.count()))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(wanted.value.has(rows, np.zeros(len(rows), np.int64)))
            if len(hit):
                yield b.take(pa.array(hit))

    return stored(docs.select("_row", F.col(text_col).alias("t")).mapInArrow(pick, "_row bigint, t string"), "candidate-texts")


def split_words(column: pa.Array) -> Iterator[list[bytes]]:
    for t in column.cast(pa.binary()):
        yield (t.as_py() or b"").lower().split()


def verify(docs: DataFrame, text_col: str, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts align; pairs must be stored."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in (y for x in slices(batches, "ta", SLICE) for y in slices(iter([x]), "tb", SLICE)):
            hit = pa.array([i for i, (x, y) in enumerate(zip(split_words(t.column(2)), split_words(t.column(3)), strict=True)) if aligned(x, y)], pa.int64())
            yield pa.RecordBatch.from_arrays([t.column(0).take(hit), t.column(1).take(hit)], ["a", "b"])

    ends = stored(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(), "pair-ends")
    texts = texts_of(docs, text_col, ends)
    one, two = texts.select(F.col("_row").alias("a"), F.col("t").alias("ta")), texts.select(F.col("_row").alias("b"), F.col("t").alias("tb"))
    out = stored(pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint"), "links")
    discard(ends, texts)
    return out


def partners(named: DataFrame, labels: DataFrame | None, tried: DataFrame | None) -> DataFrame:
    """(a, b): one leader a for every row b, of another class and not tried before: the one with most buckets in common, then the least."""
    if labels is not None:
        of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
        named = named.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("la", "a") != F.coalesce("lb", "b"))
        named = named.select("a", "b", "times").join(tried, ["a", "b"], "left_anti")
    best = named.groupBy("b").agg(F.max(F.struct("times", (-F.col("a")).alias("a"))).alias("best"))
    return stored(best.select((-F.col("best.a")).alias("a"), "b"), "partners")


def linked_in_block(t: pa.Table) -> list[tuple[int, int]]:
    """Links of a bucket between a block of its members and a block of those outside its largest class.

    Columns bucket, side (1: of the second block, 2: of both), rest (outside the largest
    class), row, label, shared, t. Two rows of the rest meet where the one with the lesser
    row number is of the second block.
    """
    side, rest, row, label = (t.column(c).to_numpy() for c in ("side", "rest", "row", "label"))
    label, bucket = label.copy(), t.column("bucket")[0].as_py()
    w = words(t.column("t").combine_chunks())
    n = np.bincount(w.text, minlength=len(row))
    ends = np.cumsum(n)
    bins = word_bins(w.hashes, n)
    text = lambda i: w.hashes[ends[i] - n[i] : ends[i]].tolist()
    # a pair that shares several buckets belongs to the least of them: who meets in a lesser one, by that bucket
    shared = t.column("shared").combine_chunks()
    flat, of = shared.flatten().to_numpy(), np.repeat(np.arange(len(row)), pc.list_value_length(shared).to_numpy())
    flat, of = flat[flat < bucket], of[flat < bucket]
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
    met: list[list[np.ndarray]] = [[] for _ in row]
    for lo, hi in zip(start.tolist(), [*start[1:].tolist(), len(flat)], strict=False):
        if hi - lo > 1:
            for i in of[lo:hi][side[of[lo:hi]] > 0].tolist():
                met[i].append(of[lo:hi])
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(side > 0).tolist():
        near = (side != 1) & (label != label[i]) & (~rest | (row > row[i])) & (np.minimum(n, n[i]) * DEN >= np.maximum(n, n[i]) * NUM)
        if not near.any():
            continue
        for others in met[i]:
            near[others] = False
        j = np.flatnonzero(near)
        j = j[in_common(bins[j], bins[i][None], -(-NUM * np.maximum(n[j], n[i]) // DEN))]
        mine = Aligner(text(i)) if len(j) else None
        for k in j:
            if label[k] != label[i] and mine.matches(text(k)):
                label[label == label[k]] = label[i]
                links.append((int(row[i]), int(row[k])))
    return links


def cross_links(docs: DataFrame, text_col: str, members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between members of one bucket whose classes differ; a task holds two blocks of a bucket at most.

    Members of a bucket's largest class meet only those outside of it, so a group of n near
    copies with one stranger is dealt about once, not once per block. A task joins classes
    as it finds links and skips pairs that are in one class by then, so it returns fewer
    links than it has rows.
    """
    named = members.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    named = stored(named.join(reps.select("row", "size"), "row"), "bucket-members")
    per = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    whole = per.groupBy("bucket").agg(F.max(F.struct("n", "label", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("n > top.n")
    blocks_of = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES, F.lit(1.0))).cast("int")
    rest = blocks_of(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes"))
    mixed = whole.select("bucket", F.col("top.label").alias("main"), blocks_of(F.col("n"), F.col("bytes")).alias("blocks"), rest.alias("rests"))
    mixed = stored(mixed, "bucket-blocks")  # stored, so that the join can be split where a bucket is hot
    rows = stored(named.join(mixed, "bucket").drop("size"), "mixed-buckets")
    ends = stored(rows.groupBy("row").agg(F.collect_list("bucket").alias("shared")), "mixed-rows")  # BANDS at most
    texts = texts_of(docs, text_col, ends)
    full = rows.join(ends.join(texts.withColumnRenamed("_row", "row"), "row"), "row").withColumn("rest", F.col("label") != F.col("main"))
    dealt = deal(full, ["row"], "blocks", "rests", F.col("rest")).select("bucket", "b1", "b2", "side", "rest", "row", "label", "shared", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = linked_in_block(pa.Table.from_batches(list(batches)))
        if links:
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    out = stored(dealt.repartition("bucket", "b1", "b2").groupBy("bucket", "b1", "b2").applyInArrow(run, "a bigint, b bigint"), "links")
    discard(named, mixed, rows, ends, texts)
    return out


def classes_of(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, class_no, kept) of docs, which have _row."""
    narrow = stored(sketches(docs, text_col), "sketches")
    reps = narrow.groupBy("d1", "d2").agg(F.min("row").alias("row"), F.min_by(F.struct("n", "size", "bands"), "row").alias("s"))
    reps = stored(reps.select("d1", "d2", "row", "s.n", "s.size", "s.bands"), "distinct-sketches")
    met = stored(buckets(reps), "buckets")
    named = stored(met.where("kind = 1").groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("times").alias("times")), "leaders")
    labels, tried, links = None, None, None
    for _ in range(ROUNDS):
        pairs = partners(named, labels, tried)
        found = verify(docs, text_col, pairs)
        tried, links = (pairs, found) if tried is None else (tried.union(pairs), links.union(found))
        labels = connected(links)
    members = met.where("kind = 2").select(F.col("x").alias("bucket"), F.col("y").alias("row"))
    more = cross_links(docs, text_col, members, labels, reps)
    if more.limit(1).count():
        labels = connected(links.union(more))
    classes = reps.join(labels.withColumnRenamed("node", "row"), "row", "left").select("d1", "d2", F.coalesce("label", "row").alias("class_no"))
    return narrow.select("row", "d1", "d2").join(classes, ["d1", "d2"]).select("row", "class_no", (F.col("row") == F.col("class_no")).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, class_id (the id of the class's row that is kept), kept (one row of each class) and class_no (its row number; the id where ids are unique)."""
    rows = numbered(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), "_id")
    named = classes_of(rows, "_t")
    ids = rows.select(F.col("_id").alias(id_col), F.col("_row").alias("_r"))
    out = ids.join(named, F.col("_r") == F.col("row"))
    if rows.numbered:
        heads = ids.select(F.col(id_col).alias("class_id"), F.col("_r").alias("_c"))
        out = out.join(heads, F.col("class_no") == F.col("_c"))
    else:
        out = out.withColumn("class_id", F.col("class_no").cast(docs.schema[id_col].dataType))
    return out.select(id_col, "class_id", "kept", "class_no")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the near-duplicates of an earlier document, with all their columns."""
    rows = numbered(docs, id_col)
    dropped = classes_of(rows, text_col).where("NOT kept").select(F.col("row").alias("_row"))
    return without_rows(rows, dropped).select(docs.columns)
