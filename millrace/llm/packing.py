"""Operator 13, sum-of-squares packing of documents into sequences of a fixed length.

A document's ids end with a closing id; only documents that don't fit a sequence are
cut, into whole sequences and a rest. Each piece goes where the sum over all gaps g of
N(g)^2 becomes smallest, N(g) being the number of open sequences with room for g more
ids: into an open sequence (equal sums: the one with least room) or into a new one.
Pieces are placed longest first.

Lengths are packed, not texts: one narrow pass tokenizes and stores a short row per
piece. Pieces are dealt by a hash of a row number to groups of about GROUP, each packed
by a task in bounded memory; the hash makes every group alike, whatever ids or lengths
are frequent. Sequences that a group leaves with at least 1 / MERGE of their room free
are undone, and their pieces packed in another round, where one group gets those of
many, until one group packs all that is left. Pieces of exactly a sequence's length are
sequences of their own.

Words between ASCII white space are tokenized once and remembered in a table of bounded
size: this vocabulary drops white space and nothing in it looks across, so a text's ids
are its words' ids (checked when the vocabulary is read).

Nulls: a null text is empty; rows without an id are pieces like others, as are repeated
rows. Empty texts are the closing id alone. Very long texts are whole: each full piece
is a sequence, the rest is packed. Ties: equal lengths are placed in the order of the
row numbers. Empty tables give an empty result. Other columns don't matter.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, compress, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import slices
from millrace.llm.bytewords import SEGMENT, word_lists
from millrace.llm.shared import stored

CAPACITY, END_ID = 4096, 1
#: Items that a task packs, about; the share of a sequence that must be free for another round; words remembered by a worker (about 200 bytes each).
GROUP, MERGE, TABLE = 8192, 8, 1_000_000


class WordIds:
    """Ids of words (UTF-8, without ASCII white space) as little-endian 32-bit numbers, from the tokenizer's library.

    Cases of ASCII letters don't count, unless a special token might be in the text, and a
    full stop or comma after an ASCII letter is a word of its own. Unseen words go to the
    library in one text, with full stops between them; those of ASCII letters alone need
    no normalising and no cutting.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not cuts_at_space(spec):
            raise ValueError(f"{path}: its ids can depend on the white space between words")
        self.tokenizer, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        for t in (self.tokenizer, self.letters):
            t.no_truncation()
            t.no_padding()
        self.table: dict[bytes, bytes] = {}
        self.marks = {m: self.ids_of(m) for m in (b".", b",")}
        if len(self.marks[b"."]) != 4:
            raise ValueError(f"{path}: a full stop is more than one id")
        self.between = np.frombuffer(self.marks[b"."], "<u4")[0]

    def ids_of(self, word: bytes) -> bytes:
        return pack_ids(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def learn(self, words: set[bytes]) -> None:
        ended = [w for w in words if w[-1:] in self.marks and w[-2:-1].isalpha()]
        plain = list(words.difference(ended).union([w[:-1] for w in ended]))
        for w in [w for w in plain if b"." in w]:
            self.table[w] = self.ids_of(w)
        self.joined(self.letters, [w for w in plain if w.isalpha()])
        self.joined(self.tokenizer, [w for w in plain if not w.isalpha() and b"." not in w])
        for w in ended:
            self.table[w] = self.table[w[:-1]] + self.marks[w[-1:]]

    def joined(self, tokenizer, words: list[bytes]) -> None:
        if words:
            text = b" . ".join(words)
            text = (text.lower() if tokenizer is self.letters else text).decode("utf-8", "replace")
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cut = (4 * np.flatnonzero(ids == self.between)).tolist()
            raw = ids.tobytes()
            self.table.update(zip(words, [raw[i:j] for i, j in zip([0, *[c + 4 for c in cut]], [*cut, len(raw)], strict=True)], strict=True))

    def encode_words(self, lists: list[list[bytes]]) -> list[bytes]:
        if len(self.table) > TABLE:
            self.table.clear()
        new = set(filterfalse(self.table.__contains__, chain.from_iterable(lists)))
        if new:
            self.learn(new)
        return [b"".join(map(self.table.__getitem__, words)) for words in lists]

    def encode(self, raws: list[bytes]) -> list[bytes]:
        raws = [raw if b"<|" in raw else raw.lower() for raw in raws]
        short = [len(raw) <= SEGMENT for raw in raws]
        done = iter(self.encode_words([raw.split() for raw in compress(raws, short)]))
        return [next(done) if s else b"".join(self.encode_words([words])[0] for words in word_lists(raw)) for s, raw in zip(short, raws, strict=True)]


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def cuts_at_space(spec: dict) -> bool:
    """Whether a vocabulary file drops white space and no rule of it looks across (one of the forms that do so is known here)."""
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    split = parts[0] if parts else {}
    pattern = split.get("pattern", {}).get("Regex", "")
    dropped = split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed" and "[^\\s" in pattern and "\\s+" not in pattern
    later = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex", True) for p in parts[1:])
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
    forms = spec.get("normalizer") or {}
    return bool(dropped and later and plain) and all(f.get("type") in ("NFC", "Lowercase", "Replace") for f in forms.get("normalizers", [forms] if forms else []))


_TABLES: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One table per file and worker."""
    if path not in _TABLES:
        _TABLES[path] = WordIds(path)
    return _TABLES[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, piece, start, length and ids_crc32 (with_ids: ids too) of every piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    width, last = 4 * capacity, pack_ids([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(path)
        for b in slices(batches, "_raw"):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, ids_of_row in enumerate(table.encode([raw.as_py() or b"" for raw in b.column(1)])):
                whole = ids_of_row + last
                for k, at in enumerate(range(0, len(whole), width)):
                    part = whole[at : at + width]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_raw")).mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, in the order given; lengths are at most capacity.

    With an item of s ids in a sequence of room g the sum of squares changes by
    2 * (N(g - s) - N(g)) + 2, or by 1 - 2 * N(g) where it fits exactly; with a new one
    by 2 * N(capacity - s) + 1. Full sequences aren't open and don't count.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        room = count[s:capacity]  # a sequence has at least one item, so less room than its capacity
        new = 2 * count[capacity - s] + 1 if s < capacity else 0
        gap = 0
        if s < capacity and room.any():
            change = 2 * (count[: capacity - s] - room) + 2
            change[0] = 1 - 2 * room[0]
            change[room == 0] = np.iinfo(np.int64).max
            k = int(change.argmin())
            if change[k] <= new:
                gap = s + k
        if gap:
            bin_ = open_at[gap].pop()
            count[gap] -= 1
        else:
            bin_, gap, made = made, capacity, made + 1
        where[i], offset[i] = bin_, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_at[gap - s].append(bin_)
    return where, offset


def pack_groups(items: DataFrame, n: int, capacity: int, group: int, turn: int) -> DataFrame:
    """_key, length, sequence_id, offset and fill (of the sequence), stored, of items (_key, length), n of them; longest first in every group."""

    def run(table: pa.Table) -> pa.Table:
        keys, lengths = table.column("_key").to_numpy(), table.column("length").to_numpy()
        order = np.lexsort((keys, -lengths))
        where, offset = place(lengths[order], capacity)
        fill = np.bincount(where, lengths[order]).astype(np.int64)[where]
        base = (((turn << 38) + table.column("_group")[0].as_py()) << 20) if len(keys) else 0
        return pa.table({"_key": keys[order], "length": lengths[order], "sequence_id": base + where, "offset": offset, "fill": fill})

    groups = max(1, -(-n // group))
    dealt = items.select("_key", "length", F.pmod(F.xxhash64("_key"), F.lit(groups)).alias("_group"))
    return stored(dealt.groupBy("_group").applyInArrow(run, "_key bigint, length bigint, sequence_id bigint, offset bigint, fill bigint"), "packed")


def pack(lengths: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """_key, sequence_id and offset of every row of a stored table (_key unique, length), in rounds. A group has at least 2 * capacity items, so that even the shortest fill sequences."""
    group = max(group, 2 * capacity)
    names = ["_key", "sequence_id", "offset"]
    out = lengths.where(F.col("length") == capacity).select("_key", (-F.col("_key") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    items = lengths.where(F.col("length") < capacity)
    n, turn = items.count(), 0
    while True:
        placed = pack_groups(items, n, capacity, group, turn)
        is_open = F.col("fill") <= capacity - capacity // MERGE
        items, turn = placed.where(is_open).select("_key", "length"), turn + 1
        left = items.count() if n > group else 0
        if not 0 < left < n:
            return out.union(placed.select(names))
        out, n = out.union(placed.where(~is_open).select(names)), left


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id and offset of every piece (with_ids: ids too)."""
    cut = pieces(docs, path, capacity, end_id, id_col, text_col, with_ids).withColumn("_key", F.monotonically_increasing_id())
    cut = stored(cut, "pieces")
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return cut.join(pack(cut.select("_key", "length"), capacity, group), "_key").select(*names)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from pack_documents(with_ids=True); a sequence's pieces have at most its capacity of ids."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(held, lambda s: s["ids"])).alias("ids"))
