"""Operator 3, BPE encoding and decoding by segment trees over adjacent pair ranks.

A text is cut into pieces by the vocabulary's pattern. For each piece, the leaves
of a segment tree hold the merge rank of each pair of neighbours (with its
position, so that equal ranks go leftmost first) and each inner node the least
value below it. The root names the next merge; a merge changes three leaves, each
in logarithmic time, until no pair can be merged.

Short pieces are merged many at a time: their trees are the rows of one array.
Long pieces have a tree each. Pieces repeat, so a worker keeps the ids of those
seen last in a table of bounded size.

Nulls are empty texts; an empty text has no ids and decodes to "". Very long texts
are one row of a batch; a piece of a million characters takes some tens of
megabytes. Repeated rows give repeated results; empty tables give empty results;
other columns are not touched (encode_documents returns
its own columns; with keep, the named ones too).
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from millrace.llm.shared import text_or_empty

#: A place where every vocabulary pattern of this family cuts: one space between two characters that aren't white space.
CUT = re.compile(r" (?<=\S )(?=\S)")
#: The vocabulary's pattern, white space spelled out (fixed value).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
NO_MERGE = 1 << 62
#: Longest piece (bytes) merged in the batch of short ones; most table entries and characters of a remembered entry.
SHORT, TABLE_ENTRIES, TABLE_CHARS = 64, 400_000, 256


def printable_bytes() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    others = [b for b in range(256) if b not in set(own)]
    return out | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes by id, merge ranks by pair of ids and the special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path}: only byte-level BPE without normalisation is supported")
        alphabet, vocab = printable_bytes(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.tokens[i] = bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        self.byte_ids = np.array([vocab[c] for c in sorted(alphabet, key=alphabet.get)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs; NO_MERGE where a pair has none."""
        want = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], NO_MERGE)


class PairTree:
    """Minimum tree over the pairs of one piece, eight bytes a node; a node is rank * width + place, so the least is the leftmost pair of the lowest rank."""

    def __init__(self, ranks):
        ranks = np.asarray(ranks, np.int64)
        self.width = 1 << max(0, (len(ranks) - 1).bit_length())
        nodes = np.full(2 * self.width, NO_MERGE, np.int64)
        leaves = nodes[self.width : self.width + len(ranks)]
        leaves[:] = np.where(ranks < NO_MERGE, ranks * self.width + np.arange(len(ranks)), NO_MERGE)
        k = self.width
        while k > 1:  # a level at a time
            k >>= 1
            nodes[k : 2 * k] = np.minimum(nodes[2 * k : 4 * k : 2], nodes[2 * k + 1 : 4 * k : 2])
        self.nodes = array("q", nodes.tobytes())

    def least(self) -> tuple[int, int]:
        """Rank and place of the next merge; the rank of none is beyond all."""
        return (self.nodes[1] // self.width, self.nodes[1] % self.width) if self.nodes[1] < NO_MERGE else (int(NO_MERGE), 0)

    def put(self, i: int, rank: int) -> None:
        nodes, k = self.nodes, self.width + i
        nodes[k] = rank * self.width + i if rank < NO_MERGE else NO_MERGE
        while k > 1:
            k >>= 1
            a, b = nodes[2 * k], nodes[2 * k + 1]
            best = a if a < b else b
            if nodes[k] == best:
                break
            nodes[k] = best


def merge_long(v: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one piece by its own tree."""
    first = v.byte_ids[np.frombuffer(piece, np.uint8)]
    n, none = len(first), int(NO_MERGE)
    if n < 2:
        return first.tolist()
    ids, after, before = array("q", first.tobytes()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    rank = lambda a, b: v.rank_of.get(ids[a] << 32 | ids[b], none)
    tree = PairTree(v.pair_ranks(first[:-1], first[1:]))
    while (least := tree.least())[0] < none:
        r, i = least
        gone = after[i]
        ids[i], after[i] = int(v.merged[r]), after[gone]
        ids[gone] = -1
        if gone < n - 1:
            tree.put(gone, none)
        if after[i] < n:
            before[after[i]] = i
            tree.put(i, rank(i, after[i]))
        else:
            tree.put(i, none)
        if before[i] >= 0:
            tree.put(before[i], rank(before[i], i))
    return [x for x in ids if x >= 0]


def merge_short(v: Vocabulary, pieces: list[bytes], width: int) -> list[bytes]:
    """Ids (little-endian, 4 bytes each) of many pieces of at most width + 1 bytes; one array row is one tree."""
    n, levels = len(pieces), width.bit_length() - 1
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    flat = np.frombuffer(b"".join(p.ljust(width + 1, b"\0") for p in pieces), np.uint8).reshape(n, width + 1)
    ids = v.byte_ids[flat]
    ids[np.arange(width + 1) >= sizes[:, None]] = -1
    span = width + 2  # a last column takes writes beyond the end
    sym = np.full((n, span), -1, np.int64)
    sym[:, : width + 1] = ids
    after = np.minimum(np.arange(1, span + 1)[None, :].repeat(n, 0), sizes[:, None])
    before = np.arange(-1, span - 1)[None, :].repeat(n, 0)
    tree = np.full((n, 2 * width), NO_MERGE, np.int64)
    ranks = v.pair_ranks(ids[:, :-1], ids[:, 1:])
    ranks = np.where(ids[:, 1:] >= 0, ranks, NO_MERGE)
    place = np.arange(width)
    tree[:, width:] = np.where(ranks < NO_MERGE, ranks * width + place, NO_MERGE)
    for k in range(levels - 1, -1, -1):
        lo, hi = 1 << k, 2 << k
        tree[:, lo:hi] = np.minimum(tree[:, 2 * lo : 2 * hi : 2], tree[:, 2 * lo + 1 : 2 * hi : 2])
    rows = np.flatnonzero(tree[:, 1] < NO_MERGE)

    def put(at: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        k = leaf + width
        tree[at, k] = value
        for _ in range(levels):
            k = k >> 1
            tree[at, k] = np.minimum(tree[at, 2 * k], tree[at, 2 * k + 1])

    while len(rows):
        root = tree[rows, 1]
        i, rank = root % width, root // width
        gone = after[rows, i]
        nxt = after[rows, gone]
        prev = before[rows, i]
        new = v.merged[rank]
        sym[rows, i], sym[rows, gone], after[rows, i], before[rows, nxt] = new, -1, nxt, i
        on = gone < width
        put(rows[on], gone[on], NO_MERGE)
        follow = sym[rows, nxt]
        r = v.pair_ranks(new, np.maximum(follow, 0))
        put(rows, i, np.where((follow >= 0) & (nxt < sizes[rows]) & (r < NO_MERGE), r * width + i, NO_MERGE))
        on = prev >= 0
        a, p = rows[on], prev[on]
        r = v.pair_ranks(sym[a, p], new[on])
        put(a, p, np.where(r < NO_MERGE, r * width + p, NO_MERGE))
        rows = rows[tree[rows, 1] < NO_MERGE]
    sym = sym[:, : width + 1]
    alive = sym >= 0
    ends = np.cumsum(alive.sum(1)) * 4
    out = sym[alive].astype("<u4").tobytes()
    return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def merge_pieces(v: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Ids of each piece as bytes; pieces are grouped by the width of their trees."""
    out: list[bytes] = [b""] * len(pieces)
    groups: dict[int, list[int]] = {}
    for k, p in enumerate(pieces):
        groups.setdefault(1 << max(0, (len(p) - 2).bit_length()) if len(p) > 1 else 1, []).append(k)
    for width, members in groups.items():
        if width >= SHORT:
            for k in members:
                out[k] = np.array(merge_long(v, pieces[k]), "<u4").tobytes()
            continue
        for lo in range(0, len(members), 4096):
            part = members[lo : lo + 4096]
            for k, ids in zip(part, merge_short(v, [pieces[k] for k in part], width), strict=True):
                out[k] = ids
    return out


class Encoder:
    """Texts to ids (as little-endian 32-bit bytes) and back. Special strings in a text become their ids."""

    def __init__(self, vocabulary: Vocabulary, entries: int = TABLE_ENTRIES):
        self.v, self.entries = vocabulary, entries
        self.inner: dict[str, bytes] = {}  # after a space
        self.first: dict[str, bytes] = {}  # at the start of a segment
        self.special_ids = {k: np.array([i], "<u4").tobytes() for k, i in vocabulary.special.items()}

    def _segments(self, text: str) -> Iterator[tuple[str | None, list[str]]]:
        """(special string before it or None, chunks) for each stretch of ordinary text."""
        at, special = 0, None
        if self.v.specials:
            for m in self.v.specials.finditer(text):
                yield special, CUT.split(text[at : m.start()])
                at, special = m.end(), m.group()
        yield special, CUT.split(text[at:] if at else text)

    def _learn(self, first: set[str], inner: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of unseen chunks; returns those too long to remember."""
        chunks = [(c, c, True) for c in first] + [(c, " " + c, False) for c in inner]
        cut = [PIECE.findall(full) for _, full, _ in chunks]
        distinct = list({p for ps in cut for p in ps})
        known = dict(zip(distinct, merge_pieces(self.v, [p.encode("utf-8", "surrogatepass") for p in distinct]), strict=True))
        once: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        for (c, _, is_first), ps in zip(chunks, cut, strict=True):
            ids = b"".join([known[p] for p in ps])
            if len(c) > TABLE_CHARS:
                once[not is_first][c] = ids
            else:
                (self.first if is_first else self.inner)[c] = ids
        return once

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.inner) > self.entries:
            self.inner.clear()
        if len(self.first) > self.entries // 4:
            self.first.clear()
        segments = [list(self._segments(t)) for t in texts]
        new_first, new_inner = set(), set()
        for ss in segments:
            for _, chunks in ss:
                if chunks[0] not in self.first:
                    new_first.add(chunks[0])
                new_inner.update(c for c in chunks[1:] if c not in self.inner)
        long_first, long_inner = self._learn(new_first, new_inner)
        # long chunks are looked up for these texts only
        self.first.update(long_first)
        self.inner.update(long_inner)
        inner, out = self.inner.__getitem__, []
        for ss in segments:
            parts: list[bytes] = []
            for special, chunks in ss:
                if special is not None:
                    parts.append(self.special_ids[special])
                parts.append(self.first[chunks[0]])
                parts.extend(map(inner, chunks[1:]))
            out.append(b"".join(parts))
        for c in long_first:
            del self.first[c]
        for c in long_inner:
            del self.inner[c]
        return out

    def decode(self, ids: bytes) -> str:
        tokens = self.v.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


def slices(batches: Iterator[pa.RecordBatch], text: str, most_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about most_chars bytes of text, or one row."""
    for b in batches:
        if not b.num_rows:
            continue
        column = b.column(b.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most_chars, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, keep: list[str] = ()) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of each text (with_ids: ids and decoded too).

    One narrow pass without a shuffle; a batch of about 4 MB of text is in memory.
    """
    keep = [c for c in keep if c not in (id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")]
    extra = [(f.name, f.dataType) for f in docs.select(*keep).schema] if keep else []
    schema = ", ".join(
        [f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}"]
        + [f"`{n}` {t.simpleString()}" for n, t in extra]
        + ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
        + (["ids array<int>", "decoded string"] if with_ids else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, sha = encoder(path), hashlib.sha256
        for b in slices(batches, "_text"):
            ids = e.encode(b.column(b.schema.get_field_index("_text")).to_pylist())
            texts = [e.decode(x) for x in ids]
            columns = [b.column(i) for i in range(1 + len(extra))]
            columns += [
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([sha(x).hexdigest() for x in ids]),
                pa.array([sha(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]),
            ]
            names = [id_col, *[n for n, _ in extra], "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(texts)]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, *keep, text_or_empty(text_col).alias("_text")).mapInArrow(run, schema)
