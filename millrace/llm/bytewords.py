"""Words of whole batches from their UTF-8 bytes, without a Python string per word.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased, as
bytes.lower().split() gives it. Its hash takes eight bytes of it at a time, for all
words at once, and its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ODD1, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Hashes of all words, the text and the line of each; lines are numbered through the batch."""

    hashes: np.ndarray
    text: np.ndarray
    line: np.ndarray
    line_text: np.ndarray  # of each line
    line_number: np.ndarray  # of each line, within its text


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words that lie between start and end; a segment of the bytes is copied at a time."""
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + SEGMENT, "right")))
        lo = start[at]
        out[at:to] = _segment_hashes(raw[lo : end[to - 1]], start[at:to] - lo, end[at:to] - lo)
        at = to
    return out


def _segment_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    low = np.zeros(len(raw) + 8, np.uint8)
    np.multiply(raw - np.uint8(65) < 26, np.uint8(32), out=low[: len(raw)])
    low[: len(raw)] += raw
    eight = np.ndarray((len(raw) + 1,), "<u8", low, 0, (1,))  # the eight bytes from each place on
    size = end - start
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) * _ODD1
        h ^= eight[start] & _MASK[np.minimum(size, 8)]
        h *= _ODD2
        h ^= h >> np.uint64(32)
        more, at = np.flatnonzero(size > 8), 8
        while len(more):
            x = h[more]
            x ^= eight[start[more] + at] & _MASK[np.minimum(size[more] - at, 8)]
            x *= _ODD2
            x ^= x >> np.uint64(29)
            h[more] = x
            at += 8
            more = more[size[more] > at]
        h *= _ODD1
        h ^= h >> np.uint64(32)
        h *= _ODD2
    return h ^ (h >> np.uint64(32))


def words(column: pa.Array) -> Words:
    raw, offsets = text_buffer(column)
    n_texts = len(offsets) - 1
    space = (raw == 32) | ((raw - np.uint8(9)) < 5)
    begins = ~space
    ends = ~space
    if len(raw):
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begins[1:] &= space[:-1] | edge[1:-1]
        ends[:-1] &= space[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    newline = np.flatnonzero(raw == 10)
    # words of each text and between newlines are counted, not looked up one by one
    text = np.repeat(np.arange(n_texts), np.diff(np.searchsorted(start, offsets)))
    passed = np.repeat(np.arange(len(newline) + 1), np.diff(np.r_[0, np.searchsorted(start, newline), len(start)]))
    before = np.searchsorted(newline, offsets[:-1])  # newlines before each text
    lines = np.diff(np.r_[before, len(newline)]) + 1
    first_line = before + np.arange(n_texts)
    line_text = np.repeat(np.arange(n_texts), lines)
    return Words(word_hashes(raw, start, end), text, passed + text, line_text, np.arange(len(line_text)) - first_line[line_text])


_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_lists(raw: bytes, most: int = SEGMENT) -> Iterator[list[bytes]]:
    """The words of a text as they are, in lists from about `most` bytes each: a very long text never lies in memory as words."""
    at = 0
    while len(raw) - at > most:
        cut = _SPACE.search(raw, at + most)
        if cut is None:
            break
        yield raw[at : cut.start()].split()
        at = cut.end()
    yield (raw[at:] if at else raw).split()
