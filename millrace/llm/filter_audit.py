"""Operator 11, an audit of how document filters interact.

Five filters give every document a mask of five bits. All that the orders of the
filters decide follows from how often each mask occurs, so the audit counts masks per
part (all documents, good ones, toxic ones), stacks these histograms as rows and
multiplies them by integer matrices with a row per mask and a column per order and
step: the documents kept, removed, redundant and unique at every step of all 120
orders.

Texts are read in one narrow pass; what moves afterwards is an id, a part, a mask and
a digest a document, equal rows combined before they move. Which copy of a text is the
first comes from the least id per digest, joined back by digest and id together, so
the copies of one text spread over all tasks. The products are made where the
histograms lie, a few parts at a time.

Nulls: a null text is empty, a null part is the part "". A document without an id is
no copy of any other and has no labels. Repeated ids: rows with one id and equal texts
are one place in the order, so neither is a copy of the other; a document has a label
if any row of labels for its id gives it. Very long texts are counted whole. Empty
texts have no words (A fails, B doesn't). Ties can't arise. Empty tables give an empty
result, empty labels zero losses. Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import word_lists
from millrace.llm.shared import stored

LETTERS = "ABCDE"
MASKS = 1 << len(LETTERS)
ORDERS = ["".join(p) for p in permutations(LETTERS)]
#: Parts whose results are made at once (600 rows each).
PARTS = 64
_UPPER, _INNER = bytes(range(65, 91)), bytes(range(128, 192))


@dataclass(frozen=True)
class Filters:
    """What makes a document fail. E, a copy of a document with a smaller id, has no setting."""

    min_words: int = 200
    min_distinct_percent: int = 50
    max_upper_percent: int = 3
    symbols: str = "#$%&*|"

    def mask(self, raw: bytes) -> int:
        """Bits of the filters A to D that a text (UTF-8) fails."""
        words, seen = 0, set()
        for part in word_lists(raw):
            words += len(part)
            seen.update(part)
        upper = len(raw) - len(raw.translate(None, _UPPER))
        chars = len(raw.translate(None, _INNER))
        failed = (words < self.min_words, 100 * len(seen) < self.min_distinct_percent * words, 100 * upper > self.max_upper_percent * chars)
        return sum(1 << i for i, f in enumerate((*failed, len(raw.translate(None, self.symbols.encode())) < len(raw))) if f)


def text_masks(docs: DataFrame, filters: Filters, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """_id, part, mask (A to D) and digest of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, digests = [], []
            for value in b.column(2):
                raw = value.as_py() or b""
                masks.append(filters.mask(raw))
                digests.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["_id", "part", "mask", "digest"])

    read = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("binary").alias("_raw"))
    return read.mapInArrow(run, f"_id {kind}, part string, mask int, digest binary")


def mask_histograms(docs: DataFrame, labels: DataFrame, filters: Filters = Filters(), id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """A row per part: arrays total, good and toxic, each with a count per mask of all five filters."""
    rows = text_masks(docs, filters, id_col, text_col, part_col).groupBy("_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(rows, "filter-masks")
    first = rows.where("_id IS NOT NULL").groupBy("digest").agg(F.min("_id").alias("_id")).withColumn("first", F.lit(True))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    copy = F.col("_id").isNotNull() & F.col("first").isNull()
    full = rows.join(first, ["digest", "_id"], "left").withColumn("mask", F.col("mask") + F.when(copy, 1 << LETTERS.index("E")).otherwise(0)).join(known, "_id", "left")
    counts = full.groupBy("part", "mask").agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("good") == 1, F.col("n"))), F.lit(0)).alias("good"), F.coalesce(F.sum(F.when(F.col("bad") == 1, F.col("n"))), F.lit(0)).alias("toxic")
    )
    at = lambda c, m: F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0))
    return counts.groupBy("part").agg(*[F.array(*[at(c, m) for m in range(MASKS)]).alias(c) for c in ("total", "good", "toxic")])


def outcome_matrices() -> dict[str, np.ndarray]:
    """A 0/1 matrix per outcome: a row per mask, a column per order and step (orders as in ORDERS, steps within)."""
    n, columns = len(LETTERS), len(ORDERS) * len(LETTERS)
    out = {k: np.zeros((MASKS, columns), np.int64) for k in ("kept", "removed", "redundant", "unique")}
    masks = np.arange(MASKS)
    for i, order in enumerate(ORDERS):
        before = 0
        for step, letter in enumerate(order):
            bit, column = 1 << LETTERS.index(letter), i * n + step
            fails, gone = (masks & bit) != 0, (masks & before) != 0
            out["kept"][:, column] = ~fails & ~gone
            out["removed"][:, column] = fails & ~gone
            out["redundant"][:, column] = fails & gone
            out["unique"][:, column] = masks == bit
            before |= bit
    return out


def audit(histograms: DataFrame) -> DataFrame:
    """A row per part, order and step from the rows of mask_histograms."""
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, n = outcome_matrices(), len(LETTERS)
        letter = np.array([LETTERS.index(x) for order in ORDERS for x in order])
        orders, steps = [o for o in ORDERS for _ in o], np.tile(np.arange(1, n + 1, dtype=np.int32), len(ORDERS))
        by_filter = np.equal.outer(letter, np.arange(n)).astype(np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, PARTS):
                part = b.slice(lo, PARTS)
                total, good, toxic = (np.array(part.column(i).to_pylist(), np.int64).reshape(-1, MASKS) for i in (1, 2, 3))
                removed = total @ m["removed"]
                shapley = (removed @ by_filter) @ by_filter.T
                found = [total @ m["kept"], removed, total @ m["redundant"], total @ m["unique"], good @ m["removed"], toxic @ m["removed"], shapley]
                names = [p for p in part.column(0).to_pylist() for _ in orders]
                head = [pa.array(names, pa.string()), pa.array(orders * len(total), pa.string()), pa.array(np.tile(steps, len(total)))]
                yield pa.RecordBatch.from_arrays([*head, *[pa.array(f.ravel()) for f in found]], ["part", "filter_order", "step", *columns])

    return histograms.select("part", "total", "good", "toxic").mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in columns))
