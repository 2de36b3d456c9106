"""Operator 1, token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer version, count). A run
joins the documents' distinct digests with it, encodes each text that it lacks
once, appends those counts, and joins again. A later run over overlapping texts
encodes only what is new, and texts that are stored are never moved: before the
texts' shuffle, a Bloom filter of bounded size over the missing digests drops them
(beyond some ten million missing texts it lets all through; they are joined anyway).

Normalised content: NULL becomes the empty text and nothing else changes, since
any other normalisation would change counts. The version digest covers the
tokenizer's file and this rule, so another vocabulary never meets these counts.

Nulls and empty texts count 0 tokens; repeated rows and equal texts get equal
counts from one encoding; null and repeated ids don't matter, as rows meet their
counts by digest. Very long texts are one row of a batch; their chunks are counted,
not remembered. Empty tables give empty results. Columns named in keep are
carried, but for those named like an output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import CUT, slices
from millrace.llm.packed import Bloom
from millrace.llm.shared import digest, discard, new_path, stored, text_or_empty

RULE = "null-is-empty/1"
CACHE_SCHEMA = "digest binary, version string, n_tokens bigint"
#: Most remembered chunks of a worker and the longest of them.
TABLE_ENTRIES, TABLE_CHARS = 500_000, 256
#: Digests that a task remembers so as not to send or encode a text twice.
SEEN_DIGESTS = 2_000_000


def version_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + RULE.encode()).hexdigest()[:32]


class CountCache:
    """Counts by digest and tokenizer version, in one folder per version."""

    def __init__(self, spark: SparkSession, path: str, version: str):
        self.spark, self.path, self.version = spark, f"{path}/version={version}", version

    def _exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self) -> DataFrame | None:
        """(digest, n_tokens) or None where nothing is stored. Two writers may store a digest twice, with the same count."""
        if not self._exists():
            return None
        return self.spark.read.schema("digest binary, n_tokens bigint").parquet(self.path)

    def append(self, counts: DataFrame) -> None:
        counts.select("digest", "n_tokens").write.mode("append").parquet(self.path)


def open_cache(spark: SparkSession, folder: str, path: str) -> CountCache:
    """The cache in a folder for the tokenizer file at path."""
    return CountCache(spark, folder, version_digest(path))


class TextCounter:
    """Counts as the tokenizer's own library gives them, without added special tokens.

    For byte-level BPE, texts are cut where the pattern always cuts, and counts
    of the chunks are remembered in a table of bounded size; the library counts
    each unseen chunk. Other tokenizers count whole texts.
    """

    def __init__(self, path: str):
        #: chunks that begin a text, and chunks after a space
        self.first: dict[str, int] = {}
        self.inner: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in self.model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        import json

        spec = json.loads(self.model.to_str())
        pre = spec.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
        plain = not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        self.counts = self._by_chunks if byte_level and plain and not spec.get("post_processor") else self._library

    def _library(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_chunks(self, texts: list[str]) -> list[int]:
        if len(self.first) + len(self.inner) > TABLE_ENTRIES:
            self.first.clear(), self.inner.clear()
        cut = [CUT.split(t) for t in texts]
        new_first = list({c[0] for c in cut if c[0] not in self.first})
        new_inner = list({x for c in cut for x in c[1:] if x not in self.inner})
        counts = self._library(new_first + [" " + x for x in new_inner])
        self.first.update(zip(new_first, counts))
        self.inner.update(zip(new_inner, counts[len(new_first) :], strict=True))
        get = self.inner.__getitem__
        out = [self.first[c[0]] + sum(map(get, c[1:])) for c in cut]
        for known, new in ((self.first, new_first), (self.inner, new_inner)):
            for x in new:
                if len(x) > TABLE_CHARS:
                    del known[x]
        return out


_COUNTERS: dict[str, TextCounter] = {}


def counter(path: str) -> TextCounter:
    if path not in _COUNTERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _COUNTERS[path] = TextCounter(path)
    return _COUNTERS[path]


def _once(batches: Iterator[pa.RecordBatch], seen: set[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows whose digest is new to this task."""
    for b in batches:
        rows = []
        for i, d in enumerate(b.column(0).to_pylist()):
            if d not in seen:
                seen.add(d)
                rows.append(i)
        if len(seen) > SEEN_DIGESTS:  # bounds the task's memory; a text sent again is dropped by its receiver
            seen.clear()
        if rows:
            yield b if len(rows) == b.num_rows else b.take(pa.array(rows))


def distinct_texts(docs: DataFrame, text_col: str, missing: Bloom | None) -> DataFrame:
    """(digest, text) of missing texts (all if None), each digest about once per task: copies collapse before the shuffle, however many there are."""
    pairs = docs.select(digest(text_or_empty(text_col)).alias("digest"), text_or_empty(text_col).alias("text"))
    wanted = docs.sparkSession.sparkContext.broadcast(missing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def open_() -> Iterator[pa.RecordBatch]:
            for b in batches:
                if wanted.value is not None and b.num_rows:
                    keys = np.frombuffer(b"".join(x[:8] for x in b.column(0).to_pylist()), ">i8").astype(np.int64)
                    b = b.filter(pa.array(wanted.value.has(keys, np.zeros(len(keys), np.int64))))
                yield b

        return _once(open_(), set())

    return pairs.mapInArrow(run, "digest binary, text string")


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of texts that are hashed by digest; a digest that several tasks sent is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in slices(_once(batches, set()), "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c.counts(b.column(1).to_pylist()), pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens bigint")


def fill(docs: DataFrame, path: str, cache: CountCache, text_col: str = "text") -> None:
    """Append the counts of the texts that the cache lacks."""
    stored_, missing = cache.read(), None
    if stored_ is not None:
        here = docs.select(digest(text_or_empty(text_col)).alias("digest")).distinct()
        missing = stored(here.join(stored_.select("digest"), "digest", "left_anti"), "missing-digests")
        n = missing.count()
        if not n:
            discard(missing)
            return
    texts = distinct_texts(docs, text_col, None if missing is None else Bloom.over(missing.select(_key("digest"), F.lit(0)), n)).repartition("digest")
    if missing is not None:
        texts = texts.join(missing, "digest", "left_semi")
    cache.append(encode_counts(texts, path))
    if missing is not None:
        discard(missing)


def _key(c: str):
    """The first eight bytes of a digest as a number."""
    return F.conv(F.hex(F.substring(c, 1, 8)), 16, -10).cast("bigint").alias("row")


def count_tokens(docs: DataFrame, path: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """id, keep, n_bytes (UTF-8) and n_tokens per row.

    cache_path: the cache's folder; a new one in the shared folder if None.
    New texts cross the network once, hashed by digest; counts and digests
    of the rows are narrow. A digest that many rows share is split by Spark's
    skew join, as the cache side holds it once.
    """
    spark, keep = docs.sparkSession, [c for c in keep if c not in (id_col, "n_bytes", "n_tokens")]
    cache = open_cache(spark, cache_path or new_path(spark, "token-counts"), path)
    fill(docs, path, cache, text_col)
    # writers at the same time may have stored a digest twice; the sums are stored, so that the join can be split where a digest is hot
    counts = stored(cache.read().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    text, counts = text_or_empty(text_col), counts.select(F.col("digest").alias("_digest"), F.col("n_tokens").alias("_n_tokens"))
    rows = docs.select(id_col, *keep, F.octet_length(text).cast("bigint").alias("_n_bytes"), digest(text).alias("_digest"))
    named = [F.col("_n_bytes").alias("n_bytes"), F.col("_n_tokens").alias("n_tokens")]
    return rows.join(counts, "_digest", "left").select(id_col, *keep, *named)
