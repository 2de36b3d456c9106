"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
back as the next one's docs. All but the last return the columns of documents, and
columns beyond these are left out at every stage, so one that is named like a
stage's own doesn't matter.

Null and repeated ids: rows are judged one by one in every stage, in the order of
their ids (nulls first), then of their contents. Null texts are empty to the
classifier, have no lines to lose, are alike to near-dedup (one of them stays), leak
nothing and encode to no ids. Very long texts go through whole. Repeated rows:
the first of them stays in near-dedup, after the others have lost their lines in
line dedup. Ties don't arise beyond that. Empty tables give empty results.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import encode_documents
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.order_minhash import keep_one
from millrace.llm.quality_gam import keep_good
from millrace.llm.shared import importable, new_path, table
from millrace.llm.templates import drop_leaks
from millrace.session import configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the classifier rejects go; null and empty texts are scored like any other."""
    return keep_good(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: later matches of a line go; a document that loses all its lines goes with them. Texts that are null or blank from the start stay; n_chars is counted anew (null for a null text)."""
    left = dedup_lines(docs.select(COLUMNS))
    whole = left.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return whole.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each class of near-duplicates stays, the first in the order of ids (nulls first); texts without words are one class."""
    return keep_one(docs.select(COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that leak a benchmark item go, those without an id too, and those that share with items only what many items hold."""
    return drop_leaks(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: ids' and decoded texts' digests of what is left; a null text is empty."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def ready(stage):
    """The stage on a session with the settings that it relies on, however it is called."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(importable(configure(spark)), docs, sf_dir)

    return run_stage


STAGES = [(f.__name__, ready(f)) for f in (quality, line_dedup, near_dedup, decontaminate, encode)]
#: Boosting, verified sketches and BPE have no SQL form; tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
