"""What the operators share: session settings, intermediate tables (of the core's scratch folder) and small column helpers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.scratch import delete, discard, new_path, shared_dir, stored

__all__ = ["delete", "digest", "discard", "importable", "new_path", "numbered", "shared_dir", "stored", "table", "text_or_empty"]

#: Most bytes of a batch that goes to a Python worker, however long its texts are. Each task's buffer for it lies outside
#: the JVM's heap and is freed by a later garbage collection of the executor, so many tasks' buffers add up.
BATCH_BYTES = "2m"
#: Workers stay between tasks: arrays of 4 MB or more go back to the system when they are freed, batches at once.
WORKER_ENV = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (on a cluster, ship it with --py-files), and bound their memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def digest(c: Column) -> Column:
    """SHA-256 of a text as 32 bytes; equal digests stand for equal texts."""
    return F.unhex(F.sha2(c, 256))


def numbered(docs: DataFrame, id_col: str) -> DataFrame:
    """docs with _row: the id where ids are unique, else a number in the order of the ids (nulls first), then of the rows' contents.

    Rows that are equal in all columns may swap numbers. The attribute numbered
    tells whether numbers were given. Hashes of the contents spread the rows of a
    frequent id, or without one, over many sorting tasks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ids = docs.select(F.col(id_col).alias("_i"))
    bad = ids.groupBy("_i").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR _i IS NULL").limit(1).count()
    given = kind not in ("bigint", "int") or bool(bad)
    if given:
        sorted_ = docs.orderBy(F.col(id_col).asc_nulls_first(), F.xxhash64(*docs.columns))
        out = stored(sorted_.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    else:
        out = docs.withColumn("_row", F.col(id_col).cast("bigint"))
    out.numbered = given
    return out
