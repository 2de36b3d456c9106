"""Extension: reviews arriving as a stream of files, merged into the latest state per key.

The batch loaders need no streaming; this shows the same upsert with a
micro-batch sink. The checkpoint makes the source exactly-once; a row only replaces
a stored one of the same or a lower version, so a replayed or late batch changes
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.upsert import upsert_replace
from millrace.plans.ingest import merge_table


def latest(batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row per key; max_by combines before the shuffle."""
    rest = [c for c in batch.columns if c not in keys]
    return batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def merge_versions(target: DataFrame, fresh: DataFrame, keys: list[str], version: str) -> DataFrame:
    """upsert_replace by those rows of fresh whose stored row is absent or not newer; a version that is null is older than any other."""
    stored = target.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(version).alias("_version"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    stale = F.col("_version").isNotNull() & (F.col(version).isNull() | (F.col(version) < F.col("_version")))
    wins = fresh.join(stored, same, "left").where(~stale).select(fresh.columns)
    return upsert_replace(target, wins, keys)


def stream_upsert(spark: SparkSession, source: DataFrame, warehouse, table: str, keys: list[str], version: str, checkpoint: str) -> StreamingQuery:
    """Publish the merged table after every micro-batch; the warehouse keeps the last few versions only."""

    def merge(batch: DataFrame, _: int) -> None:
        fresh = latest(batch, keys, version)
        merge_table(warehouse, table, lambda old: merge_versions(old, fresh, keys, version))

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
