"""Load gating: work list, size classes and the all-or-nothing completeness gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import EngineConfig


def work_list(counts: DataFrame, loaded_at: str, total: str) -> DataFrame:
    """Rows never loaded, smallest expected total first, unknown totals before all."""
    return counts.where(F.col(loaded_at).isNull()).orderBy(F.col(total).asc_nulls_first())


def size_class(total: Column, config: EngineConfig = EngineConfig()) -> Column:
    """zero (exactly 0), heavy (above the threshold), light (the rest, unknown included)."""
    return (
        F.when(total == 0, "zero")
        .when(F.coalesce(total, F.lit(0)) > config.heavy_review_threshold, "heavy")
        .otherwise("light")
    )


def stop_tolerance(total: Column, config: EngineConfig = EngineConfig()) -> Column:
    """Rows that may be missing: the larger of a floor and a share of the expected total, cut to a whole."""
    share = F.floor(F.coalesce(total, F.lit(0)).cast("double") * F.lit(config.stop_tolerance_ratio))
    return F.greatest(F.lit(config.stop_tolerance_min).cast("bigint"), share)


def stop_tolerance_value(total: int | None, config: EngineConfig = EngineConfig()) -> int:
    """stop_tolerance for one number, for use inside a page reader."""
    return max(config.stop_tolerance_min, int((total or 0) * config.stop_tolerance_ratio))


def is_complete(total: Column, fetched: Column, config: EngineConfig = EngineConfig()) -> Column:
    return total.isNull() | (total - F.coalesce(fetched, F.lit(0)) <= stop_tolerance(total, config))


def completeness(
    expected: DataFrame, rows: DataFrame, key: str, total: str, watermark: str | None = None, config: EngineConfig = EngineConfig()
) -> DataFrame:
    """Per expected key: total, fetched, max_seen (0 without rows) and complete.

    The rows are counted before the join (partial aggregation below the shuffle),
    so a hot key costs a counter, not its rows.
    """
    seen = F.coalesce(F.max(watermark), F.lit(0)) if watermark else F.lit(0).cast("bigint")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("fetched"), seen.alias("max_seen"))
    return expected.select(key, total).join(counted, key, "left").select(
        key,
        F.col(total),
        F.coalesce("fetched", F.lit(0)).alias("fetched"),
        F.coalesce("max_seen", F.lit(0)).alias("max_seen"),
        is_complete(F.col(total), F.col("fetched"), config).alias("complete"),
    )


def keep_complete(rows: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """All rows of complete keys, none of the others."""
    return rows.join(verdicts.where("complete").select(key), key, "left_semi")
