"""Dictionary-style lookups as joins: last row wins, ordered distinct names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import empty_not_null, ordered_distinct


def last_wins(df: DataFrame, key: str, row_no: str) -> DataFrame:
    """One row per non-NULL key: the one with the largest row number."""
    rest = [c for c in df.columns if c not in (key, row_no)]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.col(row_no)).alias("_last"))
        .select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])
    )


def positions(df: DataFrame, key: str, items: Column) -> DataFrame:
    """(key, pos, item) for each array element."""
    return df.select(key, F.posexplode(items).alias("pos", "item"))


def resolve_names(items: DataFrame, key: str, names: DataFrame, name_key: str, name: str, outputs: dict[str, Column]) -> DataFrame:
    """Join positioned items with a dimension; per key, ordered distinct name lists.

    outputs maps each output column to the condition under which an item belongs
    to it, so that one pass fills several lists. Items without a match vanish.
    """
    matched = items.join(names, F.col("item") == F.col(name_key))
    lists = [F.collect_list(F.when(cond, F.struct("pos", F.col(name).alias("name")))).alias(out) for out, cond in outputs.items()]
    return matched.groupBy(key).agg(*lists).select(key, *[ordered_distinct(F.col(o), "name").alias(o) for o in outputs])


def attach_lists(df: DataFrame, lists: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Left join the lists; keys without any get empty arrays, not NULL."""
    return df.join(lists, key, "left").withColumns({n: empty_not_null(F.col(n)) for n in names})
