"""Keyed upserts as full-outer joins: incoming rows win, absent rows stay.

Each returns the whole new state of the target; the caller publishes it as a
new table version (a table is never overwritten while it is read).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _merge(target: DataFrame, incoming: DataFrame, keys: list[str], pick) -> DataFrame:
    """Full outer join on keys; pick(column, new, old, is_new, is_old) gives each non-key column."""
    new, old = incoming.withColumn("_in", F.lit(True)).alias("n"), target.withColumn("_in", F.lit(True)).alias("o")
    on = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) if len(keys) > 1 else F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys]
    joined = new.join(old, on, "full_outer")
    is_new, is_old = F.col("n._in").isNotNull(), F.col("o._in").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        else:
            fresh = F.col(f"n.{c}") if c in incoming.columns else F.lit(None)
            kind = target.schema[c].dataType
            out.append(pick(c, fresh.cast(kind), F.col(f"o.{c}"), is_new, is_old).cast(kind).alias(c))
    return joined.select(*out)


def upsert_replace(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Every non-key column comes from the incoming row where there is one, NULLs included."""
    return _merge(target, incoming, keys, lambda c, n, o, is_new, is_old: F.when(is_new, n).otherwise(o))


def upsert_with_previous(
    target: DataFrame, incoming: DataFrame, keys: list[str], value: str, previous: str, untouched: list[str] = ()
) -> DataFrame:
    """upsert_replace that shifts the old `value` to `previous` and leaves `untouched` columns alone.

    A new key gets NULL in both. An incoming NULL replaces a good value: the
    census keeps what it was told, and the old total stays readable in `previous`.
    """

    def pick(c: str, n: Column, o: Column, is_new: Column, is_old: Column) -> Column:
        if c == previous:
            return F.when(is_new & is_old, F.col(f"o.{value}")).when(is_old, o)
        if c in untouched:
            return o
        return F.when(is_new, n).otherwise(o)

    return _merge(target, incoming, keys, pick)


def advance_watermark(
    target: DataFrame, marks: DataFrame, key: str, watermark: str, marked_at: str, value: str, now: Column
) -> DataFrame:
    """Mark the keys in `marks` as loaded, at the time `now` (of the marks or fixed), and raise their watermark; it never goes down.

    Keys absent from `target` are ignored; rows without a mark are unchanged.
    """
    m = marks.select(F.col(key).alias("_key"), F.col(value).alias("_value"), now.alias("_now"), F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    raised = F.greatest(F.coalesce(F.col(watermark), F.lit(0)), F.col("_value"))
    return target.join(m, F.col(key) == F.col("_key"), "left").select(
        *[
            (F.when(hit, F.col("_now")).otherwise(F.col(c)) if c == marked_at else F.when(hit, raised).otherwise(F.col(c)) if c == watermark else F.col(c)).alias(c)
            for c in target.columns
        ]
    )
