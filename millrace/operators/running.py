"""Running totals over a global order, and what follows from them: ranks and exact medians.

A window without a partition, or with one that holds most rows, sorts its rows in one
task. Here rows are range-partitioned by the whole order and numbered within their
range; a key that goes on from the ranges before gets their sum on top. What meets on
the driver is one row per range.

Ranges are cut between different rows of the order, so equal rows share a task: make the
order total, or combine equal rows first. NULLs come first and form a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.scratch import stored


def running_total(df: DataFrame, by: list[str], order: list[Column], weight: str | Column, before: str = "before", total: str | None = None, tasks: int | None = None) -> DataFrame:
    """df with the sum of weight over the earlier rows of the same `by`, and over all of them (`total`).

    df is stored once, range-partitioned into so many tasks (the shuffle partitions if not
    given); ranges are sampled, so a second evaluation could cut it elsewhere.
    """
    spark = df.sparkSession
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    weighed = df.withColumn("_weight", F.col(weight) if isinstance(weight, str) else weight)
    sort = [F.col(c).asc_nulls_first() for c in by] + order
    placed = stored(weighed.repartitionByRange(n, *sort).withColumn("_task", F.spark_partition_id()), "ranges")
    key = F.struct(*by) if by else F.lit(0)
    sums = placed.groupBy("_task", *by).agg(F.sum("_weight").alias("_n"))
    edges = sums.groupBy("_task").agg(F.min(key).alias("first"), F.min_by("_n", key).alias("n_first"), F.max(key).alias("last"), F.max_by("_n", key).alias("n_last")).orderBy("_task").collect()
    offsets, current, carried = [], object(), 0
    for e in edges:  # one row a range
        carried = carried if e["first"] == current else 0
        offsets.append((e["_task"], carried))
        current, carried = (e["last"], carried + e["n_last"]) if e["first"] == e["last"] else (e["last"], e["n_last"])
    heads = spark.createDataFrame(offsets, "_range int, _carried bigint")
    firsts = sums.groupBy("_task").agg(F.min(key).alias("_first")).join(F.broadcast(heads), F.col("_task") == F.col("_range"), "right")
    firsts = firsts.where("_carried > 0").select("_range", "_carried", "_first")  # one row a range
    w = Window.partitionBy("_task", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_within", F.coalesce(F.sum("_weight").over(w), F.lit(0)))
    joined = within.join(F.broadcast(firsts), (F.col("_task") == F.col("_range")) & (key == F.col("_first") if by else F.lit(True)), "left")
    out = joined.withColumn(before, F.col("_within") + F.coalesce("_carried", F.lit(0)))
    if total:
        whole = sums.groupBy(*by).agg(F.sum("_n").alias(total))
        spread = sums.select("_task", *by).alias("a").join(whole.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by] or F.lit(True))
        spread = spread.select(F.col("a._task").alias("_at"), *[F.col(f"a.{c}").alias(f"_by{i}") for i, c in enumerate(by)], F.col(f"b.{total}"))
        # joined by range and key: the rows of one key stay spread over their ranges
        out = out.join(spread, [F.col("_task") == F.col("_at"), *[F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]])
    return out.select(*df.columns, before, *([total] if total else []))


def global_rank(df: DataFrame, order: list[Column], rank: str = "position", tasks: int | None = None) -> DataFrame:
    """df with 1, 2, ... in a total order, without one task that sorts everything."""
    return running_total(df, [], order, F.lit(1).cast("bigint"), rank, tasks=tasks).withColumn(rank, F.col(rank) + 1)


def exact_median(df: DataFrame, key: str, value: str, name: str = "median_value", tasks: int | None = None) -> DataFrame:
    """The interpolated median per key, like F.median, whatever share of the rows one key has.

    Equal values are counted before the first shuffle. A key without values, where there
    are rows of it, has a NULL median.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    run = running_total(counts, [key], [F.col(value).asc()], "_n", "_before", "_all", tasks)
    covers = lambda at: (F.col("_before") <= at) & (at < F.col("_before") + F.col("_n"))
    low, high = covers(F.floor((F.col("_all") - 1) / 2)), covers(F.floor(F.col("_all") / 2))
    middle = run.where(low | high).groupBy(F.col(key).alias("_key")).agg(F.min(F.when(low, F.col(value))).alias("_low"), F.max(F.when(high, F.col(value))).alias("_high"))
    keys = df.select(key).distinct()
    median = F.col("_low").cast("double") * 0.5 + F.col("_high").cast("double") * 0.5
    return keys.join(middle, F.col(key).eqNullSafe(F.col("_key")), "left").select(key, median.alias(name))
