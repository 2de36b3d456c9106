"""Top-N per group with explicit NULL order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, partition: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """Rows ranked 1..n in each group.

    The filter on row_number lets Catalyst insert a WindowGroupLimit below the
    shuffle: each task sends at most n rows a group. NULL group keys form a group.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_n_wide(narrow: DataFrame, wide: DataFrame, key: list[str], partition: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """Rank narrow rows, then join the wide ones by key.

    Only narrow rows are shuffled for the ranking. Repeated keys multiply, as in
    any join, and `wide` need not pass the filter that `narrow` has passed.
    """
    return top_n(narrow, partition, order, n, rank).select(*key, rank).join(wide, key)
