"""Array expressions that keep order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_distinct(positioned: Column, value: str) -> Column:
    """Sort an array of structs by their first field, take one field, keep first occurrences."""
    return F.array_distinct(F.transform(F.array_sort(positioned), lambda s: s[value]))


def empty_not_null(arr: Column) -> Column:
    return F.coalesce(arr, F.array().cast("array<string>"))
