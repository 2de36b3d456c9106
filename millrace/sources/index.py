"""Secondary indexes: an inverted list from values to the files that hold them.

An index of a table's version is a table (column, value, file), one row per distinct
pair, sorted by value, so that a lookup reads few row groups of it by their statistics.
The file list then goes to the reader: files without the value aren't opened, and within
the listed ones Parquet's statistics and Bloom filters prune row groups. Arrays are
indexed by their elements. NULLs aren't indexed; values are compared as text.

A lookup gets the list of a value's files on the driver, which is no more than the
listing that any scan of the table keeps there. A value that most files hold gains
nothing; sorting or bucketing by a column makes its lists short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "column_name string, value string, file string"


def index_rows(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column_name, value, file) of a DataFrame that reads files; distinct pairs are combined before the shuffle."""
    def one(c: str) -> DataFrame:
        value = F.explode(F.array_distinct(F.col(c).cast("array<string>"))) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c).cast("string")
        return df.select(F.lit(c).alias("column_name"), value.alias("value"), F.col("_metadata.file_name").alias("file"))

    out = one(columns[0])
    for c in columns[1:]:
        out = out.union(one(c))
    return out.where("value IS NOT NULL").distinct()


def write_index(spark: SparkSession, files: str, path: str, columns: tuple[str, ...]) -> None:
    rows = index_rows(spark.read.parquet(files), columns)
    rows.repartitionByRange("column_name", "value").sortWithinPartitions("column_name", "value").write.option("parquet.bloom.filter.enabled#value", "true").mode("overwrite").parquet(path)


def listed_files(spark: SparkSession, path: str, column: str, values: list) -> list[str]:
    """Names of the files that hold any of the values."""
    rows = spark.read.schema(SCHEMA).parquet(path).where((F.col("column_name") == column) & F.col("value").isin([str(v) for v in values]))
    return sorted(r["file"] for r in rows.select("file").distinct().collect())


def lookup(warehouse, table: str, column: str, values: list) -> DataFrame:
    """Rows of a table whose column is, or whose array holds, one of the values, from the files that the index lists.

    A version without an index of the column is scanned whole.
    """
    spark, found = warehouse.spark, warehouse.snapshot(table)
    kind = found.df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        match = F.arrays_overlap(F.col(column), F.array(*[F.lit(v).cast(kind.elementType) for v in values]))
    else:
        match = F.col(column).isin(values)
    path = warehouse.index_path(table, found.version)
    fs, p = warehouse._fs(path)
    if not fs.exists(p):
        return found.df.where(match)
    files = listed_files(spark, path, column, values)
    if not files:
        indexed = spark.read.schema(SCHEMA).parquet(path).where(F.col("column_name") == column).limit(1).count()
        return found.df.where(match if not indexed else F.lit(False))
    base = warehouse.files(table, found.version)
    return spark.read.schema(found.df.schema).parquet(*[f"{base}/{f}" for f in files]).where(match)
