"""A warehouse in Spark's catalog: a database per layer, tables that are replaced as a whole.

A table is external, its columns and itself carry comments, and `SELECT ... FROM
marts.game_stats` reads it. Its files lie in a folder per version. Publishing writes
the next version under a hidden name, renames the folder without overwriting and points
the catalog's table at it: readers see the old files or the new ones, a failed write
leaves nothing, and a writer that read an older version than the latest is refused. The
file system must refuse a rename onto an existing folder, as HDFS and local file systems
do. Rows that are only ever added go through the load sink (see loads.py).

The versions are the truth; a catalog that doesn't outlive the session is filled from
them by attach().
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.index import write_index

#: Versions whose files stay for running readers; attempts of a writer that replaces whatever is there.
KEPT_VERSIONS, ATTEMPTS = 5, 20
#: Bytes of a bucket, by the optimizer's estimate; most buckets.
BUCKET_BYTES, MOST_BUCKETS = 256 << 20, 1 << 15
#: Parquet files: zstd halves most texts; row groups bound what a task that writes them holds in memory.
FILES = {"compression": "zstd", "parquet.block.size": str(32 << 20)}


class Conflict(RuntimeError):
    """Another writer has published since this one read the table."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a table; later ones don't change it."""

    table: str
    version: int
    df: DataFrame


@dataclass(frozen=True)
class Layout:
    """How files are written: buckets (sorted by the same columns), columns with Bloom filters, columns with an inverted index.

    Without a number of buckets it follows the size of the rows and the shuffle partitions
    (Spark shuffles a table with fewer buckets anew), as a power of two, so that tables of
    different sizes still join bucket by bucket.
    """

    bucket_by: tuple[str, ...] = ()
    buckets: int = 16
    bloom: tuple[str, ...] = ()
    index: tuple[str, ...] = ()


def bucket_count(layout: Layout, df: DataFrame) -> int:
    """Buckets for the rows of df; 0 without a column to cut by."""
    if not layout.bucket_by or layout.buckets:
        return layout.buckets if layout.bucket_by else 0
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_BUCKETS, max(partitions, size // BUCKET_BYTES, 2))
    return 1 << (wanted - 1).bit_length()


def column_ddl(schema: T.StructType) -> str:
    def one(f: T.StructField) -> str:
        comment = f.metadata.get("comment", "").replace("\\", "\\\\").replace("'", "\\'")
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{comment}'" if comment else "")

    return ", ".join(map(one, schema.fields))


def commented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """df with comments on columns; other columns keep theirs."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(f"`{c}`") for c in df.columns])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _rename(self, source: str, target: str) -> bool:
        """Rename unless the target exists."""
        jvm = self.spark._jvm
        (_, a), (fs, b) = self._fs(source), self._fs(target)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(a, b, options)
        except Exception:
            if fs.exists(b):
                return False
            raise
        return True

    def versions(self, table: str) -> list[int]:
        return sorted(int(n[1:]) for n in self._names(self.folder(table)) if n[:1] == "v" and n[1:].isdigit())

    def version(self, table: str) -> int:
        """The latest version; -1 without any."""
        return max(self.versions(table), default=-1)

    def exists(self, table: str) -> bool:
        return self.version(table) >= 0

    def files(self, table: str, version: int) -> str:
        return f"{self.folder(table)}/v{version}"

    def snapshot(self, table: str) -> Snapshot:
        """The latest version, to read from and to publish on."""
        version = self.version(table)
        if version < 0:
            raise LookupError(f"no table {table}")
        return Snapshot(table, version, self.spark.read.parquet(self.files(table, version)))

    def read(self, table: str) -> DataFrame:
        """The table by its name in the catalog, brought up to the latest version; views are read as they are."""
        if table.split(".")[-1] not in self._views(table.split(".")[0]):
            self.attach(table)
        return self.spark.table(table)

    def _views(self, database: str) -> set[str]:
        if not self.spark.catalog.databaseExists(database):
            return set()
        return {r["viewName"] for r in self.spark.sql(f"SHOW VIEWS IN `{database}`").collect() if r["namespace"]}

    def attach(self, table: str) -> None:
        """Point the catalog's table at the latest version, where it isn't."""
        version = self.version(table)
        if version < 0:
            raise LookupError(f"no table {table}")
        path = self.files(table, version)
        if not self.spark.catalog.tableExists(table) or not self._described(table)[0].endswith(path.removeprefix("file://").removeprefix("file:")):
            layout, buckets = self._layout(path)
            self._point(table, path, self.spark.read.parquet(path).schema, None, layout, buckets)

    def attach_all(self) -> list[str]:
        """Attach every table under the root; returns their names."""
        found = [f"{db}.{t}" for db in self._names(self.root) for t in self._names(f"{self.root}/{db}") if self.exists(f"{db}.{t}")]
        for table in found:
            self.attach(table)
        return found

    def _described(self, table: str) -> tuple[str, tuple[str, ...], int, str]:
        """Location, bucket columns, number of buckets and comment of the catalog's table."""
        about = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        columns = tuple(c.strip(" `") for c in about.get("Bucket Columns", "[]").strip("[]").split(",") if c.strip())
        return about.get("Location", ""), columns, int(about.get("Num Buckets", 0)), about.get("Comment", "")

    def _layout(self, path: str) -> tuple[Layout, int]:
        """The layout that a version was written with, and its number of buckets."""
        fs, p = self._fs(f"{path}/_layout.json")
        if not fs.exists(p):
            return Layout(), 0
        stream = fs.open(p)
        try:
            known = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        buckets = known.pop("used")
        return Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in known.items()}), buckets

    def _note_layout(self, path: str, layout: Layout, buckets: int) -> None:
        fs, p = self._fs(f"{path}/_layout.json")
        out = fs.create(p)
        out.write(bytearray(json.dumps(asdict(layout) | {"used": buckets}).encode()))
        out.close()

    def _point(self, table: str, path: str, schema: T.StructType, comment: str | None, layout: Layout, buckets: int) -> None:
        """Let the catalog's table read a folder: a new location where nothing else changes, else a new entry."""
        database = table.split(".")[0]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")  # without a location: dropping it must not delete files
        there = self.spark.catalog.tableExists(table)
        known = self.spark.table(table).schema if there else T.StructType()
        if there and known.simpleString() == schema.simpleString() and self._described(table)[1:3] == (layout.bucket_by, buckets):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            if comment:
                self.spark.sql(f"COMMENT ON TABLE {table} IS '{_quoted(comment)}'")
            for f in schema.fields:
                if f.metadata.get("comment", "") != known[f.name].metadata.get("comment", ""):
                    self.spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{f.name}` COMMENT '{_quoted(f.metadata.get('comment', ''))}'")
            return
        if there:
            comment = comment or self._described(table)[3]
            self.spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
        columns = ", ".join(f"`{c}`" for c in layout.bucket_by)
        cut = f" CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS" if layout.bucket_by else ""
        about = f" COMMENT '{_quoted(comment)}'" if comment else ""
        self.spark.sql(f"CREATE TABLE {table} ({column_ddl(schema)}) USING parquet{cut}{about} LOCATION '{path}'")

    def _write(self, df: DataFrame, table: str, path: str, layout: Layout, buckets: int) -> None:
        if layout.bucket_by:  # one file a bucket, not one for each task and bucket
            df = df.repartition(buckets, *layout.bucket_by)
        writer = df.write.options(**FILES)
        for c in layout.bloom:
            element = ".list.element" if isinstance(df.schema[c].dataType, T.ArrayType) else ""
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}{element}", "true")
        if not layout.bucket_by:
            writer.parquet(path)
            return
        database, name = table.split(".")[0], f"pending_{uuid.uuid4().hex}"  # buckets are only written by way of a catalog entry
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        try:
            writer.format("parquet").bucketBy(buckets, *layout.bucket_by).sortBy(*layout.bucket_by).option("path", path).saveAsTable(f"{database}.{name}")
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")

    def publish(self, table: str, df: DataFrame, based_on: int | None = None, comment: str | None = None, layout: Layout | None = None) -> int:
        """Write df as the table's next version; returns its number.

        based_on is the version that df was made from: if another has been published
        since, nothing happens and Conflict is raised. Without it df replaces whatever is
        there. The layout and comments stay as they are unless others are given.
        """
        latest = self.version(table)
        if latest >= 0:
            self.attach(table)
            known = {f.name: f.metadata["comment"] for f in self.spark.table(table).schema if f.metadata.get("comment")}
            df = commented(df, {c: t for c, t in known.items() if c in df.columns and not df.schema[c].metadata.get("comment")})
        layout = layout or self._layout(self.files(table, latest))[0]
        buckets = bucket_count(layout, df)
        pending = f"{self.folder(table)}/_pending-{uuid.uuid4().hex}"
        try:
            self._write(df, table, pending, layout, buckets)
            self._note_layout(pending, layout, buckets)
            version = self._claim(table, pending, based_on)
        except BaseException:
            with contextlib.suppress(Exception):
                self.delete(pending)
            raise
        path = self.files(table, version)
        if layout.index:
            write_index(self.spark, path, self.index_path(table, version), layout.index)
        self._point(table, path, df.schema, comment, layout, buckets)
        for old in self.versions(table)[: -KEPT_VERSIONS]:
            self.delete(self.files(table, old))
            self.delete(self.index_path(table, old))
        return version

    def _claim(self, table: str, pending: str, based_on: int | None) -> int:
        for _ in range(ATTEMPTS):
            version = (self.version(table) if based_on is None else based_on) + 1
            later = based_on is not None and self.version(table) > based_on
            if not later and self._rename(pending, self.files(table, version)):
                return version
            if based_on is not None:
                raise Conflict(f"{table}: version {based_on} was read, {self.version(table)} is there")
        raise Conflict(f"{table}: other writers were faster {ATTEMPTS} times")

    def index_path(self, table: str, version: int) -> str:
        return f"{self.folder(table)}/_index/v{version}"

    def stage(self, df: DataFrame, name: str) -> str:
        """Write rows that a load reads more than once; the caller deletes them."""
        path = f"{self.root}/_stage/{name}-{uuid.uuid4().hex}"
        df.write.options(**FILES).parquet(path)
        return path

    def create_if_absent(self, table: str, schema: T.StructType, comment: str | None = None, layout: Layout | None = None) -> None:
        if not self.exists(table):
            with contextlib.suppress(Conflict):
                self.publish(table, self.spark.createDataFrame([], schema), -1, comment, layout)

    def vacuum(self, min_age_hours: float = 24.0) -> int:
        """Delete what crashed writers left, unless it is young and may belong to a running one; returns how many folders."""
        gone, oldest = 0, (time.time() - 3600 * min_age_hours) * 1000
        for db in self._names(self.root):
            below = [f"{self.root}/{db}"] if db == "_stage" else [f"{self.root}/{db}/{t}{sub}" for t in self._names(f"{self.root}/{db}") for sub in ("", "/rows", "/marks")]
            for folder in below:
                fs, p = self._fs(folder)
                for s in fs.listStatus(p) if fs.exists(p) and fs.getFileStatus(p).isDirectory() else []:
                    if (db == "_stage" or s.getPath().getName().startswith("_pending-")) and s.getModificationTime() <= oldest:
                        gone += bool(fs.delete(s.getPath(), True))
        return gone


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
