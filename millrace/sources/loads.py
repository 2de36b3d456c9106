"""All-or-nothing loads: a transactional sink for rows that are only ever added.

    rows.write.format("load_sink").options(path=..., load=..., expected="[[10, 120], [20, null]]").mode("append").save()

Every task writes the rows of whole applications and reports what it fetched; an
application far from its expected total leaves no rows. When all tasks have ended, the
driver's commit publishes the rows' folder and then a file of verdicts, one row per
expected application. Rows count only if their load has verdicts (`create_views`), so
the rename of the verdicts makes rows and marks visible together. A load that ends
early, in a task, in the driver or between the two renames, leaves nothing that a
reader sees; Warehouse.vacuum deletes what lies about.

    <path>/rows/load=<id>/part-*.parquet     <path>/marks/load=<id>/verdicts.parquet

The sink writes through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.operators.gating import stop_tolerance_value
from millrace.session import EngineConfig, activate

#: Rows of an application that a task holds before it gives them a file of their own.
HELD_ROWS = 20_000
VERDICTS = pa.schema(
    [("app_id", pa.int64()), ("total_reviews", pa.int64()), ("fetched", pa.int64()), ("max_seen", pa.int64()), ("complete", pa.bool_()), ("marked_at", pa.timestamp("us", tz="UTC"))]
)


def new_load_id() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def is_enough(total: int | None, fetched: int, config: EngineConfig) -> bool:
    return total is None or total - fetched <= stop_tolerance_value(total, config)


@dataclass
class Report(WriterCommitMessage):
    """What a task has written: file names, and (rows, latest update) per application."""

    files: list[str] = field(default_factory=list)
    fetched: dict[int, tuple[int, int]] = field(default_factory=dict)


class _Rows:
    """The files of one task. Rows of one application at a time; they are kept or dropped when the next one begins."""

    def __init__(self, fs: pf.FileSystem, folder: str, expected: dict[int, int | None], config: EngineConfig):
        self.fs, self.folder, self.expected, self.config = fs, folder, expected, config
        self.report = Report()
        self.shared: tuple[str, pq.ParquetWriter] | None = None
        self.app, self.held, self.own, self.n, self.seen = None, [], None, 0, 0

    def _new_file(self, schema: pa.Schema) -> tuple[str, pq.ParquetWriter]:
        name = f"part-{uuid.uuid4().hex}.parquet"
        return name, pq.ParquetWriter(f"{self.folder}/{name}", schema, filesystem=self.fs, compression="zstd")

    def add(self, app: int, rows: pa.RecordBatch, seen: int) -> None:
        if app != self.app:
            self.end()
            if app in self.report.fetched:
                raise ValueError(f"rows of application {app} aren't together")
            self.app = app
        self.held.append(rows)
        self.n, self.seen = self.n + rows.num_rows, max(self.seen, seen)
        if sum(b.num_rows for b in self.held) > HELD_ROWS:
            self.own = self.own or self._new_file(rows.schema)
            self._move(self.own[1])

    def _move(self, writer: pq.ParquetWriter) -> None:
        writer.write_table(pa.Table.from_batches(self.held))
        self.held = []

    def end(self) -> None:
        if self.app is None:
            return
        keep = is_enough(self.expected.get(self.app), self.n, self.config)
        self.report.fetched[self.app] = (self.n, self.seen)
        if self.own:
            if keep and self.held:
                self._move(self.own[1])
            self.own[1].close()
            if keep:
                self.report.files.append(self.own[0])
            else:
                self.fs.delete_file(f"{self.folder}/{self.own[0]}")
        elif keep:
            self.shared = self.shared or self._new_file(self.held[0].schema)
            self._move(self.shared[1])
        self.app, self.held, self.own, self.n, self.seen = None, [], None, 0, 0

    def close(self) -> Report:
        self.end()
        if self.shared:
            self.shared[1].close()
            self.report.files.append(self.shared[0])
        return self.report


class LoadWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.options, self.config = dict(options), EngineConfig.from_options(options)
        self.load, self.key, self.update = self.options["load"], self.options.get("key", "app_id"), self.options.get("update", "timestamp_updated")
        self.expected = {int(a): t if t is None else int(t) for a, t in json.loads(self.options["expected"])}

    def _place(self) -> tuple[pf.FileSystem, str]:
        return pf.FileSystem.from_uri(self.options["path"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Report:
        fs, root = self._place()
        folder = f"{root}/rows/_pending-{self.load}"
        fs.create_dir(folder, recursive=True)
        rows = _Rows(fs, folder, self.expected, self.config)
        for b in iterator:
            if not b.num_rows:
                continue
            apps = b.column(b.schema.get_field_index(self.key))
            seen = b.column(b.schema.get_field_index(self.update))
            ends = pc.run_end_encode(apps).run_ends.to_pylist()  # stretches of one application
            for lo, hi in zip([0, *ends[:-1]], ends, strict=True):
                rows.add(apps[lo].as_py(), b.slice(lo, hi - lo), pc.max(seen.slice(lo, hi - lo)).as_py() or 0)
        return rows.close()

    def commit(self, messages: list[Report | None]) -> None:
        """Publish the tasks' files, then the verdicts; an application in two tasks is an error."""
        fs, root = self._place()
        reports, fetched = [m for m in messages if m], {}
        for m in reports:
            for app, found in m.fetched.items():
                if app in fetched:
                    raise ValueError(f"rows of application {app} come from two tasks")
                fetched[app] = found
        files = {f for m in reports for f in m.files}
        pending = f"{root}/rows/_pending-{self.load}"
        for info in fs.get_file_info(pf.FileSelector(pending, allow_not_found=True)):
            if info.base_name not in files:  # of an attempt that was lost
                fs.delete_file(info.path)
        if files:
            fs.move(pending, f"{root}/rows/load={self.load}")
        elif fs.get_file_info(pending).type != pf.FileType.NotFound:
            fs.delete_dir(pending)
        at = datetime.fromtimestamp(int(self.options["marked_at"]) / 1e6, timezone.utc) if "marked_at" in self.options else datetime.now(timezone.utc)
        rows = []
        for app, total in sorted((dict.fromkeys(fetched) | self.expected).items()):
            n, seen = fetched.get(app, (0, 0))
            rows.append({"app_id": app, "total_reviews": total, "fetched": n, "max_seen": seen, "complete": is_enough(total, n, self.config), "marked_at": at})
        marks = f"{root}/marks/_pending-{self.load}"
        fs.create_dir(marks, recursive=True)
        pq.write_table(pa.Table.from_pylist(rows, VERDICTS), f"{marks}/verdicts.parquet", filesystem=fs)
        fs.move(marks, f"{root}/marks/load={self.load}")

    def abort(self, messages: list[Report | None]) -> None:
        fs, root = self._place()
        for path in (f"{root}/rows/_pending-{self.load}", f"{root}/rows/load={self.load}", f"{root}/marks/_pending-{self.load}"):
            if fs.get_file_info(path).type != pf.FileType.NotFound:
                fs.delete_dir(path)


class LoadSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "load_sink"

    def schema(self) -> T.StructType:
        raise NotImplementedError("a sink only")

    def writer(self, schema: T.StructType, overwrite: bool) -> LoadWriter:
        return LoadWriter(self.options)


def create_log(spark: SparkSession, path: str, rows: str, marks: str, schema: T.StructType) -> None:
    """Folders of a log that is new, and the views through which it is read: rows of loads that have ended, and marks of complete applications."""
    for kind, kind_schema in (("rows", schema), ("marks", T.StructType([T.StructField(f.name, _spark_type(f.type)) for f in VERDICTS]))):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}")
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            spark.createDataFrame([], kind_schema).write.parquet(f"{path}/{kind}/load=none")
    database = rows.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = ", ".join(f"`{f.name}` COMMENT '{f.metadata.get('comment', '')}'" for f in schema.fields)
    columns = ", ".join(f"r.`{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {rows} ({names}) COMMENT 'rows of loads that have ended' AS SELECT {columns} FROM parquet.`{path}/rows` r LEFT SEMI JOIN parquet.`{path}/marks` m ON r.load = m.load")
    spark.sql(f"CREATE OR REPLACE VIEW {marks} COMMENT 'applications loaded whole' AS SELECT app_id, max_seen, marked_at, load FROM parquet.`{path}/marks` WHERE complete")


def _spark_type(t: pa.DataType) -> T.DataType:
    return T.LongType() if pa.types.is_int64(t) else T.BooleanType() if pa.types.is_boolean(t) else T.TimestampType()


def write_load(rows: DataFrame, path: str, load: str, expected: list[tuple[int, int | None]], config: EngineConfig = EngineConfig(), marked_at: datetime | None = None) -> DataFrame:
    """Run a load; returns its verdicts. The rows of an application must come from one task, one after the other."""
    spark = activate(rows.sparkSession)
    spark.dataSource.register(LoadSink)
    options = config.as_options() | {"path": path, "load": load, "expected": json.dumps([list(e) for e in expected])}
    if marked_at:
        options["marked_at"] = str(int(marked_at.replace(tzinfo=marked_at.tzinfo or timezone.utc).timestamp() * 1e6))
    rows.write.format("load_sink").options(**options).mode("append").save()
    return spark.read.parquet(f"{path}/marks/load={load}")


def publish_stage(spark: SparkSession, stage: str, path: str, load: str, expected: list[tuple[int, int | None]], config: EngineConfig = EngineConfig(), marked_at: datetime | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Publish Parquet files that a stream has gathered in a folder as one load; returns its verdicts.

    Files move as they are if all applications are complete; else the rows of the
    complete ones are written anew. rows: what the folder holds, if it isn't Parquet alone.
    """
    rows = spark.read.parquet(stage) if rows is None else rows
    options = config.as_options() | {"path": path, "load": load, "expected": json.dumps([list(e) for e in expected])}
    if marked_at:
        options["marked_at"] = str(int(marked_at.replace(tzinfo=marked_at.tzinfo or timezone.utc).timestamp() * 1e6))
    writer = LoadWriter(options)
    counted = rows.groupBy(F.col(writer.key).alias("app")).agg(F.count(F.lit(1)).alias("n"), F.max(writer.update).alias("seen"))
    fetched = {r["app"]: (r["n"], r["seen"] or 0) for r in counted.collect()}  # a row per application of the load
    good = [a for a, (n, _) in fetched.items() if is_enough(writer.expected.get(a), n, config)]
    fs, root = writer._place()
    pending = f"{root}/rows/_pending-{load}"
    source = stage
    if 0 < len(good) < len(fetched):
        source = f"{path}/rows/_pending-{load}-part"
        rows.where(rows[writer.key].isin(good)).write.option("compression", "zstd").parquet(source)
    files = []
    if good:
        fs.create_dir(pending, recursive=True)
        _, folder = pf.FileSystem.from_uri(source)
        for info in fs.get_file_info(pf.FileSelector(folder, recursive=True)):
            if info.base_name.endswith(".parquet"):
                files.append(f"{uuid.uuid4().hex}.parquet")
                fs.move(info.path, f"{pending}/{files[-1]}")
        if source != stage:
            fs.delete_dir(folder)
    report = Report(files, fetched)
    try:
        writer.commit([report])
    except BaseException:
        writer.abort([report])
        raise
    return spark.read.parquet(f"{path}/marks/load={load}")
