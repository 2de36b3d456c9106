"""Tables that a plan writes on its way: the folder that driver and executors share, stored tables, their removal."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_FOLDERS: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the one given to setCheckpointDir.

    Where neither is set, a local session uses one temporary folder for its life; on a
    cluster that is an error, as other machines would not see it. The setting itself
    is static and never changed.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = given.get() if given.isDefined() else _LOCAL.get(spark.sparkContext.applicationId)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path for a table of this application. What results still read is deleted when the driver's Python ends."""
    folder = f"{shared_dir(spark)}/millrace-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_delete_at_exit, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        delete(spark, folder)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage is cut and a lost executor costs nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later plan reads."""
    for t in tables:
        delete(t.sparkSession, t.stored_at)
