"""Staged tables: cut lineage by writing Parquet to the cluster's shared checkpoint folder.

A staged table has true file statistics, so the joins after it are planned on real
sizes, its values never change when a lost executor's work is redone, and only
the columns that are read later come back from disk.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Columns of a row beyond which its operators are compiled apart.
FEW_FIELDS = 50
_FIELDS = "spark.sql.codegen.maxFields"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_before: dict[str, list[str]] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a temporary folder.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="ledgerloom-staging-")
        spark.conf.set(_SETTING, root)
    return f"{root.rstrip('/')}/ledgerloom/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the staging root."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of the written table; the shuffle files of the write are removed at its end."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    with _setting(spark, _REMOVED, "true"):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's own value comes back when the last of several threads leaves."""
    with _lock:
        before = _before.setdefault(name, [])
        before.append(spark.conf.get(name))
        if len(before) == 1:
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            # the first entry is the session's own value, whichever thread leaves last
            before.pop() if len(before) > 1 else spark.conf.set(name, before.pop())


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Plans within are for rows of many columns: one method over all of them would be interpreted for seconds in each stage."""
    with _setting(spark, _FIELDS, str(min(FEW_FIELDS, int(spark.conf.get(_FIELDS))))):
        yield


@contextmanager
def wide_cells(spark: SparkSession) -> Iterator[None]:
    """Tables staged within have rows of some MB: a batch of the usual size of them is held several times over, by Spark and by Python."""
    with _setting(spark, _BATCH, str(4 << 20)):
        yield


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark, root = df.sparkSession, staging_root(df.sparkSession)
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        top = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)).toUri().getPath()
        if not place.toUri().getPath().startswith(f"{top}/"):
            raise ValueError(f"{folder} is no staged table")
        fs.delete(place, True)
