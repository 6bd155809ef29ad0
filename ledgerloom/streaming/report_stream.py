"""Report table kept current by new storage rows, exactly once.

The report is a versioned table whose commits name the storage files that they hold. Whoever brings a
file, a refresh, a stream or a stream with a new checkpoint, and however often: its rows are in the report once,
for rows and file name are one commit. Rows are joined to the dimensions as they are at that moment.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.lookup import report
from ledgerloom.sources.versions import VersionedTable, files_of, open_rows

FILE = "__file"


def storage_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Rows of Parquet files as they arrive in the storage folder, with the file that holds them."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).select("*", F.col("_metadata.file_path").alias(FILE))


def maintain_report(
    stream: DataFrame,
    dictionaries: Callable[[], Mapping[str, DataFrame]],
    output: str,
    checkpoint: str,
    default: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; existing report rows are never rewritten.

    ``dictionaries`` is called per micro-batch and returns the current lookup tables. Files that the report holds
    already, from an earlier stream, checkpoint or refresh, are passed over.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, output)
        # names of one micro-batch's files
        uris = {urlparse(r[0]).path: r[0] for r in batch.select(FILE).distinct().collect()}
        while fresh := uris.keys() - table.inputs():
            rows = batch.where(F.col(FILE).isin([uris[f] for f in fresh])).drop(FILE)
            if table.append(report(rows, dictionaries(), default), sorted(fresh)) is not None:
                return

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def refresh_report(
    spark: SparkSession, storage: str, output: str, dictionaries: Callable[[], Mapping[str, DataFrame]] = dict,
    default: str | None = None,
) -> int:
    """Add the rows of all storage files that the report does not hold; returns the number of files."""
    table = VersionedTable(spark, output)
    while True:
        fresh = sorted(set(files_of(spark, storage)) - table.inputs())
        if not fresh:
            return 0
        schema = open_rows(spark, storage).schema
        rows = spark.read.schema(schema).parquet(*[_qualified(spark, storage, f) for f in fresh])
        if table.append(report(rows, dictionaries(), default), fresh) is not None:
            return len(fresh)


def _qualified(spark: SparkSession, storage: str, path: str) -> str:
    """A path on the file system that holds the storage."""
    root = urlparse(storage)
    return f"{root.scheme}://{root.netloc}{path}" if root.scheme else path


def read_report(spark: SparkSession, output: str) -> DataFrame:
    """All report rows written so far."""
    return VersionedTable(spark, output).read()
