"""Backup, delete and restore of the latest rows of a stored table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import first_n, id_range, top_n, without_top_n
from ledgerloom.sources.staging import stage
from ledgerloom.sources.tables import write_table
from ledgerloom.sources.versions import VersionedTable, append_rows, is_versioned, open_rows


def backup_rows(df: DataFrame, column: str, n: int, path: str) -> Row:
    """Write the ``n`` rows with the largest ``column``, ascending; returns count and range.

    No row at all is an error, fewer than ``n`` a warning.
    """
    rows = stage(top_n(df, column, n), "backup")
    found = id_range(rows, column).first()
    if found["rows"] == 0:
        raise ValueError("there is no row to back up")
    if found["rows"] < n:
        warnings.warn(f"asked for {n} rows, found {found['rows']}", stacklevel=2)
    write_table(rows.orderBy(column), path)
    return found


def delete_rows(spark: SparkSession, table: str, column: str, n: int) -> Row:
    """Remove the table's ``n`` rows with the largest ``column``; returns count and range of the rows removed.

    Of a versioned table only files that hold such rows are rewritten, and older versions stay readable. The rows
    that stay of a plain table are staged in full before its folder is replaced.
    """
    if not is_versioned(spark, table):
        df = spark.read.parquet(table)
        removed = id_range(top_n(df, column, n), column).first()
        write_table(stage(without_top_n(df, column, n), "kept"), table, "overwrite")
        return removed
    versions = VersionedTable(spark, table)
    c = F.col(column)
    removed = top_n(versions.read(), column, n).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("min_id"), F.max(column).alias("max_id"), F.count_if(c.isNull()).alias("nulls")
    ).first()
    if removed["rows"]:
        # nulls are last: a top that reaches them holds all other rows
        affected = F.lit(True) if removed["nulls"] else c >= F.lit(removed["min_id"])
        versions.rewrite(affected, lambda rows: without_top_n(rows, column, n))
    return Row(rows=removed["rows"], min_id=removed["min_id"], max_id=removed["max_id"])


def restore_rows(spark: SparkSession, backup: str, table: str, order_by: Sequence[str], n: int) -> Row:
    """Append the first ``n`` rows of a backup in key order; returns count and range."""
    rows = stage(first_n(open_rows(spark, backup), order_by, n), "restored")
    found = id_range(rows, order_by[0]).first()
    append_rows(rows, table)
    return found
