"""Staging tables into dictionaries, sorted storage tables and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.naming import DICTIONARY_PREFIX, DIMENSION_PREFIX, REPORT_PREFIX, ROW_ID, storage_keys
from ledgerloom.operators.lookup import dictionary, report
from ledgerloom.operators.ordering import row_ids
from ledgerloom.sources.staging import stage
from ledgerloom.sources.tables import write_table


def build_dictionaries(dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``dict_dim_x`` per ``dim_x``: key column first, one row per key."""
    return {
        DICTIONARY_PREFIX + name.removeprefix(DIMENSION_PREFIX): dictionary(dim)
        for name, dim in dims.items() if name.startswith(DIMENSION_PREFIX)
    }


def storage_layout(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Range partitioned and sorted by the storage key, null keys first.

    The row id, or else a hash of the row and of the task that held it, follows the key, so that a hot key is cut
    over several partitions, and rows that are alike too.
    """
    keys = list(keys or storage_keys(df.columns))
    order = [F.col(k).asc_nulls_first() for k in keys]
    if ROW_ID in df.columns:
        return df.repartitionByRange(*order, ROW_ID).sortWithinPartitions(*order, ROW_ID)
    marked = df.withColumn("__spread", F.xxhash64(F.spark_partition_id(), *df.columns))
    return marked.repartitionByRange(*order, "__spread").sortWithinPartitions(*order, "__spread").drop("__spread")


def with_row_id(df: DataFrame) -> DataFrame:
    """Prepend a contiguous 0-based ``_DW_ID``; rows are not shuffled for it."""
    return row_ids(df, ROW_ID)


def build_warehouse(
    spark: SparkSession,
    staging: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    root: str,
    keyless: Sequence[str] = (),
    default: str | None = None,
) -> dict[str, DataFrame]:
    """Write storage and report tables below ``root`` and return scans of all of them.

    Tables are overwritten: loading again gives the same warehouse instead of repeated rows.
    """
    dictionaries = {name: stage(df, name) for name, df in build_dictionaries(dims).items()}
    tables: dict[str, DataFrame] = {}
    for name, df in staging.items():
        rows = with_row_id(df) if name in keyless else df
        # the row id is technical: the sort key is chosen from the source columns
        stored = storage_layout(rows, storage_keys(df.columns))
        path = f"{root}/{name}.parquet"
        write_table(stored, path)
        tables[name] = spark.read.schema(stored.schema).parquet(path)
        rows = report(tables[name], dictionaries, default)
        path = f"{root}/{REPORT_PREFIX}{name}.parquet"
        write_table(rows, path)
        tables[REPORT_PREFIX + name] = spark.read.schema(rows.schema).parquet(path)
    return tables
