"""Raw tables into facts, shared dimensions and local dimensions on disk."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ledgerloom.functions.naming import dimension_name
from ledgerloom.operators.normalize import common_dimension, flatten_mappings, normalize_tables
from ledgerloom.plans.config import SHARED_MAPPINGS
from ledgerloom.sources.tables import write_table


def shared_mappings(spark: SparkSession, items: Sequence[dict] = SHARED_MAPPINGS) -> DataFrame:
    """The shared mappings as (column, value, id) rows."""
    return flatten_mappings(spark.createDataFrame([(json.dumps(items),)], "document string"), "document")


def normalize_to(
    spark: SparkSession,
    tables: Mapping[str, tuple[DataFrame, Column | str]],
    mappings: DataFrame,
    root: str,
    excluded: Sequence[str] = ("application_test",),
) -> tuple[list[str], dict[str, str]]:
    """Write ``<table>/<table>.parquet``, its dimensions, and ``common_dims``.

    Returns the written paths and the errors of tables that failed.
    """
    done, errors = normalize_tables(tables, mappings, excluded)
    written = []
    for row in mappings.select("column").distinct().toLocalIterator():
        column = row["column"]
        path = f"{root}/common_dims/{dimension_name(column)}.parquet"
        write_table(common_dimension(mappings, column), path)
        written.append(path)
    for name, (fact, dims) in done.items():
        for part, df in {name: fact, **dims}.items():
            path = f"{root}/{name}/{part}.parquet"
            write_table(df, path)
            written.append(path)
    return written, errors
