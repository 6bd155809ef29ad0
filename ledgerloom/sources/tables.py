"""Table scans and sinks over Parquet, CSV and JDBC."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.naming import REPORT_PREFIX
from ledgerloom.functions.text import null_token_to_null
from ledgerloom.operators.joins import semi_join
from ledgerloom.operators.ordering import first_rows

# Tokens read as missing by the usual CSV readers (compared exactly).
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema; missing-value tokens become null.

    Columns are read as text, folded, then cast, so a token in a number column is null
    and not an error.
    """
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in target])
    raw = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .schema(as_text).csv(path)
    )
    cells = {
        f.name: F.when(~F.col(f"`{f.name}`").isin(*CSV_NULL_TOKENS), F.col(f"`{f.name}`"))
        for f in target
    }
    return raw.select(*[cells[f.name].try_cast(f.dataType).alias(f.name) for f in target])


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV or Parquet table without reading its rows."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.option("header", True).csv(path).limit(0).columns
    return spark.read.parquet(path).columns


def file_catalog(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(table, path, files, bytes) of the tables below ``root``, listed by the executors.

    A table is a file or a folder of files: its name is the first part of the path below ``root`` that
    ends like the pattern. Hidden files and folders are no tables.
    """
    suffix = pattern.rpartition("*")[2]
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load(root).select("path", "length")
    )
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toUri().getPath().rstrip("/")
    below = F.element_at(F.split("path", re.escape(top + "/"), 2), 2)
    named = files.select(
        F.regexp_extract(below, rf"^((?:[^/]*/)*?[^/]*{re.escape(suffix)})(?:/|$)", 1).alias("name"), below.alias("below"), "path", "length"
    ).where((F.col("name") != "") & ~F.col("below").rlike(r"(^|/)[._][^/]*(/|$)"))
    stem = F.regexp_replace(F.element_at(F.split("name", "/"), -1), r"\.[^.]*$", "")
    whole = F.concat(F.left("path", F.length("path") - F.length("below")), F.col("name"))
    return named.groupBy(F.lower(stem).alias("table"), whole.alias("path")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that holds it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def resolve_table(spark: SparkSession, root: str, table: str) -> str:
    """Path of ``<table>.parquet``, else of its report table; error if neither exists."""
    stem = table.rsplit("/", 1)[-1].removesuffix(".parquet")
    names = [stem] if stem.startswith(REPORT_PREFIX) else [stem, REPORT_PREFIX + stem]
    for name in names:
        path = f"{root.rstrip('/')}/{name}.parquet"
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"no Parquet table for `{table}` in {root}")


def scoped(
    df: DataFrame,
    entity_ids: DataFrame | None = None,
    entity_key: str | None = None,
    limit: int | None = None,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Rows of the given entities; an empty id table gives no rows, None gives all.

    ``limit=None`` means all rows and 0 means none. A limit without an order picks any rows.
    """
    if entity_ids is not None and entity_key is not None:
        df = semi_join(df, entity_ids, entity_key)
    if limit is not None:
        df = first_rows(df, order_by, limit) if order_by else df.limit(limit)
    return df


def scan_table(
    spark: SparkSession,
    root: str,
    table: str,
    columns: Sequence[str] | None = None,
    entity_ids: DataFrame | None = None,
    entity_key: str | None = None,
    limit: int | None = None,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Parquet table by name or report alias; column selection and semi join reach the scan."""
    df = spark.read.parquet(resolve_table(spark, root, table))
    df = scoped(df, entity_ids, entity_key, limit, order_by)
    return df.select(*columns) if columns else df


def scan_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    partition_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1,
) -> DataFrame:
    """Relational table read in parallel ranges of ``partition_column``."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties or {},
    )


def table_selection(catalog: DataFrame, requested: DataFrame) -> DataFrame:
    """(table, status): requested names that are found or missing; all found if none asked.

    Names are compared without folder and extension.
    """
    name = F.regexp_replace(F.element_at(F.split(F.col("table"), "/"), -1), r"\.parquet$", "")
    wanted = requested.select(name.alias("table")).distinct()
    known = catalog.select("table").distinct().withColumn("known", F.lit(True))
    if wanted.isEmpty():
        return known.select("table", F.lit("found").alias("status"))
    joined = wanted.join(known, "table", "left")
    return joined.select(
        "table", F.when(F.col("known"), F.lit("found")).otherwise(F.lit("missing")).alias("status")
    )


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Null for missing-value tokens in text columns and for NaN in floating columns."""
    def clean(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "string":
            return null_token_to_null(c).alias(name)
        if kind in ("double", "float"):
            return F.nanvl(c, F.lit(None).cast(kind)).alias(name)
        return c

    return df.select(*[clean(n, k) for n, k in df.dtypes])


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
) -> None:
    """Parquet sink: ``overwrite`` replaces the table, ``append`` adds to it.

    A table is replaced by a folder that is written in full beside it, so the rows may be read from the table
    itself, and a failure while they are written leaves it as it was. Where readers and writers
    work at once, use ``versions.VersionedTable``.
    """
    spark, target = df.sparkSession, path.rstrip("/")
    replaces = mode == "overwrite" and exists(spark, target)
    parent, _, name = target.rpartition("/")
    aside = f"{parent}/.{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists" if replaces else mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{aside}.new" if replaces else target)
    if replaces:
        place, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, f"{aside}.new", f"{aside}.old"))
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not (fs.rename(place, old) and fs.rename(new, place)):
            raise OSError(f"{target} was not replaced; its rows are in {aside}.old, the new ones in {aside}.new")
        fs.delete(old, True)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "overwrite",
    properties: dict[str, str] | None = None, batch_size: int = 1000,
) -> None:
    """Relational sink with batched inserts."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode=mode, properties=properties or {})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_metrics(row: DataFrame, path: str) -> None:
    """A one-row frame of metrics as one JSON document."""
    row.coalesce(1).write.mode("overwrite").json(path)


def snapshot_tables(tables: dict[str, DataFrame], root: str, name: str, stamp: str) -> str:
    """Write every table below ``<root>/<name>_<stamp>`` and return that folder."""
    folder = f"{root.rstrip('/')}/{name}_{stamp}"
    for table, df in tables.items():
        write_table(df, f"{folder}/{table}.parquet", "errorifexists")
    return folder


def restore_tables(spark: SparkSession, folder: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    """Tables of a snapshot folder."""
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in tables}
