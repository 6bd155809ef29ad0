"""Column catalogs of a set of tables and the reports over them.

A catalog row describes one column: table, position, name, type and, measured on the
data, rows, non-null count and distinct count.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.naming import DIMENSION_PREFIX
from ledgerloom.operators.metrics import one_row
from ledgerloom.operators.ordering import first_n_per_group


def schema_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable) from the schemas alone."""
    rows = [
        (name, i + 1, field.name, field.dataType.simpleString(), field.nullable)
        for name, df in tables.items()
        for i, field in enumerate(df.schema)
    ]
    return spark.createDataFrame(
        rows, "table string, position int, column string, type string, nullable boolean"
    )


def cells(df: DataFrame) -> DataFrame:
    """(column, value text) of every cell; whole tables in one pass, nulls kept."""
    columns = df.columns
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot([], columns, "column", "value")


def measured_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schema catalog with ``rows``, ``non_null`` and ``min_text`` measured on the data."""
    measured = []
    for name, df in tables.items():
        stats = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
        )
        pairs = F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null"))
                  for i, c in enumerate(df.columns)]
            )
        )
        measured.append(
            stats.select("rows", pairs.alias("s")).select(
                F.lit(name).alias("table"), "s.column", "rows", "s.non_null"
            )
        )
    return schema_catalog(spark, tables).join(
        reduce(DataFrame.unionByName, measured), ["table", "column"]
    )


def table_groups(catalog: DataFrame, mapped: DataFrame, excluded: Collection[str] = ()) -> DataFrame:
    """(table, group): ``mapped`` if a table has a column with a shared mapping, else ``unmapped``."""
    tables = catalog.select("table", F.upper("column").alias("column"))
    if excluded:
        tables = tables.where(~F.col("table").isin(*excluded))
    known = mapped.select(F.upper("column").alias("column"), F.lit(True).alias("hit")).distinct()
    marked = tables.join(known, "column", "left").groupBy("table").agg(F.count("hit").alias("hits"))
    group = F.when(F.col("hits") > 0, "mapped").otherwise("unmapped")
    return marked.select("table", group.alias("group"))


def shared_columns(catalog: DataFrame, minimum: int = 2) -> DataFrame:
    """(column, tables, n_tables) of text columns found in several tables.

    The type is that of the first table by name; numbers shared by tables do not count.
    """
    grouped = catalog.groupBy("column").agg(
        F.sort_array(F.collect_set("table")).alias("tables"),
        F.min_by("type", "table").alias("first_type"),
    )
    kept = grouped.where((F.size("tables") >= minimum) & (F.col("first_type") == "string"))
    return kept.select("column", "tables", F.size("tables").alias("n_tables"))


def shared_column_report(
    catalog: DataFrame, tables: Mapping[str, DataFrame], samples: int = 10
) -> DataFrame:
    """Per table and shared column: type, the smallest ``samples`` values, the other tables."""
    holders = catalog.groupBy("column").agg(F.sort_array(F.collect_set("table")).alias("holders"))
    others = F.array_remove(F.col("holders"), F.col("table"))
    report = (
        catalog.join(holders.where(F.size("holders") > 1), "column")
        .select("table", "column", "type", others.alias("other_tables"))
    )
    values = reduce(
        DataFrame.unionByName,
        [cells(df).withColumn("table", F.lit(name)) for name, df in tables.items()],
    )
    # one row per column of the tables: bounded by their schemas
    shared = F.broadcast(report.select("table", "column"))
    distinct = values.where(F.col("value").isNotNull()).join(shared, ["table", "column"]).distinct()
    firsts = first_n_per_group(distinct, ["table", "column"], ["value"], samples)
    sampled = firsts.groupBy("table", "column").agg(
        F.sort_array(F.collect_list("value")).alias("sample_values")
    )
    return report.join(sampled, ["table", "column"], "left")


def type_inventory(catalog: DataFrame) -> DataFrame:
    """Catalog with flag 1 where a column named like an id is not a bigint."""
    odd = F.col("column").contains("ID") & (F.col("type") != "bigint")
    return catalog.withColumn("odd_id_type", odd.cast("int"))


def key_metadata(catalog: DataFrame) -> DataFrame:
    """(table, pk, fk): key columns by naming rule, in column order.

    A dimension's key is every column with ``ID`` in its name, a fact's every column with
    ``SK`` and ``ID``; a fact's foreign keys are its other columns named like a
    dimension key.
    """
    is_dim = F.col("table").startswith(DIMENSION_PREFIX)
    has_id = F.col("column").contains("ID")
    is_key = has_id & (is_dim | F.col("column").contains("SK"))
    dim_keys = catalog.where(is_dim & has_id).select(
        F.col("column"), F.lit(True).alias("dim_key")
    ).distinct()
    marked = catalog.withColumn("pk_part", is_key).join(dim_keys, "column", "left")
    fk_part = F.col("dim_key").isNotNull() & ~F.col("pk_part") & ~is_dim
    # a table has few columns: the lists are bounded by the schema
    def listed(flag):
        entry = F.when(flag, F.struct("position", "column"))
        return F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["column"])

    return marked.groupBy("table").agg(listed(F.col("pk_part")).alias("pk"), listed(fk_part).alias("fk"))


def constraint_kind(catalog: DataFrame) -> DataFrame:
    """``kind`` by precedence from ``key`` (PRI, UNI, MUL) and ``referenced_table``."""
    kind = (
        F.when(F.col("key") == "PRI", "PRIMARY KEY")
        .when(F.col("referenced_table").isNotNull(), "FOREIGN KEY")
        .when(F.col("key") == "UNI", "UNIQUE INDEX")
        .when(F.col("key") == "MUL", "INDEX (Non-Unique)")
        .otherwise("NONE")
    )
    return catalog.withColumn("kind", kind)


def key_candidates(catalog: DataFrame) -> DataFrame:
    """Columns whose name holds ``ID``, with the DDL text that would declare the key.

    ``_`` is escaped where the rule means a real underscore.
    """
    rows = catalog.where(F.col("column").like("%ID%"))
    is_fk = F.col("column").like(r"%\_ID") & ~F.col("table").like(r"dim\_%")
    base = F.lower(F.expr("left(column, length(column) - 3)"))
    ddl = F.when(
        is_fk,
        F.concat(
            F.lit("FOREIGN KEY ("), "column", F.lit(") REFERENCES dim_"), base,
            F.lit("("), "column", F.lit(")"),
        ),
    ).otherwise(F.concat(F.lit("PRIMARY KEY ("), "column", F.lit(")")))
    return rows.select("table", "column", ddl.alias("ddl"))


def schema_report(columns: DataFrame, key_usage: DataFrame, statistics: DataFrame) -> DataFrame:
    """Columns with their key usage and statistics, joined on (table, column)."""
    on = ["table", "column"]
    return columns.join(key_usage, on, "left").join(statistics, on, "left")


def name_sets(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """(name, side): names found in both inputs or in one of them."""
    a = left.select(name).distinct().withColumn("l", F.lit(1))
    b = right.select(name).distinct().withColumn("r", F.lit(1))
    joined = a.join(b, name, "full")
    side = F.when(F.col("l").isNull(), "right").when(F.col("r").isNull(), "left").otherwise("both")
    return joined.select(name, side.alias("side"))


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, columns) per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def storage_footprint(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, files, bytes, megabytes) from the files a scan reads; files without rows count too."""
    parts = []
    for name, df in tables.items():
        rows = df.agg(F.count(F.lit(1)).alias("rows"))
        files = df.inputFiles()
        if files:
            # the listing reads names and lengths, never the content
            sizes = df.sparkSession.read.format("binaryFile").load(files).agg(
                F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
            )
        else:
            sizes = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("files"), F.lit(0).cast("bigint").alias("bytes"))
        # two frames of one row each
        parts.append(one_row(rows, sizes).select(
            F.lit(name).alias("table"), "rows", "files", "bytes",
            F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 6).alias("megabytes"),
        ))
    return reduce(DataFrame.unionByName, parts)


def drop_columns(df: DataFrame, common: Collection[str], own: Collection[str] = ()) -> DataFrame:
    """Without the columns excluded for all tables or for this one."""
    return df.drop(*{*common, *own})
