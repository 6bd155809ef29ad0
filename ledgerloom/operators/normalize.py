"""First normal form, shared and local dimensions, re-keying."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.naming import dimension_name, string_columns
from ledgerloom.functions.text import type_label, without_type
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.ordering import rank_within
from ledgerloom.operators.quality import require_columns
from ledgerloom.sources.staging import stage

# The column whose values order by weekday instead of alphabet.
WEEKDAY_COLUMN = "WEEKDAY_APPR_PROCESS_START"
WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")
ATOMIC_COLUMN = "ORGANIZATION_TYPE"

MAPPING_SCHEMA = "column string, value string, id bigint"


def atomize(df: DataFrame, column: str = ATOMIC_COLUMN) -> DataFrame:
    """Split ``column`` into its text and a ``<column>_2`` type label; a no-op if done before."""
    second = f"{column}_2"
    if column not in df.columns or second in df.columns:
        return df
    return df.withColumns({second: type_label(F.col(column)), column: without_type(F.col(column))})


def load_mappings(spark: SparkSession, path: str) -> DataFrame:
    """(column, value, id) rows of a JSON list of ``{column: {value: id}}`` objects."""
    text = spark.read.text(path, wholetext=True)
    return flatten_mappings(text, "value")


def flatten_mappings(documents: DataFrame, json_column: str) -> DataFrame:
    """(column, value, id) rows of JSON documents, each a list of ``{column: {value: id}}``."""
    kind = T.ArrayType(T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType())))
    items = documents.select(F.explode(F.from_json(json_column, kind)).alias("item"))
    columns = items.select(F.explode("item").alias("column", "values"))
    return columns.select(
        F.upper("column").alias("column"), F.explode("values").alias("value", "id")
    )


def common_dimension(mappings: DataFrame, column: str) -> DataFrame:
    """Shared dimension (``X_ID``, ``X``) of one mapped column."""
    return mappings.where(F.col("column") == column).select(
        F.col("id").cast("bigint").alias(f"{column}_ID"), F.col("value").alias(column)
    )


def _encode(df: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` in place by ``<column>_ID`` through (value, id) pairs."""
    keyed = pairs.select(F.col("value").alias("__value"), F.col("id").alias("__id"))
    joined = lookup_join(df.withColumn("__value", F.col(column)), keyed, "__value", "left")
    return joined.select(
        *[
            F.col("__id").alias(f"{column}_ID") if c == column else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def encode(df: DataFrame, mappings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each of ``columns`` by its mapped id; values without an id become null."""
    def one(frame: DataFrame, column: str) -> DataFrame:
        return _encode(frame, mappings.where(F.col("column") == column), column)

    return reduce(one, [c for c in columns if c in df.columns], df)


def local_dimensions(
    df: DataFrame, columns: Sequence[str], order_by: Column | str
) -> DataFrame:
    """(column, value, id) rows: ids 1..n in the order in which values first appear.

    First appearance is the smallest ``order_by`` of a value, ties by value. All columns
    share one pass over the fact; only distinct values are ranked. The result is
    staged, so later encodings see its true size.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], MAPPING_SCHEMA)
    position = order_by if isinstance(order_by, Column) else F.col(order_by)
    cells = df.select(position.alias("__at"), *[F.col(f"`{c}`") for c in columns])
    first = (
        cells.unpivot(["__at"], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.min("__at").alias("__at"))
    )
    ranked = rank_within(first, ["column"], [F.col("__at"), F.col("value")], "id", True)
    return stage(ranked.select("column", "value", "id"), "dimensions")


def normalize_table(
    df: DataFrame,
    order_by: Column | str,
    mappings: DataFrame | None = None,
    mapped_columns: Sequence[str] = (),
    atomic_column: str = ATOMIC_COLUMN,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact table and its local dimensions.

    Mapped columns get their shared ids; every other text column with a non-null value
    gets a local dimension; all-null columns stay as they are. Floating columns that hold
    whole numbers only become nullable bigint.
    """
    if isinstance(order_by, str):
        require_columns(df, [order_by], "row order")
    position = order_by if isinstance(order_by, Column) else F.col(order_by)
    df = to_nullable_integers(atomize(df, atomic_column).withColumn("__pos", position))
    shared = [c for c in mapped_columns if c in df.columns]
    if mappings is not None and shared:
        df = encode(df, mappings, shared)
    else:
        shared = []
    local = [c for c in string_columns(df.schema) if c not in (*shared, "__pos")]
    dims = local_dimensions(df, local, "__pos")
    sizes = {r["column"]: r["n"] for r in dims.groupBy("column").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    present = [c for c in local if c in sizes]
    fact = encode(df, dims, present).drop("__pos")
    return fact, {dimension_name(c): common_dimension(dims, c) for c in present}


def normalize_tables(
    tables: Mapping[str, tuple[DataFrame, Column | str]],
    mappings: DataFrame,
    excluded: Sequence[str] = (),
) -> tuple[dict[str, tuple[DataFrame, dict[str, DataFrame]]], dict[str, str]]:
    """Normalise every table; a failing one is reported and does not stop the others."""
    mapped = [r["column"] for r in mappings.select("column").distinct().toLocalIterator()]
    done: dict[str, tuple[DataFrame, dict[str, DataFrame]]] = {}
    errors: dict[str, str] = {}
    for name, (df, order_by) in tables.items():
        if name in excluded:
            continue
        try:
            done[name] = normalize_table(df, order_by, mappings, mapped)
        except Exception as error:  # noqa: BLE001 - isolation of one table is the feature
            errors[name] = str(error)
    return done, errors


def consolidated_domain(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct non-null values of ``column`` over all frames that have it."""
    parts = [f.select(F.col(column).cast("string").alias("value")).distinct()
             for f in frames if column in f.columns]
    return reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull()).distinct()


def domain_order(column: str) -> list[Column]:
    """Alphabetical, except weekdays, which run Monday to Sunday with unknown values last."""
    if column.upper() != WEEKDAY_COLUMN:
        return [F.col("value")]
    day = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("value"))
    return [F.when(day == 0, F.lit(999)).otherwise(day), F.col("value")]


def generate_mapping(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """(column, value, id): ids are 1-based ranks in domain order."""
    domain = consolidated_domain(frames, column).withColumn("column", F.lit(column.upper()))
    ranked = rank_within(domain, ["column"], domain_order(column), "id", unique_order=True)
    return ranked.select("column", "value", "id")


def mapping_documents(mappings: DataFrame) -> DataFrame:
    """JSON documents ``[{column: {value: id}}]``, one per value, so none grows with a domain."""
    entry = F.create_map(F.lower("column"), F.create_map(F.col("value"), F.col("id")))
    return mappings.select(F.to_json(F.array(entry)).alias("document"))


def rekey(df: DataFrame, column: str, equivalence: DataFrame) -> DataFrame:
    """Replace ids through (old, new) pairs; ids without a pair keep their value."""
    pairs = equivalence.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    joined = lookup_join(df.withColumn("__old", F.col(column)), pairs, "__old", "left")
    return joined.select(
        *[
            F.coalesce(F.col("__new"), F.col(c)).alias(c) if c == column else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def dimension_overlap(dims: DataFrame) -> DataFrame:
    """(dimension, tables) of dimension names found under more than one table."""
    found = dims.select("dimension", "table").distinct().groupBy("dimension").agg(
        F.sort_array(F.collect_set("table")).alias("tables")
    )
    return found.where(F.size("tables") > 1)


def integral_columns(df: DataFrame) -> list[str]:
    """Floating columns with a non-null value and whole numbers only: one aggregate."""
    floating = [c for c, t in df.dtypes if t in ("float", "double")]
    if not floating:
        return []
    row = integral_flags(df, floating).first()
    return [c for i, c in enumerate(floating) if row[f"f{i}"]]


def integral_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of booleans ``f0, f1, …``: whether a column holds whole numbers only."""
    def flag(c: str) -> Column:
        value = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
        return F.coalesce(F.min(value == F.floor(value)), F.lit(False))

    return df.agg(*[flag(c).alias(f"f{i}") for i, c in enumerate(columns)])


def to_nullable_integers(df: DataFrame) -> DataFrame:
    """Whole-number floating columns cast to nullable bigint."""
    whole = integral_columns(df)
    return df.withColumns(
        {c: F.nanvl(F.col(c), F.lit(None).cast("double")).cast("bigint") for c in whole}
    ) if whole else df


def value_listing(df: DataFrame) -> DataFrame:
    """(column, value, n) of text columns and of numeric columns with whole numbers only."""
    floating = [c for c, t in df.dtypes if t in ("float", "double")]
    whole = set(integral_columns(df))
    wanted = [
        c for c, t in df.dtypes
        if t in ("string", "tinyint", "smallint", "int", "bigint") or (c in floating and c in whole)
    ]
    cells = df.select(
        *[
            (F.col(c).cast("bigint") if c in floating else F.col(c)).cast("string").alias(c)
            for c in wanted
        ]
    )
    long = cells.unpivot([], wanted, "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, column: str, drop_nulls: bool = True) -> DataFrame:
    """(value, n) frequencies of one column."""
    rows = df.where(F.col(column).isNotNull()) if drop_nulls else df
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


