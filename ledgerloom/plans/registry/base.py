"""Registration and the roles that the test tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say it, the statement that must agree with it."""
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def fixed(column: Column, digits: int = 4) -> Column:
    """Number cut to ``digits``, off the half-way points where engines round apart."""
    scale = float(10**digits)
    return F.floor(column.cast("double") * F.lit(scale) + F.lit(0.501)) / F.lit(scale)


def fixed_sql(expression: str, digits: int = 4) -> str:
    """The SQL form of ``fixed``."""
    scale = f"{10**digits}::DOUBLE"
    return f"(floor(({expression})::DOUBLE * {scale} + 0.501::DOUBLE) / {scale})"


# Roles. Amounts are whole cents in the child tables, so that sums are exact in every engine.


def applications(spark: SparkSession, root: str) -> DataFrame:
    """Entity table: customers with a target."""
    c = table(spark, root, "customer")
    return c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        "c_nationkey", "c_acctbal", "c_mktsegment",
    )


def credits(spark: SparkSession, root: str) -> DataFrame:
    """Bridge table: orders of a customer."""
    o = table(spark, root, "orders")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("CENTS"),
        F.col("o_orderstatus").alias("STATUS"),
        # a priority that is missing exercises the rules for null
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("PRIORITY"),
    )


def balances(spark: SparkSession, root: str) -> DataFrame:
    """Child of the bridge: lines of an order."""
    li = table(spark, root, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        F.col("l_quantity").cast("bigint").alias("QUANTITY"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("FLAG"),
    )


APPLICATIONS_SQL = """(SELECT c_custkey AS "SK_ID_CURR", (c_acctbal < 0)::INTEGER AS "TARGET",
 c_nationkey, c_acctbal, c_mktsegment FROM customer)"""
CREDITS_SQL = """(SELECT o_custkey AS "SK_ID_CURR", o_orderkey AS "SK_ID_BUREAU",
 round(o_totalprice * 100)::BIGINT AS "CENTS", o_orderstatus AS "STATUS",
 nullif(o_orderpriority, '3-MEDIUM') AS "PRIORITY" FROM orders)"""
BALANCES_SQL = """(SELECT l_orderkey AS "SK_ID_BUREAU", l_quantity::BIGINT AS "QUANTITY",
 nullif(l_returnflag, 'N') AS "FLAG" FROM lineitem)"""


def stats_sql(column: str, prefix: str, name: str, floating: bool = False, final: bool = True) -> str:
    """SQL of the five statistics of one numeric column."""
    def cut(expression: str) -> str:
        return fixed_sql(expression) if final else f"({expression})::DOUBLE"

    def same(expression: str) -> str:
        return cut(expression) if floating else expression

    total = f"coalesce(sum({column}), 0)"
    return f"""{cut(f'avg({column})')} AS {prefix}__{name}__mean,
 {same(f'min({column})')} AS {prefix}__{name}__min, {same(f'max({column})')} AS {prefix}__{name}__max,
 {cut(total) if floating else f'{total}::BIGINT'} AS {prefix}__{name}__sum,
 {cut(f'stddev_samp({column})')} AS {prefix}__{name}__std"""


def nunique_sql(column: str, prefix: str, name: str) -> str:
    """SQL of a distinct count in which null is a value."""
    return (
        f"(count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END))::BIGINT"
        f" AS {prefix}__{name}__nunique"
    )


def cut_statistics(df: DataFrame) -> DataFrame:
    """Floating statistics cut for comparison; all other columns as they are."""
    kinds = dict(df.dtypes)
    cut = "floor(`{0}` * 10000D + 0.501D) / 10000D AS `{0}`"
    return df.selectExpr(
        *[cut.format(c) if "__" in c and kinds[c] == "double" else f"`{c}`" for c in df.columns]
    )
