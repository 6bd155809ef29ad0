"""Profiles, correlations and samples."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ledgerloom.operators.profile import (
    _summed_correlations,
    column_profile,
    correlation_matrix,
    describe_numeric,
    low_variance,
    profile_tables,
    reproducible_sample,
    running_sample,
    target_correlation,
    throughput,
)
from ledgerloom.operators.profile_state import profile_of, refresh_profile
from ledgerloom.plans.registry.base import APPLICATIONS_SQL, applications, fixed, fixed_sql, query, table
from ledgerloom.sources.catalog import storage_footprint, table_summary
from ledgerloom.sources.staging import stage, staging_path
from ledgerloom.sources.tables import write_table

_ORDERS = """(SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice, o_orderdate FROM orders)"""


def _orders(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice", "o_orderdate"
    )


def _profile_sql(source: str, columns: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT {extra}'{c}' AS "column", '{t}' AS type, count(*) - count({c}) AS null_count,
 round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS null_pct, count(DISTINCT {c}) AS distinct_values
 FROM {source}""" for c, t in columns.items()
    )


@query(
    "column_profile",
    _profile_sql(
        _ORDERS,
        {"o_orderkey": "bigint", "o_custkey": "bigint", "status": "string", "o_totalprice": "double",
         "o_orderdate": "timestamp_ntz"},
    ),
)
def _profile(spark, root):
    return column_profile(_orders(spark, root))


_PROFILED = {
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
             "p_retailprice": "double"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
}


@query(
    "profile_tables",
    " UNION ALL ".join(_profile_sql(t, c, f"'{t}' AS \"table\", ") for t, c in _PROFILED.items()),
)
def _profiles(spark, root):
    return profile_tables({t: table(spark, root, t) for t in _PROFILED})


_NUMERIC = ("p_partkey", "p_size", "p_retailprice", "one")


@query(
    "low_variance",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {fixed_sql(f'var_samp({c})', 2)} AS variance, count(DISTINCT {c}) AS distinct_values,
 count(DISTINCT {c}) <= 1 AS is_constant FROM (SELECT *, 1 AS one FROM part)""" for c in _NUMERIC
    ),
)
def _variance(spark, root):
    found = low_variance(table(spark, root, "part").withColumn("one", F.lit(1)))
    return found.withColumn("variance", fixed(F.col("variance"), 2))


_MEASURES = ("l_discount", "l_extendedprice", "l_linenumber", "l_quantity", "l_tax")
_LINES = "(SELECT l_discount, l_extendedprice, l_linenumber, nullif(l_quantity, 7) AS l_quantity, l_tax FROM lineitem)"


def _lines(spark, root):
    return table(spark, root, "lineitem").select(
        "l_discount", "l_extendedprice", "l_linenumber", F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"), "l_tax"
    )


_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {fixed_sql(f'corr({a}, {b})', 6)} AS correlation FROM {_LINES}"
    for a, b in combinations(_MEASURES, 2)
)


@query("correlation_matrix", _CORR_SQL)
def _matrix(spark, root):
    return correlation_matrix(_lines(spark, root)).withColumn("correlation", fixed(F.col("correlation"), 6))


# the form for very many columns: sums of products per batch instead of one aggregate per pair
@query("correlation_matrix_wide", _CORR_SQL)
def _wide_matrix(spark, root):
    found = _summed_correlations(_lines(spark, root), list(combinations(_MEASURES, 2)))
    return found.withColumn("correlation", fixed(F.col("correlation"), 6))


@query(
    "target_correlation",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {fixed_sql(f'corr("TARGET", {e})', 6)} AS correlation FROM {APPLICATIONS_SQL}"""
        for c, e in (("SK_ID_CURR", '"SK_ID_CURR"'), ("c_nationkey", "c_nationkey"), ("c_acctbal", "c_acctbal"))
    ),
)
def _target(spark, root):
    found = target_correlation(applications(spark, root), "TARGET")
    return found.withColumn("correlation", fixed(F.col("correlation"), 6))


_DESCRIBED = {"o_totalprice": "o_totalprice", "o_orderkey": "o_orderkey", "small": "nullif(o_custkey, 5)"}


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({e}) AS n, count(*) - count({e}) AS nulls, {fixed_sql(f'avg({e})', 2)} AS mean,
 {fixed_sql(f'stddev_samp({e})', 2)} AS std, min({e})::DOUBLE AS min, {fixed_sql(f'quantile_cont({e}, 0.25)', 3)} AS p25,
 {fixed_sql(f'quantile_cont({e}, 0.5)', 3)} AS p50, {fixed_sql(f'quantile_cont({e}, 0.75)', 3)} AS p75,
 max({e})::DOUBLE AS max FROM orders""" for c, e in _DESCRIBED.items()
    ),
)
def _describe(spark, root):
    o = table(spark, root, "orders").select(
        "o_totalprice", "o_orderkey", F.nullif("o_custkey", F.lit(5)).alias("small")
    )
    d = describe_numeric(o)
    digits = {"mean": 2, "std": 2, "p25": 3, "p50": 3, "p75": 3}
    return d.withColumns({c: fixed(F.col(c), n) for c, n in digits.items()})


@query(
    "reproducible_sample",
    """SELECT o_orderkey, o_totalprice FROM (SELECT *, md5(o_orderkey::VARCHAR || '|42') AS h FROM orders)
 ORDER BY h, o_orderkey LIMIT 500""",
)
def _sample(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return reproducible_sample(o, 500, ["o_orderkey"], 42)


@query(
    "running_sample",
    """SELECT o_orderkey, o_totalprice FROM (SELECT *, md5(o_orderkey::VARCHAR || '|42') AS h FROM orders)
 ORDER BY h, o_orderkey LIMIT 500""",
)
def _running(spark, root):
    """Three batches of different sizes, the state kept between them, give the sample of the whole table."""
    o = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    state = None
    for low, high in ((0, 1), (1, 2), (2, 7)):
        batch = o.where((F.col("o_orderkey") % 7 >= low) & (F.col("o_orderkey") % 7 < high))
        state = stage(running_sample(state, batch, 500, ["o_orderkey"], 42), "sample")
    return state


def _state_sql(column, number):
    value = f"{column}::DOUBLE" if number else "NULL::DOUBLE"
    kept = f"nullif({column}, 'P')" if column == "o_orderstatus" else column
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) - count({kept}) AS null_count, {fixed_sql(f'avg({value})')} AS mean,
 {fixed_sql(f'stddev_samp({value})', 2)} AS std, min({value}) AS low, max({value}) AS high,
 {'NULL' if number else f'min({kept})'} AS text_low, {'NULL' if number else f'max({kept})'} AS text_high, true AS near FROM orders"""


@query(
    "profile_state",
    " UNION ALL ".join(_state_sql(c, n) for c, n in (("o_custkey", True), ("o_totalprice", True), ("o_orderstatus", False))),
)
def _profile_state(spark, root):
    """A table is profiled, appended to, and profiled again from its new files alone; estimates lie near the exact counts."""
    o = table(spark, root, "orders").select("o_custkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    path, state = staging_path(spark, "orders"), staging_path(spark, "state")
    for part in (0, 1):
        write_table(o.where(F.pmod(F.xxhash64("o_custkey"), F.lit(2)) == part), path, "append")
        refresh_profile(spark, path, state)
    exact = o.agg(*[F.count_distinct(c).alias(c) for c in o.columns]).unpivot([], o.columns, "column", "exact")
    found = profile_of(spark, path, state).join(exact, "column")
    return found.select(
        "column", "rows", "null_count", fixed(F.col("mean")).alias("mean"), fixed(F.col("std"), 2).alias("std"), "low", "high",
        "text_low", "text_high", (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.1 * F.col("exact") + 1).alias("near"),
    )


@query(
    "table_summary",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", count(*) AS rows, {n} AS columns FROM {t}"""
        for t, n in (("customer", 5), ("orders", 6), ("lineitem", 11), ("documents", 5))
    ),
)
def _summary(spark, root):
    return table_summary({t: table(spark, root, t) for t in ("customer", "orders", "lineitem", "documents")})


@query(
    "storage_footprint_rows",
    """SELECT 'orders' AS "table", count(*) AS rows, true AS stored FROM orders
 UNION ALL SELECT 'nothing', 0, true""",
)
def _footprint_rows(spark, root):
    """A table without rows has files and bytes too."""
    path = staging_path(spark, "nothing")
    write_table(table(spark, root, "orders").limit(0), path)
    found = storage_footprint({"orders": table(spark, root, "orders"), "nothing": spark.read.parquet(path)})
    return found.select("table", "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("stored"))


@query("storage_footprint")
def _footprint(spark, root):
    return storage_footprint({t: table(spark, root, t) for t in ("customer", "orders", "lineitem", "events")})


@query(
    "throughput",
    """SELECT user_id, rows, seconds, CASE WHEN seconds = 0 THEN 0.0 ELSE round(rows::DOUBLE / seconds, 6) END
 AS rows_per_second, round(seconds::DOUBLE * 1000 / rows, 6) AS avg_latency_ms_per_row
 FROM (SELECT user_id, count(*) AS rows, (epoch(max(date_trunc('second', ts)))
 - epoch(min(date_trunc('second', ts))))::BIGINT AS seconds FROM events GROUP BY 1)""",
)
def _throughput(spark, root):
    runs = table(spark, root, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))).alias("seconds"),
    )
    return throughput(runs, "rows", "seconds")
