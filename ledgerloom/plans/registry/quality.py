"""Parity, difference and integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import missing_ids
from ledgerloom.operators.metrics import one_row
from ledgerloom.operators.quality import (
    align_schema,
    cell_diff,
    column_mismatch_counts,
    compare_fingerprints,
    content_diff_pct,
    diff_report,
    dtype_mismatches,
    duplicates,
    fk_orphans,
    int_width_audit,
    match_percentage,
    null_totals,
    parity_report,
    pk_uniqueness,
    rowcount_parity,
    sampled_compare,
    table_fingerprint,
    tolerance_compare,
)
from ledgerloom.operators.digests import narrowed_cell_diff
from ledgerloom.plans.registry.base import fixed, fixed_sql, query, table

# A second copy of the orders: prices of status P moved, priorities of LOW lost, one status renamed
# and, for status F, a difference far below every tolerance.
_COPY = """(SELECT o_orderkey, o_custkey,
 CASE WHEN o_orderstatus = 'F' AND o_custkey > 70 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10.5 WHEN o_orderstatus = 'F'
 THEN o_totalprice + 0.000001::DOUBLE ELSE o_totalprice END AS o_totalprice,
 o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)"""
_COLUMNS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _copy(spark, root):
    o = table(spark, root, "orders")
    price = (
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 10.5)
        .when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 0.000001)
        .otherwise(F.col("o_totalprice"))
    )
    moved = (F.col("o_orderstatus") == "F") & (F.col("o_custkey") > 70)
    status = F.when(moved, "X").otherwise(F.col("o_orderstatus"))
    return o.select(
        "o_orderkey", "o_custkey", status.alias("o_orderstatus"), price.alias("o_totalprice"),
        "o_orderdate", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )


_JOINED = f"orders a JOIN {_COPY} b USING (o_orderkey)"


def _gap(column: str, atol: float, rtol: float = 0.0) -> str:
    if column == "o_totalprice":
        return f"abs(a.{column} - b.{column}) > {atol}::DOUBLE + {rtol}::DOUBLE * abs(b.{column})"
    return f"a.{column} IS DISTINCT FROM b.{column}"


# ---------------------------------------------------------------- fingerprints


def _cell_sql(text: str) -> str:
    return f"coalesce(length({text})::VARCHAR || ':' || {text}, '-')"


def _number_sql(value: str) -> str:
    return f"floor({value} * 10000.0::DOUBLE + 0.5::DOUBLE)::BIGINT::VARCHAR"


_ORDER_CELLS = (
    "o_orderkey::VARCHAR", "o_custkey::VARCHAR", "o_orderstatus", _number_sql("o_totalprice"),
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')", "o_orderpriority",
)


def _print_sql(source: str, cells: tuple[str, ...] = _ORDER_CELLS) -> str:
    return f"""SELECT count(*) AS rows, coalesce(sum(b), 0)::VARCHAR AS digest_sum, bit_xor(b) AS digest_xor FROM (
 SELECT ('0x' || substr(md5({' || '.join(_cell_sql(c) for c in cells)}), 1, 15))::BIGINT AS b FROM {source})"""


@query("table_fingerprint", _print_sql("orders"))
def _fingerprint(spark, root):
    return table_fingerprint(table(spark, root, "orders"))


@query(
    "database_compare",
    f"""SELECT 'customer' AS "table", CASE WHEN (SELECT count(*) FROM (FROM customer EXCEPT ALL FROM customer)) = 0
 THEN 'equal' ELSE 'different' END AS status
 UNION ALL SELECT 'orders', CASE WHEN a = b THEN 'equal' ELSE 'different' END FROM
 (SELECT (SELECT {{'n': rows, 's': digest_sum, 'x': digest_xor}} FROM ({_print_sql('orders')})) AS a,
 (SELECT {{'n': rows, 's': digest_sum, 'x': digest_xor}} FROM ({_print_sql(_COPY)})) AS b)
 UNION ALL SELECT 'part', CASE WHEN count(*) >= 0 THEN 'only_left' END FROM part
 UNION ALL SELECT 'supplier', CASE WHEN count(*) >= 0 THEN 'only_right' END FROM supplier""",
)
def _databases(spark, root):
    customer = table(spark, root, "customer")
    left = {"customer": customer, "orders": table(spark, root, "orders"), "part": table(spark, root, "part")}
    right = {
        "customer": customer.orderBy(F.col("c_custkey").desc()), "orders": _copy(spark, root),
        "supplier": table(spark, root, "supplier"),
    }
    return compare_fingerprints(left, right)


@query(
    "rowcount_parity",
    """SELECT 'customer' AS "table", (SELECT count(*) FROM customer) AS left_rows,
 (SELECT count(*) FROM customer) AS right_rows, true AS equal UNION ALL
 SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P'), false""",
)
def _rowcounts(spark, root):
    o, c = table(spark, root, "orders"), table(spark, root, "customer")
    return rowcount_parity({"orders": o, "customer": c}, {"customer": c, "orders": o.where(F.col("o_orderstatus") != "P")})


# ---------------------------------------------------------------- differences


def _mismatch_sql(atol: float, rtol: float = 0.0, source: str = _JOINED) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {_gap(c, atol, rtol)}) AS mismatches,
 count(*) AS total FROM {source}""" for c in _COLUMNS
    )


@query("column_mismatch_counts", _mismatch_sql(0.01))
def _mismatches(spark, root):
    return column_mismatch_counts(table(spark, root, "orders"), _copy(spark, root), ["o_orderkey"], atol=0.01)


# without a key both copies are matched by their position in the same total order
@query(
    "mismatch_by_position",
    """WITH a AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_quantity) AS n, l_orderkey,
 l_partkey, l_suppkey, l_quantity FROM lineitem),
 b AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, q) AS n, l_orderkey, l_partkey,
 l_suppkey, q AS l_quantity FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS q
 FROM lineitem)),
 j AS (SELECT a.l_orderkey <> b.l_orderkey AS k, a.l_partkey <> b.l_partkey AS p, a.l_suppkey <> b.l_suppkey AS s,
 a.l_quantity <> b.l_quantity AS q FROM a JOIN b USING (n))
 SELECT 'l_orderkey' AS "column", count(*) FILTER (WHERE k) AS mismatches, count(*) AS total FROM j
 UNION ALL SELECT 'l_partkey', count(*) FILTER (WHERE p), count(*) FROM j
 UNION ALL SELECT 'l_suppkey', count(*) FILTER (WHERE s), count(*) FROM j
 UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE q), count(*) FROM j""",
)
def _by_position(spark, root):
    li = table(spark, root, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
    changed = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return column_mismatch_counts(
        li.select(*columns), li.withColumn("l_quantity", changed).select(*columns), order_by=["l_orderkey"]
    )


# a third of the first lines of every order is missing from the copy: nothing but those rows differs
@query(
    "mismatch_repeated_keys",
    """WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem),
 a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS n FROM li),
 b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS n FROM li
 WHERE NOT (l_orderkey % 3 = 0 AND l_linenumber = 1)),
 j AS (SELECT a.l_linenumber IS DISTINCT FROM b.l_linenumber AS x, a.l_partkey IS DISTINCT FROM b.l_partkey AS p,
 a.l_quantity IS DISTINCT FROM b.l_quantity AS q FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.n = b.n)
 SELECT 'l_linenumber' AS "column", count(*) FILTER (WHERE x) AS mismatches, count(*) AS total FROM j
 UNION ALL SELECT 'l_partkey', count(*) FILTER (WHERE p), count(*) FROM j
 UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE q), count(*) FROM j""",
)
def _repeated_keys(spark, root):
    li = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    fewer = li.where(~((F.col("l_orderkey") % 3 == 0) & (F.col("l_linenumber") == 1)))
    return column_mismatch_counts(li, fewer, ["l_orderkey"], ["l_linenumber"])


@query(
    "tolerance_compare",
    f"""SELECT o_orderkey, concat_ws(',', {', '.join(f"CASE WHEN {_gap(c, 0.0001, 0.00001)} THEN '{c}' END" for c in _COLUMNS)})
 AS columns FROM {_JOINED} WHERE {' OR '.join(_gap(c, 0.0001, 0.00001) for c in _COLUMNS)}""",
)
def _tolerance(spark, root):
    return tolerance_compare(table(spark, root, "orders"), _copy(spark, root), ["o_orderkey"], 1e-4, 1e-5)


@query(
    "match_percentage",
    f"""SELECT "column", total - mismatches AS matching, total,
 {fixed_sql('(total - mismatches) * 100.0::DOUBLE / total')} AS pct FROM ({_mismatch_sql(0.0)}) WHERE mismatches > 0""",
)
def _matching(spark, root):
    found = match_percentage(table(spark, root, "orders"), _copy(spark, root), ["o_orderkey"])
    return found.withColumn("pct", fixed(F.col("pct")))


# prices differ by less than the guard where only status F was touched
@query(
    "content_diff_pct",
    f"""SELECT 'o_orderstatus' AS "column", count(*) FILTER (WHERE {_gap('o_orderstatus', 0)}) AS differences,
 {fixed_sql("count(*) FILTER (WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus) * 100.0::DOUBLE / count(*)")} AS pct
 FROM {_JOINED} HAVING differences > 0""",
)
def _content(spark, root):
    o, copy = table(spark, root, "orders"), _copy(spark, root)
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") - 10.5).otherwise(F.col("o_totalprice"))
    near = copy.withColumn("o_totalprice", price).withColumn("o_custkey_ID", F.lit(1))
    found = content_diff_pct(
        o.withColumn("o_custkey_ID", F.lit(2)), near, ["o_orderkey"], excluded=["o_orderpriority"]
    )
    return found.withColumn("pct", fixed(F.col("pct")))


@query(
    "diff_report",
    f"""WITH a AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
 b AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {_COPY} GROUP BY ALL),
 u AS (SELECT o_orderstatus, o_orderpriority, sum(n)::BIGINT AS n FROM
 (SELECT * FROM a UNION ALL SELECT o_orderstatus, o_orderpriority, -n FROM b) GROUP BY 1, 2)
 SELECT o_orderstatus, o_orderpriority, CASE WHEN n > 0 THEN 'CSV' ELSE 'DB' END AS origin, abs(n) AS copies
 FROM u WHERE n <> 0""",
)
def _diff(spark, root):
    columns = ["o_orderstatus", "o_orderpriority"]
    left, right = table(spark, root, "orders").select(*columns), _copy(spark, root).select(*columns)
    return diff_report(left, right, ("CSV", "DB"))


@query(
    "cell_diff",
    f"""SELECT o_orderkey, 'o_orderstatus' AS "column", a.o_orderstatus AS left_value, b.o_orderstatus AS right_value
 FROM {_JOINED} WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
 UNION ALL SELECT o_orderkey, 'o_orderpriority', a.o_orderpriority, b.o_orderpriority
 FROM {_JOINED} WHERE a.o_orderpriority IS DISTINCT FROM b.o_orderpriority
 UNION ALL SELECT o_orderkey, 'o_totalprice', floor(a.o_totalprice * 10000.0::DOUBLE + 0.5::DOUBLE)::BIGINT::VARCHAR,
 floor(b.o_totalprice * 10000.0::DOUBLE + 0.5::DOUBLE)::BIGINT::VARCHAR FROM {_JOINED} WHERE a.o_orderstatus = 'P'""",
)
def _cells(spark, root):
    return cell_diff(table(spark, root, "orders"), _copy(spark, root), "o_orderkey")


# twelve orders of the copy have another price, and nothing else differs
@query(
    "digest_cell_diff",
    """SELECT o_orderkey, 'o_totalprice' AS "column", floor(o_totalprice * 10000.0::DOUBLE + 0.5::DOUBLE)::BIGINT::VARCHAR AS left_value,
 floor((o_totalprice + 1) * 10000.0::DOUBLE + 0.5::DOUBLE)::BIGINT::VARCHAR AS right_value
 FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 12)""",
)
def _digest_cells(spark, root):
    """Both copies are narrowed by their digest trees to the few ranges that differ."""
    o = table(spark, root, "orders")
    first = o.select("o_orderkey").orderBy("o_orderkey").limit(12).withColumn("changed", F.lit(True))
    price = F.when(F.col("changed"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = o.join(first, "o_orderkey", "left").withColumn("o_totalprice", price).drop("changed")
    return narrowed_cell_diff(o, copy, "o_orderkey")


@query(
    "sampled_compare",
    _mismatch_sql(
        0.0001, 0.0001,
        f"(SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000) a JOIN {_COPY} b USING (o_orderkey)",
    ) + """ UNION ALL SELECT 'o_orderkey', 0, least(count(*), 1000) FROM orders""",
)
def _sampled(spark, root):
    return sampled_compare(table(spark, root, "orders"), _copy(spark, root), ["o_orderkey"], 1000, 1e-4, 1e-4)


@query(
    "parity_report",
    f"""SELECT 'content' AS "check", "column", mismatches AS differences FROM ({_mismatch_sql(0.01)}) WHERE mismatches > 0
 UNION ALL SELECT 'type', 'o_custkey', 1 UNION ALL SELECT 'missing', 'o_orderdate', 1 UNION ALL SELECT 'extra', 'new', 1
 UNION ALL SELECT 'rows', NULL, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')""",
)
def _parity(spark, root):
    o, copy = table(spark, root, "orders"), _copy(spark, root)
    same = parity_report(o, copy, ["o_orderkey"])
    other = copy.withColumnRenamed("o_orderdate", "new").withColumn("o_custkey", F.col("o_custkey").cast("int"))
    left = o.where(F.col("o_orderstatus") != "P")
    return same.unionByName(parity_report(left, other, ["o_orderkey"]))


@query(
    "dtype_mismatches",
    """SELECT 'o_custkey' AS "column", 'bigint' AS left_type, 'string' AS right_type,
 count(o_custkey) AS values, count(*) FILTER (WHERE o_custkey > 700) AS unreadable FROM orders""",
)
def _dtypes(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    text = F.when(F.col("o_custkey") > 700, "n/k").otherwise(F.col("o_custkey").cast("string"))
    other = o.withColumn("o_custkey", text)
    found = spark.createDataFrame(dtype_mismatches(o, other), "column string, left_type string, right_type string")
    cast = align_schema(o, other).agg(
        F.count(F.lit(1)).alias("values"), F.count_if(F.col("o_custkey").isNull()).alias("unreadable")
    )
    return one_row(found, cast)


@query(
    "align_schema",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey,
 o_totalprice FROM orders""",
)
def _align(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_custkey").cast("string"))
    raw = o.withColumns({"o_custkey": text, "o_totalprice": F.col("o_totalprice").cast("string")})
    return align_schema(o, raw.drop("o_orderstatus"))


# ---------------------------------------------------------------- nulls, widths, keys


@query("null_totals", f"SELECT count(*) FILTER (WHERE o_orderpriority IS NULL) AS nulls FROM {_COPY}")
def _null_totals(spark, root):
    return null_totals(_copy(spark, root))


@query(
    "int_width_audit",
    """SELECT 'cents' AS "column", 'bigint' AS type, min(round(o_totalprice * 100)::BIGINT * 1000) AS min_value,
 max(round(o_totalprice * 100)::BIGINT * 1000) AS max_value FROM orders
 HAVING max_value > 2147483647 OR min_value < -2147483648""",
)
def _widths(spark, root):
    o = table(spark, root, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") * 1000
    return int_width_audit(o.withColumn("cents", cents))


_KEYS = {"customer": ("c_custkey",), "orders": ("o_custkey", "o_orderkey"), "lineitem": ("l_orderkey", "l_linenumber"),
         "events": ("user_id",)}


@query(
    "pk_uniqueness",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{','.join(k)}' AS key, sum(n)::BIGINT AS rows, count(*) AS distinct_keys,
 count(*) FILTER (WHERE n > 1) AS duplicated_keys,
 CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'PRIMARY KEY' ELSE 'INDEX' END AS kind
 FROM (SELECT {', '.join(k)}, count(*) AS n FROM {t} GROUP BY ALL)""" for t, k in _KEYS.items()
    ),
)
def _primary(spark, root):
    return reduce(DataFrame.unionByName, [pk_uniqueness(table(spark, root, t), t, k) for t, k in _KEYS.items()])


_REFERENCES = (
    ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("events", "user_id", "supplier", "s_suppkey"), ("customer", "c_nationkey", "region", "r_regionkey"),
)


@query(
    "fk_orphans",
    " UNION ALL ".join(
        f"""SELECT '{f}.{c}' AS reference, sum(n)::BIGINT AS rows,
 coalesce(sum(CASE WHEN v NOT IN (SELECT {k} FROM {d}) THEN n END), 0)::BIGINT AS orphan_rows,
 count(*) FILTER (WHERE v NOT IN (SELECT {k} FROM {d})) AS orphan_values
 FROM (SELECT {c} AS v, count(*) AS n FROM {f} GROUP BY 1)""" for f, c, d, k in _REFERENCES
    ),
)
def _foreign(spark, root):
    frames = [
        fk_orphans(table(spark, root, f), c, table(spark, root, d), k, f"{f}.{c}") for f, c, d, k in _REFERENCES
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    "require_unique",
    """SELECT user_id, count(*) AS rows FROM events GROUP BY 1 HAVING count(*) > 1 ORDER BY user_id LIMIT 10""",
)
def _unique(spark, root):
    return duplicates(table(spark, root, "events"), "user_id")


@query(
    "missing_ids",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def _missing(spark, root):
    events = table(spark, root, "events").select(F.col("user_id").alias("c_custkey"))
    return missing_ids(table(spark, root, "customer"), events, "c_custkey")
