"""Scans, sinks and simple row operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import clip
from ledgerloom.functions.text import run_id
from ledgerloom.operators.incremental import first_n, id_range, top_n, top_n_preview, without_top_n
from ledgerloom.operators.joins import semi_join
from ledgerloom.operators.ordering import dedup_by_key, page_of, row_ids, sorted_slice, total_order
from ledgerloom.operators.quality import range_exclusion
from ledgerloom.plans.maintenance import backup_rows, delete_rows, restore_rows
from ledgerloom.plans.registry.base import fixed, fixed_sql, query, table
from ledgerloom.sources.catalog import drop_columns
from ledgerloom.sources.staging import staging_path
from ledgerloom.sources.tables import (
    file_catalog,
    normalize_nulls,
    restore_tables,
    scan_csv,
    scan_table,
    scoped,
    snapshot_tables,
    table_selection,
    write_csv,
    write_table,
)
from ledgerloom.sources.versions import VersionedTable


def _rows(tables):
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "scan_csv_roundtrip",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN NULL
 ELSE c_mktsegment END AS segment, c_acctbal, CASE WHEN c_nationkey = 7 THEN NULL ELSE c_nationkey END
 AS nation FROM customer""",
)
def _csv(spark, root):
    c = table(spark, root, "customer")
    segment = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "NA")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "n/a")
        .when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    )
    nation = F.when(F.col("c_nationkey") == 7, "N/A").otherwise(F.col("c_nationkey").cast("string"))
    path = staging_path(spark, "csv")
    write_csv(c.select("c_custkey", segment.alias("segment"), "c_acctbal", nation.alias("nation")), path)
    return scan_csv(spark, path, "c_custkey bigint, segment string, c_acctbal double, nation int")


_ALL = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages "
    "part region supplier"
).split()


@query("file_catalog", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _ALL))
def _files(spark, root):
    found = [r["table"] for r in file_catalog(spark, root, "*.parquet").select("table").collect()]
    return _rows({name: table(spark, root, name) for name in found})


_SOME = ("customer", "nation", "orders", "supplier")


@query("file_catalog_folders", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _SOME))
def _folders(spark, root):
    """Tables that are folders of several files, some of them nested."""
    path = staging_path(spark, "folders")
    for n, name in enumerate(_SOME):
        below = path if n % 2 else f"{path}/nested"
        write_table(table(spark, root, name).repartition(3), f"{below}/{name}.parquet")
    found = file_catalog(spark, path, "*.parquet").collect()
    return _rows({r["table"]: spark.read.parquet(r["path"]) for r in found})


@query("scan_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 250")
def _limit(spark, root):
    return scan_table(spark, root, "orders", ["o_orderkey", "o_totalprice"], limit=250, order_by=["o_orderkey"])


@query(
    "scan_by_entity_ids",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
 WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def _by_ids(spark, root):
    path = staging_path(spark, "alias")
    write_table(table(spark, root, "orders"), f"{path}/rep_orders.parquet")
    ids = table(spark, root, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")
    return scan_table(spark, path, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"], ids, "o_custkey")


@query("scan_empty_ids", "SELECT o_orderkey, o_custkey FROM orders WHERE false")
def _no_ids(spark, root):
    ids = table(spark, root, "customer").where(F.col("c_mktsegment") == "").select("c_custkey")
    return scan_table(spark, root, "orders", ["o_orderkey", "o_custkey"], ids, "o_custkey")


@query("scan_pruned", "SELECT l_orderkey, l_quantity FROM lineitem")
def _pruned(spark, root):
    return scan_table(spark, root, "lineitem", ["l_orderkey", "l_quantity"])


@query(
    "table_selection",
    """SELECT 'orders' AS "table", 'found' AS status, (SELECT count(*) FROM orders) AS rows UNION ALL
 SELECT 'lineitem', 'found', (SELECT count(*) FROM lineitem) UNION ALL SELECT 'absent', 'missing', NULL""",
)
def _selection(spark, root):
    asked = spark.createDataFrame([("orders",), ("data/lineitem.parquet",), ("absent",)], "table string")
    status = table_selection(file_catalog(spark, root, "*.parquet"), asked)
    found = [r["table"] for r in status.where(F.col("status") == "found").collect()]
    return status.join(_rows({t: table(spark, root, t) for t in found}), "table", "left")


@query("load_replace", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _replace(spark, root):
    path = staging_path(spark, "replace")
    columns = ["s_suppkey", "s_name", "s_acctbal"]
    customers = table(spark, root, "customer").select("c_custkey", "c_name", "c_acctbal").toDF(*columns)
    write_table(customers, path)
    write_table(table(spark, root, "supplier").select(*columns), path)
    return spark.read.parquet(path)


@query(
    "load_append",
    """SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""",
)
def _append(spark, root):
    path = staging_path(spark, "append")
    write_table(table(spark, root, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    more = table(spark, root, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    write_table(more, path, "append")
    return spark.read.parquet(path)


_SNAPSHOT = ("customer", "orders", "lineitem")


@query(
    "snapshot_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _SNAPSHOT),
)
def _snapshot(spark, root):
    tables = {t: table(spark, root, t) for t in _SNAPSHOT}
    folder = snapshot_tables(tables, staging_path(spark, "snapshot"), "warehouse", "20240131_120000")
    return _rows(restore_tables(spark, folder, _SNAPSHOT))


# ---------------------------------------------------------------- top-n backup, delete, restore

_TOP = 200


@query(
    "backup_top_n",
    f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
 ORDER BY o_totalprice DESC, o_orderkey LIMIT {_TOP}""",
)
def _backup(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_n(o, "o_totalprice", _TOP)


@query(
    "delete_top_n",
    f"""SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER
 (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn > {_TOP}""",
)
def _delete(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return without_top_n(o, "o_totalprice", _TOP)


@query(
    "versioned_replace",
    """SELECT 1 AS version, c_custkey, c_acctbal FROM customer
 UNION ALL SELECT 2, c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0
 UNION ALL SELECT 3, c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 3, s_suppkey, s_acctbal FROM supplier""",
)
def _versions(spark, root):
    """A table is replaced by rows read from itself, then appended to; every version stays readable."""
    table_of = VersionedTable(spark, staging_path(spark, "versions"))
    columns = ["c_custkey", "c_acctbal"]
    table_of.replace(table(spark, root, "customer").select(*columns))
    table_of.replace(table_of.read().where("c_acctbal >= 0"))
    table_of.append(table(spark, root, "supplier").select("s_suppkey", "s_acctbal").toDF(*columns))
    rows = [table_of.read(v).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).select("version", *columns)


@query(
    "versioned_delete_restore",
    f"""WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey DESC) AS rn FROM orders)
 SELECT 2 AS version, o_orderkey, o_totalprice FROM r WHERE rn > {_TOP}
 UNION ALL SELECT 3, o_orderkey, o_totalprice FROM r WHERE rn > {_TOP}
 UNION ALL SELECT 3, o_orderkey, o_totalprice FROM (SELECT * FROM r WHERE rn <= {_TOP} ORDER BY o_orderkey LIMIT 50)""",
)
def _versioned_delete(spark, root):
    """The latest rows are backed up, deleted by rewriting the files that hold them, and some restored."""
    o = table(spark, root, "orders").select("o_orderkey", "o_totalprice").repartitionByRange(8, "o_orderkey")
    path, backup = staging_path(spark, "versions"), staging_path(spark, "backup")
    table_of = VersionedTable(spark, path)
    table_of.replace(o)
    backup_rows(table_of.read(), "o_orderkey", _TOP, backup)
    delete_rows(spark, path, "o_orderkey", _TOP)
    restore_rows(spark, backup, path, ["o_orderkey"], 50)
    rows = [table_of.read(v).withColumn("version", F.lit(v)) for v in (2, 3)]
    return rows[0].unionByName(rows[1]).select("version", "o_orderkey", "o_totalprice")


# many lines share a quantity: exactly n of the tied rows go
@query(
    "delete_top_n_ties",
    f"""SELECT l_quantity, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER
 (ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn > {_TOP}""",
)
def _delete_ties(spark, root):
    lines = table(spark, root, "lineitem").select("l_quantity", "l_orderkey", "l_linenumber")
    return without_top_n(lines, "l_quantity", _TOP)


@query(
    "delete_preview",
    f"""SELECT count(*) AS rows, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id
 FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT {_TOP})""",
)
def _preview(spark, root):
    return top_n_preview(table(spark, root, "orders").select("o_orderkey"), "o_orderkey", _TOP)


@query(
    "restore_first_n",
    f"""WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey DESC) AS rn FROM orders)
 SELECT o_orderkey, o_totalprice FROM r WHERE rn > {_TOP}
 UNION ALL SELECT o_orderkey, o_totalprice FROM (SELECT * FROM r WHERE rn <= {_TOP} ORDER BY o_orderkey LIMIT 50)""",
)
def _restore(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    backup = top_n(o, "o_orderkey", _TOP)
    path = staging_path(spark, "restore")
    write_table(without_top_n(o, "o_orderkey", _TOP), path)
    write_table(first_n(backup, ["o_orderkey"], 50), path, "append")
    return spark.read.parquet(path)


@query(
    "id_range",
    """SELECT count(*) AS rows, min(c_custkey) AS min_id, max(c_custkey) AS max_id FROM customer
 WHERE c_acctbal < 0""",
)
def _id_range(spark, root):
    return id_range(table(spark, root, "customer").where(F.col("c_acctbal") < 0), "c_custkey")


# ---------------------------------------------------------------- rows and columns


@query("drop_columns", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def _drop(spark, root):
    return drop_columns(table(spark, root, "orders"), ["o_custkey", "_DW_ID"], ["o_orderstatus", "o_orderdate"])


# each bound alone and both together; a null key is dropped by all of them
@query(
    "range_exclusion",
    """WITH o AS (SELECT nullif(o_custkey, 7) AS k FROM orders)
 SELECT 'first' AS bound, k FROM o WHERE k < 100 UNION ALL SELECT 'last', k FROM o WHERE k > 1000
 UNION ALL SELECT 'both', k FROM o WHERE NOT (k BETWEEN 100 AND 1000)""",
)
def _range(spark, root):
    o = table(spark, root, "orders").select(F.nullif("o_custkey", F.lit(7)).alias("k"))
    parts = {"first": (100, None), "last": (None, 1000), "both": (100, 1000)}
    frames = [range_exclusion(o, "k", *b).select(F.lit(n).alias("bound"), "k") for n, b in parts.items()]
    return reduce(DataFrame.unionByName, frames)


@query(
    "normalize_nulls",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'O' END AS status,
 CASE WHEN o_totalprice > 200000 THEN o_totalprice END AS price FROM orders""",
)
def _nulls(spark, root):
    o = table(spark, root, "orders")
    status = F.when(F.col("o_orderstatus") == "F", " n/a ").when(F.col("o_orderstatus") == "P", "").otherwise("O")
    price = F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    return normalize_nulls(o.select("o_orderkey", status.alias("status"), price.alias("price")))


@query(
    "sorted_slice",
    """SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT l_orderkey, l_partkey, l_quantity,
 row_number() OVER (ORDER BY l_orderkey, l_partkey, l_quantity) - 1 AS n FROM lineitem)
 WHERE n >= 1000 AND n < 3500""",
)
def _slice(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_tax")
    return sorted_slice(lines, ["l_orderkey", "l_partkey", "l_quantity"], 1000, 3500, ["l_tax"])


@query(
    "dedup_by_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
 (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _dedup(spark, root):
    return dedup_by_key(table(spark, root, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey")


_LINE = '"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"'


@query(
    "total_order",
    f"""SELECT row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
 l_linenumber NULLS FIRST, l_quantity NULLS FIRST) - 1 AS position, {_LINE} FROM lineitem""",
)
def _order(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return row_ids(lines, "position", total_order(lines, ["l_orderkey"]))


@query(
    "page_by_offset",
    """SELECT ((row_number() OVER (ORDER BY event_id) - 1) // 1000)::BIGINT AS page, event_id, user_id FROM events""",
)
def _page(spark, root):
    return page_of(table(spark, root, "events").select("event_id", "user_id"), "page", ["event_id"], 1000)


@query(
    "semi_join_ids",
    """SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer
 WHERE c_mktsegment = 'BUILDING')""",
)
def _semi(spark, root):
    ids = table(spark, root, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return semi_join(table(spark, root, "events").select("event_id", "user_id"), ids, "user_id")


@query(
    "scan_scoped_limit",
    f"""SELECT o_orderkey, {fixed_sql('o_totalprice', 2)} AS price FROM orders WHERE o_custkey IN
 (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ORDER BY o_orderkey LIMIT 100""",
)
def _scoped(spark, root):
    ids = table(spark, root, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")
    rows = scoped(table(spark, root, "orders"), ids, "o_custkey", 100, ["o_orderkey"])
    return rows.select("o_orderkey", fixed(F.col("o_totalprice"), 2).alias("price"))


@query(
    "scalar_functions",
    r"""SELECT event_id, 'prod_' || strftime(ts, '%Y%m%d_%H%M%S') AS run_id, upper(trim('  ' || event_type || ' ')) AS kind,
 regexp_extract(props, '(\d+)', 1) AS digits, (props->>'$.k')::BIGINT AS k, starts_with(event_type, 'c') AS c_first,
 replace(event_type, 'i', '_') AS replaced, abs(round(value * 100)::BIGINT - 5000) AS distance, user_id % 7 AS remainder,
 coalesce(nullif(event_type, 'click'), 'none') AS filled, nullif(event_type, 'click') IS NOT DISTINCT FROM NULL AS missing,
 md5(event_type) AS digest, sha256(event_type) AS sha, list_contains(['view', 'click'], event_type) AS listed,
 TRY_CAST(event_type AS BIGINT) AS as_number, least(greatest(round(value * 100)::BIGINT, 1000), 9000) AS clipped FROM events""",
)
def _scalar(spark, root):
    kind, cents = F.col("event_type"), F.round(F.col("value") * 100).cast("bigint")
    some = F.nullif(kind, F.lit("click"))
    return table(spark, root, "events").select(
        "event_id", run_id("prod", F.col("ts")).alias("run_id"),
        F.upper(F.trim(F.concat(F.lit("  "), kind, F.lit(" ")))).alias("kind"),
        F.regexp_extract("props", r"(\d+)", 1).alias("digits"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), kind.startswith("c").alias("c_first"),
        F.replace(kind, F.lit("i"), F.lit("_")).alias("replaced"), F.abs(cents - 5000).alias("distance"),
        F.pmod("user_id", F.lit(7)).alias("remainder"), F.coalesce(some, F.lit("none")).alias("filled"),
        some.eqNullSafe(F.lit(None)).alias("missing"), F.md5(kind).alias("digest"), F.sha2(kind, 256).alias("sha"),
        F.array_contains(F.array(F.lit("view"), F.lit("click")), kind).alias("listed"),
        kind.try_cast("bigint").alias("as_number"), clip(cents, 1000, 9000).alias("clipped"),
    )
