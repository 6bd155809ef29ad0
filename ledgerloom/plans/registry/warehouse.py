"""Storage, report tables and their incremental upkeep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import report
from ledgerloom.operators.quality import table_fingerprint
from ledgerloom.plans.deployment import refresh_batch
from ledgerloom.plans.registry.base import CREDITS_SQL, credits, query, table
from ledgerloom.plans.registry.lookups import normalized_orders
from ledgerloom.plans.warehouse import build_dictionaries, build_warehouse, storage_layout, with_row_id
from ledgerloom.sources.staging import staging_path
from ledgerloom.sources.tables import write_table
from ledgerloom.streaming.report_stream import maintain_report, read_report, refresh_report, storage_stream

_ORDERS = """(SELECT o_orderkey, o_custkey, o_orderstatus AS "STATUS",
 nullif(o_orderpriority, '3-MEDIUM') AS "PRIORITY" FROM orders)"""


@query("dw_load_keyed", f"SELECT * FROM {CREDITS_SQL}")
def _keyed(spark, root):
    path = staging_path(spark, "storage")
    write_table(credits(spark, root).limit(0), path)
    write_table(credits(spark, root), path, "append")
    return spark.read.parquet(path)


@query("storage_layout", f"SELECT * FROM {CREDITS_SQL}")
def _layout(spark, root):
    path = staging_path(spark, "layout")
    write_table(storage_layout(credits(spark, root)), path)
    return spark.read.parquet(path)


@query(
    "dw_row_id",
    """SELECT count(*) AS rows, count(*) AS distinct_ids, 0::BIGINT AS min_id, count(*) - 1 AS max_id,
 sum(l_quantity)::BIGINT AS quantity, (count(*) * (count(*) - 1) // 2)::BIGINT AS id_sum, count(DISTINCT (l_orderkey,
 l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate)) AS distinct_rows FROM lineitem""",
)
def _row_id(spark, root):
    numbered = with_row_id(table(spark, root, "lineitem"))
    return numbered.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_DW_ID").alias("distinct_ids"),
        F.min("_DW_ID").alias("min_id"), F.max("_DW_ID").alias("max_id"),
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.sum("_DW_ID").cast("bigint").alias("id_sum"),
        F.count_distinct(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
        ).alias("distinct_rows"),
    )


@query("report_table", f"SELECT * FROM {_ORDERS}")
def _report(spark, root):
    fact, dims = normalized_orders(spark, root)
    return report(fact, build_dictionaries(dims))


@query("report_stream", f"SELECT * FROM {_ORDERS}")
def _stream(spark, root):
    """Two rounds of new storage rows; the second finds the first one's report in place."""
    fact, dims = normalized_orders(spark, root)
    dictionaries = build_dictionaries(dims)
    storage, output, state = (staging_path(spark, n) for n in ("storage", "report", "state"))
    last = dims["dim_status"].where(F.col("STATUS") == "P").select("STATUS_ID")
    rounds = [fact.join(last, "STATUS_ID", "left_anti"), fact.join(last, "STATUS_ID", "left_semi")]
    for rows in rounds:
        write_table(rows.select(*fact.columns), storage, "append")
        stream = storage_stream(spark, storage, fact.schema, max_files=2)
        maintain_report(stream, lambda: dictionaries, output, state).awaitTermination()
    return read_report(spark, output)


_BATCH = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"


@query(
    "refresh_scope",
    f"""SELECT (SELECT count(*) FROM {_BATCH}) AS entity_count,
 (SELECT count(*) FROM orders WHERE o_custkey IN {_BATCH}) AS storage_count,
 (SELECT count(*) FROM orders WHERE o_custkey IN {_BATCH}) AS reporting_count""",
)
def _refresh(spark, root):
    """Batch ids are new to storage; the refresh brings storage and report up to date."""
    ids = table(spark, root, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("SK_ID_CURR"))
    staging = credits(spark, root)
    storage, output = staging_path(spark, "storage"), staging_path(spark, "report")
    write_table(staging.join(ids, "SK_ID_CURR", "left_anti"), storage)
    refresh_report(spark, storage, output)
    return refresh_batch(spark, staging, storage, ids, "SK_ID_CURR", output)


@query("report_refresh", f"SELECT * FROM {_ORDERS}")
def _report_refresh(spark, root):
    """A stream, a refresh and a stream with a new checkpoint share a report that holds every row once."""
    fact, dims = normalized_orders(spark, root)
    dictionaries = build_dictionaries(dims)
    storage, output = staging_path(spark, "storage"), staging_path(spark, "report")
    for part, state in enumerate(("first", None, "second")):
        write_table(fact.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == part).select(*fact.columns), storage, "append")
        if state is None:
            refresh_report(spark, storage, output, lambda: dictionaries)
        else:
            stream = storage_stream(spark, storage, fact.schema)
            maintain_report(stream, lambda: dictionaries, output, staging_path(spark, state)).awaitTermination()
    return read_report(spark, output)


_PRINT = """SELECT '{name}' AS "table", count(*) AS rows, sum(b)::VARCHAR AS digest_sum, bit_xor(b) AS digest_xor FROM
 (SELECT ('0x' || substr(md5({columns}), 1, 15))::BIGINT AS b FROM {source})"""


def _print(name: str, source: str, *columns: str) -> str:
    text = " || ".join(f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns)
    return _PRINT.format(name=name, columns=text, source=source)


_STATUS = """(SELECT o_orderstatus AS v, row_number() OVER (ORDER BY min(o_orderkey), o_orderstatus) AS id
 FROM orders GROUP BY 1)"""
_PRIORITY = """(SELECT o_orderpriority AS v, row_number() OVER (ORDER BY min(o_orderkey), o_orderpriority) AS id
 FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1)"""


@query(
    "warehouse_build",
    " UNION ALL ".join(
        [
            _print(
                "bureau",
                f"""(SELECT o_orderkey, o_custkey, s.id AS s, p.id AS p FROM orders LEFT JOIN {_STATUS} s
 ON s.v = o_orderstatus LEFT JOIN {_PRIORITY} p ON p.v = o_orderpriority)""",
                "o_orderkey", "o_custkey", "s", "p",
            ),
            _print("rep_bureau", _ORDERS, "o_orderkey", "o_custkey", '"STATUS"', '"PRIORITY"'),
            _print("lines", "lineitem", "l_orderkey", "l_linenumber", "l_returnflag"),
            _print("rep_lines", "lineitem", "l_orderkey", "l_linenumber", "l_returnflag"),
        ]
    ),
)
def _build(spark, root):
    fact, dims = normalized_orders(spark, root)
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    staging = {"bureau": fact, "lines": lines}
    tables = build_warehouse(spark, staging, dims, staging_path(spark, "warehouse"), keyless=["lines"])
    prints = [
        table_fingerprint(df.drop("_DW_ID")).select(F.lit(n).alias("table"), "*") for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, prints)
