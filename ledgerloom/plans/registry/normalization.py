"""First normal form, dimensions, mappings and re-keying."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import type_label, without_type
from ledgerloom.operators.normalize import (
    atomize,
    common_dimension,
    consolidated_domain,
    dimension_overlap,
    encode,
    flatten_mappings,
    generate_mapping,
    integral_flags,
    local_dimensions,
    mapping_documents,
    normalize_table,
    normalize_tables,
    rekey,
    to_nullable_integers,
    value_counts,
    value_listing,
)
from ledgerloom.plans.registry.base import query, table

# ---------------------------------------------------------------- atomic values

# every way a numbered type occurs: after a blank, a colon or a dash, alone, absent, in a null
_RAW_SQL = """(SELECT p_partkey, CASE p_type
 WHEN 'STANDARD' THEN concat('Business Entity Type ', p_size)
 WHEN 'ECONOMY' THEN concat('Trade: type ', p_size)
 WHEN 'MEDIUM' THEN concat('Industry- TYPE', p_size)
 WHEN 'PROMO' THEN concat('Type ', p_size)
 WHEN 'LARGE' THEN 'XNA' END AS raw FROM part)"""


def _raw(spark, root):
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    raw = (
        F.when(kind == "STANDARD", F.concat(F.lit("Business Entity Type "), size))
        .when(kind == "ECONOMY", F.concat(F.lit("Trade: type "), size))
        .when(kind == "MEDIUM", F.concat(F.lit("Industry- TYPE"), size))
        .when(kind == "PROMO", F.concat(F.lit("Type "), size))
        .when(kind == "LARGE", F.lit("XNA"))
    )
    return table(spark, root, "part").select("p_partkey", raw.alias("raw"))


_LABEL_SQL = r"""CASE WHEN regexp_matches(lower(raw), 'type\s*\d+')
 THEN concat('Type ', regexp_extract(lower(raw), 'type\s*(\d+)', 1)) ELSE 'Type 0' END"""
_REST_SQL = r"trim(regexp_replace(raw, '[:-]?\s*type\s*\d+', '', 'gi'))"
_CLEAN_SQL = f"CASE WHEN {_REST_SQL} = '' THEN raw ELSE {_REST_SQL} END"


@query("atomize_label", f"SELECT p_partkey, {_LABEL_SQL} AS label FROM {_RAW_SQL}")
def _label(spark, root):
    return _raw(spark, root).select("p_partkey", type_label(F.col("raw")).alias("label"))


@query("atomize_clean", f"SELECT p_partkey, {_CLEAN_SQL} AS cleaned FROM {_RAW_SQL}")
def _clean(spark, root):
    return _raw(spark, root).select("p_partkey", without_type(F.col("raw")).alias("cleaned"))


@query(
    "atomize_column",
    f"""SELECT p_partkey, {_CLEAN_SQL} AS "ORGANIZATION_TYPE", {_LABEL_SQL} AS "ORGANIZATION_TYPE_2" FROM {_RAW_SQL}""",
)
def _atomize(spark, root):
    return atomize(atomize(_raw(spark, root).withColumnRenamed("raw", "ORGANIZATION_TYPE")))


# ---------------------------------------------------------------- shared mappings

_WEEKDAY = "WEEKDAY_APPR_PROCESS_START"
_DAYS = "['MONDAY','TUESDAY','WEDNESDAY','THURSDAY','FRIDAY','SATURDAY','SUNDAY']"
_DOMAIN_SQL = """(SELECT DISTINCT v FROM (SELECT o_orderstatus AS v FROM orders UNION ALL
 SELECT l_linestatus FROM lineitem UNION ALL SELECT l_returnflag FROM lineitem) WHERE v IS NOT NULL)"""


def _status_frames(spark, root):
    o, li = table(spark, root, "orders"), table(spark, root, "lineitem")
    return [
        o.select(F.col("o_orderstatus").alias("STATUS")),
        li.select(F.col("l_linestatus").alias("STATUS")),
        li.select(F.col("l_returnflag").alias("STATUS")),
        o.select("o_orderkey"),
    ]


@query("consolidated_domain", f"SELECT v AS value FROM {_DOMAIN_SQL}")
def _domain(spark, root):
    return consolidated_domain(_status_frames(spark, root), "STATUS")


_MAPPING_SQL = f"""(SELECT 'STATUS' AS "column", v AS value, row_number() OVER (ORDER BY v) AS id FROM {_DOMAIN_SQL}
 UNION ALL SELECT '{_WEEKDAY}', v, row_number() OVER
 (ORDER BY CASE WHEN v = 'XNA' THEN 999 ELSE list_position({_DAYS}, v) END, v)
 FROM (SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN 'XNA' ELSE upper(dayname(o_orderdate)) END AS v
 FROM orders UNION SELECT DISTINCT upper(dayname(ts)) FROM events))"""


def _mappings(spark, root):
    o, e = table(spark, root, "orders"), table(spark, root, "events")
    day = F.upper(F.date_format("o_orderdate", "EEEE"))
    days = [
        o.select(F.when(F.col("o_orderstatus") == "P", "XNA").otherwise(day).alias(_WEEKDAY)),
        e.select(F.upper(F.date_format("ts", "EEEE")).alias(_WEEKDAY)),
    ]
    status = generate_mapping(_status_frames(spark, root), "STATUS")
    return status.unionByName(generate_mapping(days, _WEEKDAY))


@query("mapping_generate", f"SELECT * FROM {_MAPPING_SQL}")
def _generate(spark, root):
    return _mappings(spark, root)


@query("mappings_flat", f"SELECT * FROM {_MAPPING_SQL}")
def _flat(spark, root):
    return flatten_mappings(mapping_documents(_mappings(spark, root)), "document")


@query("common_dims", f"""SELECT id AS "STATUS_ID", value AS "STATUS" FROM {_MAPPING_SQL} WHERE "column" = 'STATUS'""")
def _common(spark, root):
    return common_dimension(_mappings(spark, root), "STATUS")


# 'P' has no id and must become null
@query(
    "remap_shared_dim",
    f"""SELECT o_orderkey, m.id AS "STATUS_ID" FROM orders LEFT JOIN
 (SELECT * FROM {_MAPPING_SQL} WHERE "column" = 'STATUS' AND value <> 'P') m ON m.value = o_orderstatus""",
)
def _remap(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", F.col("o_orderstatus").alias("STATUS"))
    return encode(orders, _mappings(spark, root).where(F.col("value") != "P"), ["STATUS", "ABSENT"])


# ---------------------------------------------------------------- local dimensions


def _first_seen(column: str, source: str, order: str, name: str | None = None) -> str:
    return f"""SELECT '{name or column}' AS "column", {column} AS value, row_number() OVER
 (ORDER BY min({order}), {column}) AS id FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


@query(
    "dim_extract",
    " UNION ALL ".join(_first_seen(c, "part", "p_partkey") for c in ("p_name", "p_brand", "p_type")),
)
def _extract(spark, root):
    return local_dimensions(table(spark, root, "part"), ["p_name", "p_brand", "p_type"], "p_partkey")


@query(
    "dim_encode_fact",
    f"""SELECT p_partkey, p_size, b.id AS "p_brand_ID", t.id AS "p_type_ID", NULL::VARCHAR AS nothing
 FROM part LEFT JOIN ({_first_seen('p_brand', 'part', 'p_partkey')}) b ON b.value = p_brand
 LEFT JOIN ({_first_seen('v', "(SELECT p_partkey, nullif(p_type, 'PROMO') AS v FROM part)", 'p_partkey')}) t
 ON t.value = p_type""",
)
def _encode(spark, root):
    part = table(spark, root, "part").select(
        "p_partkey", "p_size", "p_brand", F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        F.lit(None).cast("string").alias("nothing"),
    )
    fact, _ = normalize_table(part, "p_partkey")
    return fact


def _raw_tables(spark, root):
    o = table(spark, root, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("STATUS"), F.col("o_orderpriority").alias("PRIORITY")
    )
    p = table(spark, root, "part").select("p_partkey", F.col("p_brand").alias("BRAND"), F.col("p_type").alias("KIND"))
    c = table(spark, root, "customer").select("c_custkey", F.col("c_mktsegment").alias("SEGMENT"))
    return {
        "orders": (o, "o_orderkey"), "part": (p, "p_partkey"), "customer": (c, "c_custkey"),
        "excluded": (c, "c_custkey"), "broken": (c, "no_such_column"),
    }


@query(
    "normalize_tables",
    f"""SELECT 'orders' AS "table", * FROM ({_first_seen('o_orderpriority', 'orders', 'o_orderkey', 'PRIORITY')})
 UNION ALL SELECT 'part', * FROM ({_first_seen('p_brand', 'part', 'p_partkey', 'BRAND')})
 UNION ALL SELECT 'part', * FROM ({_first_seen('p_type', 'part', 'p_partkey', 'KIND')})
 UNION ALL SELECT 'customer', * FROM ({_first_seen('c_mktsegment', 'customer', 'c_custkey', 'SEGMENT')})
 UNION ALL SELECT 'broken', 'error', NULL, NULL""",
)
def _normalize(spark, root):
    done, errors = normalize_tables(_raw_tables(spark, root), _mappings(spark, root), ["excluded"])
    frames = [
        dim.select(
            F.lit(name).alias("table"), F.lit(dim.columns[1]).alias("column"),
            F.col(dim.columns[1]).alias("value"), F.col(dim.columns[0]).alias("id"),
        )
        for name, (_, dims) in done.items() for dim in dims.values()
    ]
    failed = spark.createDataFrame(
        [(n, "error", None, None) for n in errors], "table string, column string, value string, id bigint"
    )
    return reduce(DataFrame.unionByName, [*frames, failed])


@query(
    "dim_overlap",
    """SELECT "column" AS dimension, string_agg(t, ',' ORDER BY t) AS tables FROM (
 SELECT DISTINCT 'STATUS' AS "column", 'orders' AS t FROM orders WHERE o_orderstatus IS NOT NULL
 UNION ALL SELECT DISTINCT 'PRIORITY', 'orders' FROM orders WHERE o_orderpriority IS NOT NULL
 UNION ALL SELECT DISTINCT 'STATUS', 'lineitem' FROM lineitem WHERE l_linestatus IS NOT NULL
 UNION ALL SELECT DISTINCT 'FLAG', 'lineitem' FROM lineitem WHERE l_returnflag IS NOT NULL)
 GROUP BY 1 HAVING count(*) > 1""",
)
def _overlap(spark, root):
    li = table(spark, root, "lineitem").select(
        "l_orderkey", F.col("l_linestatus").alias("STATUS"), F.col("l_returnflag").alias("FLAG")
    )
    o, _ = _raw_tables(spark, root)["orders"]
    found = [
        local_dimensions(df, columns, order).select(F.col("column").alias("dimension"), F.lit(name).alias("table"))
        for name, df, columns, order in (
            ("orders", o, ["STATUS", "PRIORITY"], "o_orderkey"), ("lineitem", li, ["STATUS", "FLAG"], "l_orderkey"),
        )
    ]
    overlap = dimension_overlap(found[0].unionByName(found[1]))
    return overlap.select("dimension", F.array_join("tables", ",").alias("tables"))


# ids of first appearance are moved to shared ids; the id without a partner stays
_PAIRS_SQL = f"""(SELECT a.id AS old, b.id AS new FROM ({_first_seen('o_orderstatus', 'orders', 'o_orderkey')}) a
 JOIN (SELECT * FROM {_MAPPING_SQL} WHERE "column" = 'STATUS') b ON a.value = b.value WHERE a.value <> 'P')"""


@query(
    "rekey_equivalence",
    f"""WITH f AS (SELECT d.id FROM orders LEFT JOIN ({_first_seen('o_orderstatus', 'orders', 'o_orderkey')}) d
 ON d.value = o_orderstatus) SELECT 'before' AS state, id AS value, count(*) AS n FROM f GROUP BY 2 UNION ALL
 SELECT 'after', coalesce(p.new, f.id), count(*) FROM f LEFT JOIN {_PAIRS_SQL} p ON p.old = f.id GROUP BY 2""",
)
def _rekey(spark, root):
    o = table(spark, root, "orders").select("o_orderkey", F.col("o_orderstatus").alias("STATUS"))
    dims = local_dimensions(o, ["STATUS"], "o_orderkey")
    fact = encode(o, dims, ["STATUS"])
    shared = _mappings(spark, root).where(F.col("column") == "STATUS")
    pairs = dims.select("value", F.col("id").alias("old")).join(
        shared.select("value", F.col("id").alias("new")), "value"
    ).where(F.col("value") != "P")
    after = rekey(fact, "STATUS_ID", pairs)
    states = {"before": fact, "after": after}
    frames = [value_counts(df, "STATUS_ID").select(F.lit(s).alias("state"), "value", "n") for s, df in states.items()]
    return frames[0].unionByName(frames[1])


# ---------------------------------------------------------------- types and values

_FLOATS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "part_tax")


@query(
    "integral_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", coalesce(bool_and({e} = floor({e})), false) AS integral FROM lineitem"""
        for c, e in zip(_FLOATS, (*_FLOATS[:4], "CASE WHEN l_tax = 0 THEN l_tax END"))
    ),
)
def _integral(spark, root):
    li = table(spark, root, "lineitem").withColumn("part_tax", F.when(F.col("l_tax") == 0, F.col("l_tax")))
    flags = integral_flags(li, _FLOATS)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"f{i}").alias("integral")) for i, c in enumerate(_FLOATS)]
    return flags.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


@query("nullable_integers", "SELECT l_orderkey, l_quantity::BIGINT AS l_quantity, l_tax FROM lineitem")
def _integers(spark, root):
    return to_nullable_integers(table(spark, root, "lineitem").select("l_orderkey", "l_quantity", "l_tax"))


@query(
    "value_listing",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {e}::VARCHAR AS value, count(*) AS n FROM lineitem GROUP BY 2"""
        for c, e in (
            ("l_linenumber", "l_linenumber"), ("l_quantity", "l_quantity::BIGINT"),
            ("l_returnflag", "l_returnflag"), ("l_linestatus", "l_linestatus"),
        )
    ),
)
def _listing(spark, root):
    columns = ["l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return value_listing(table(spark, root, "lineitem").select(*columns))


@query(
    "value_counts",
    """SELECT nullif(o_orderpriority, '3-MEDIUM') AS value, count(*) AS n FROM orders GROUP BY 1""",
)
def _counts(spark, root):
    o = table(spark, root, "orders").select(F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("p"))
    return value_counts(o, "p", drop_nulls=False)
