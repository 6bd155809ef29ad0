"""Catalogs and key metadata, each measured on the data it describes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.profile import column_profile
from ledgerloom.operators.quality import column_sets, pk_uniqueness
from ledgerloom.plans.registry.base import query, table
from ledgerloom.sources.catalog import (
    constraint_kind,
    key_candidates,
    key_metadata,
    measured_catalog,
    name_sets,
    schema_catalog,
    schema_report,
    shared_column_report,
    shared_columns,
    table_groups,
    type_inventory,
)
from ledgerloom.sources.tables import file_catalog

# table: source, then (column, type, expression); the expressions are valid in both engines
_MODEL = {
    "application": ("customer", (
        ("SK_ID_CURR", "bigint", "c_custkey"), ("NATION_ID", "int", "c_nationkey"), ("NAME", "string", "c_name"),
        ("SEGMENT", "string", "nullif(c_mktsegment, 'BUILDING')"),
    )),
    "bureau": ("orders", (
        ("SK_ID_CURR", "bigint", "o_custkey"), ("SK_ID_BUREAU", "bigint", "o_orderkey"),
        ("STATUS", "string", "nullif(o_orderstatus, 'P')"), ("PRIORITY", "string", "o_orderpriority"),
    )),
    "bureau_balance": ("lineitem", (
        ("SK_ID_BUREAU", "bigint", "l_orderkey"), ("PART_ID", "bigint", "l_partkey"), ("STATUS", "string", "l_linestatus"),
    )),
    "vendor": ("supplier", (("NATION_ID", "int", "s_nationkey"), ("NAME", "string", "s_name"))),
    "dim_nation": ("nation", (("NATION_ID", "int", "n_nationkey"), ("NATION", "string", "n_name"))),
    "dim_part": ("part", (("PART_ID", "bigint", "p_partkey"), ("PART", "string", "p_name"))),
}


def _tables(spark, root):
    return {
        name: table(spark, root, source).select(*[F.expr(e).alias(c) for c, _, e in columns])
        for name, (source, columns) in _MODEL.items()
    }


def _per_column(select) -> str:
    """UNION of ``select(table, position, column, type, expression)`` over the model."""
    return " UNION ALL ".join(
        f"SELECT {select(t, i + 1, c, k, e)} FROM {source}"
        for t, (source, columns) in _MODEL.items() for i, (c, k, e) in enumerate(columns)
    )


_CATALOG_SQL = _per_column(
    lambda t, i, c, k, e: f"""'{t}' AS "table", {i} AS position, '{c}' AS "column", '{k}' AS type, true AS nullable,
 count(*) AS rows, count({e}) AS non_null"""
)


@query("column_details", _CATALOG_SQL)
def _details(spark, root):
    return measured_catalog(spark, _tables(spark, root)).orderBy("table", "position")


@query(
    "type_inventory",
    f"""SELECT *, CASE WHEN "column" LIKE '%ID%' AND type <> 'bigint' THEN 1 ELSE 0 END AS odd_id_type
 FROM ({_CATALOG_SQL})""",
)
def _types(spark, root):
    return type_inventory(measured_catalog(spark, _tables(spark, root)))


@query(
    "shared_columns",
    f"""SELECT "column", string_agg("table", ',' ORDER BY "table") AS tables, count(*)::INTEGER AS n_tables,
 sum(non_null)::BIGINT AS non_null FROM ({_CATALOG_SQL}) GROUP BY 1 HAVING count(*) > 1 AND min_by(type, "table") = 'string'""",
)
def _shared(spark, root):
    catalog = measured_catalog(spark, _tables(spark, root))
    totals = catalog.groupBy("column").agg(F.sum("non_null").alias("non_null"))
    found = shared_columns(catalog).withColumn("tables", F.array_join("tables", ","))
    return found.join(totals, "column")


@query(
    "shared_column_report",
    "WITH v AS ("
    + " UNION ALL ".join(
        f"""SELECT DISTINCT '{t}' AS "table", '{c}' AS "column", '{k}' AS type, ({e})::VARCHAR AS value FROM {source}"""
        for t, (source, columns) in _MODEL.items() for c, k, e in columns
    )
    + """), c AS (SELECT DISTINCT "table", "column", type FROM v),
 r AS (SELECT *, row_number() OVER (PARTITION BY "table", "column" ORDER BY value) AS n FROM v WHERE value IS NOT NULL),
 s AS (SELECT "table", "column", string_agg(value, ';' ORDER BY value) AS sample_values FROM r WHERE n <= 10 GROUP BY 1, 2),
 o AS (SELECT a."table", a."column", a.type, string_agg(b."table", ',' ORDER BY b."table") AS other_tables
 FROM c a JOIN c b ON a."column" = b."column" AND a."table" <> b."table" GROUP BY 1, 2, 3)
 SELECT * FROM o LEFT JOIN s USING ("table", "column")""",
)
def _shared_report(spark, root):
    tables = _tables(spark, root)
    report = shared_column_report(schema_catalog(spark, tables), tables)
    return report.withColumns(
        {"other_tables": F.array_join("other_tables", ","), "sample_values": F.array_join("sample_values", ";")}
    )


_MAPPED = "(SELECT DISTINCT 'STATUS' AS c FROM orders WHERE o_orderstatus IS NOT NULL)"


@query(
    "table_groups",
    f"""SELECT "table", CASE WHEN bool_or("column" IN (SELECT c FROM {_MAPPED})) THEN 'mapped' ELSE 'unmapped' END AS "group",
 max(rows) AS rows FROM ({_CATALOG_SQL}) WHERE "table" <> 'vendor' GROUP BY 1""",
)
def _groups(spark, root):
    catalog = measured_catalog(spark, _tables(spark, root))
    statuses = table(spark, root, "orders").where(F.col("o_orderstatus").isNotNull())
    mapped = statuses.select(F.lit("status").alias("column")).distinct()
    groups = table_groups(catalog, mapped, ["vendor"])
    return groups.join(catalog.groupBy("table").agg(F.max("rows").alias("rows")), "table")


# ---------------------------------------------------------------- keys

_KEYS = {
    "application": ("SK_ID_CURR", "NATION_ID", "customer", ("c_custkey",)),
    "bureau": ("SK_ID_CURR,SK_ID_BUREAU", "", "orders", ("o_custkey", "o_orderkey")),
    "bureau_balance": ("SK_ID_BUREAU", "PART_ID", "lineitem", ("l_orderkey",)),
    "dim_nation": ("NATION_ID", "", "nation", ("n_nationkey",)),
    "dim_part": ("PART_ID", "", "part", ("p_partkey",)),
}


@query(
    "key_metadata",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{pk}' AS pk, '{fk}' AS fk, sum(n)::BIGINT AS rows, count(*) AS distinct_keys,
 CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'PRIMARY KEY' ELSE 'INDEX' END AS kind
 FROM (SELECT {', '.join(k)}, count(*) AS n FROM {source} GROUP BY ALL)"""
        for t, (pk, fk, source, k) in _KEYS.items()
    ) + " UNION ALL SELECT 'vendor', '', 'NATION_ID', NULL, NULL, NULL",
)
def _keys(spark, root):
    tables = _tables(spark, root)
    metadata = key_metadata(schema_catalog(spark, tables))
    # one metadata row per table
    checks = [
        pk_uniqueness(tables[r["table"]], r["table"], r["pk"]) for r in metadata.collect() if r["pk"]
    ]
    checked = reduce(DataFrame.unionByName, checks).select("table", "rows", "distinct_keys", "kind")
    text = {c: F.array_join(c, ",") for c in ("pk", "fk")}
    return metadata.withColumns(text).join(checked, "table", "left")


_FK_SQL = """"column" LIKE '%\\_ID' ESCAPE '\\' AND "table" NOT LIKE 'dim\\_%' ESCAPE '\\'"""


@query(
    "key_candidates",
    f"""SELECT "table", "column", CASE WHEN {_FK_SQL} THEN concat('FOREIGN KEY (', "column", ') REFERENCES dim_',
 lower(left("column", length("column") - 3)), '(', "column", ')') ELSE concat('PRIMARY KEY (', "column", ')') END AS ddl,
 non_null FROM ({_CATALOG_SQL}) WHERE "column" LIKE '%ID%'""",
)
def _candidates(spark, root):
    catalog = measured_catalog(spark, _tables(spark, root))
    return key_candidates(catalog).join(catalog.select("table", "column", "non_null"), ["table", "column"])


_STATS_SQL = _per_column(
    lambda t, i, c, k, e: f"""'{t}' AS "table", '{c}' AS "column", count(*) AS rows, count(*) - count({e}) AS null_count,
 count(DISTINCT {e}) AS distinct_values"""
)
_KEYED_SQL = f"""SELECT "table", "column", CASE WHEN "column" LIKE '%ID%' AND distinct_values = rows THEN 'PRI'
 WHEN "column" LIKE '%ID%' THEN 'MUL' WHEN distinct_values = rows THEN 'UNI' END AS key,
 CASE WHEN "column" IN ('NATION_ID', 'PART_ID') AND "table" NOT LIKE 'dim%' THEN
 CASE "column" WHEN 'NATION_ID' THEN 'dim_nation' ELSE 'dim_part' END END AS referenced_table FROM ({_STATS_SQL})"""


def _measured_statistics(spark, root):
    tables = _tables(spark, root)
    parts = [
        column_profile(df).select(F.lit(n).alias("table"), "column", "null_count", "distinct_values")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _key_usage(spark, root):
    metadata = key_metadata(schema_catalog(spark, _tables(spark, root)))
    used = metadata.select("table", F.explode("fk").alias("column"))
    base = F.lower(F.expr("left(column, length(column) - 3)"))
    return used.withColumn("referenced_table", F.concat(F.lit("dim_"), base))


@query(
    "constraint_kind",
    f"""SELECT *, CASE WHEN key = 'PRI' THEN 'PRIMARY KEY' WHEN referenced_table IS NOT NULL THEN 'FOREIGN KEY'
 WHEN key = 'UNI' THEN 'UNIQUE INDEX' WHEN key = 'MUL' THEN 'INDEX (Non-Unique)' ELSE 'NONE' END AS kind
 FROM ({_KEYED_SQL})""",
)
def _kinds(spark, root):
    rows = measured_catalog(spark, _tables(spark, root)).select("table", "column", "rows")
    stats = _measured_statistics(spark, root).join(rows, ["table", "column"])
    unique, has_id = F.col("distinct_values") == F.col("rows"), F.col("column").contains("ID")
    key = F.when(has_id & unique, "PRI").when(has_id, "MUL").when(unique, "UNI")
    keyed = stats.select("table", "column", key.alias("key"))
    return constraint_kind(keyed.join(_key_usage(spark, root), ["table", "column"], "left"))


@query(
    "schema_report",
    f"""SELECT c."table", c.position, c."column", c.type, c.nullable, k.referenced_table, s.null_count, s.distinct_values
 FROM ({_CATALOG_SQL}) c LEFT JOIN ({_KEYED_SQL}) k USING ("table", "column") LEFT JOIN ({_STATS_SQL}) s
 USING ("table", "column")""",
)
def _schema(spark, root):
    columns = schema_catalog(spark, _tables(spark, root))
    return schema_report(columns, _key_usage(spark, root), _measured_statistics(spark, root))


# ---------------------------------------------------------------- sets


@query(
    "table_name_sets",
    """SELECT 'customer' AS "table", 'both' AS side, (SELECT count(*) FROM customer) AS rows UNION ALL
 SELECT 'orders', 'both', (SELECT count(*) FROM orders) UNION ALL
 SELECT 'archive', 'right', NULL UNION ALL """
    + " UNION ALL ".join(
        f"SELECT '{t}', 'left', (SELECT count(*) FROM {t})"
        for t in "region nation supplier part lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
)
def _names(spark, root):
    found = file_catalog(spark, root, "*.parquet")
    other = spark.createDataFrame([("customer",), ("orders",), ("archive",)], "table string")
    counts = [
        table(spark, root, r["table"]).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(r["table"]).alias("table"), "rows")
        for r in found.select("table").collect()
    ]
    return name_sets(found, other, "table").join(reduce(DataFrame.unionByName, counts), "table", "left")


@query(
    "column_sets",
    """SELECT 'l_orderkey' AS "column", 'common' AS side, count(l_orderkey) AS non_null FROM lineitem
 UNION ALL SELECT 'l_quantity', 'common', count(l_quantity) FROM lineitem
 UNION ALL SELECT 'l_tax', 'missing', count(l_tax) FROM lineitem
 UNION ALL SELECT 'note', 'extra', count(nullif(l_returnflag, 'A')) FROM lineitem""",
)
def _columns(spark, root):
    li = table(spark, root, "lineitem")
    left = li.select("l_orderkey", "l_quantity", "l_tax")
    right = li.select("l_orderkey", "l_quantity", F.nullif("l_returnflag", F.lit("A")).alias("note"))
    sides = [(c, side) for side, names in column_sets(left, right).items() for c in names]
    counts = measured_catalog(spark, {"left": left, "right": right})
    measured = counts.groupBy("column").agg(F.max("non_null").alias("non_null"))
    return spark.createDataFrame(sides, "column string, side string").join(measured, "column")
