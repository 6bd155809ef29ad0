"""Denormalisation, dictionaries and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.incremental import holdout_truth
from ledgerloom.operators.lookup import (
    denormalize,
    dict_lookup,
    dictionary,
    reconstruct,
    rename_by_dimension,
    report,
)
from ledgerloom.operators.normalize import normalize_table
from ledgerloom.operators.quality import outer_difference
from ledgerloom.plans.registry.base import APPLICATIONS_SQL, applications, query, table

_ORDERS = """(SELECT o_orderkey, o_custkey, o_orderstatus AS "STATUS",
 nullif(o_orderpriority, '3-MEDIUM') AS "PRIORITY" FROM orders)"""


def raw_orders(spark, root):
    """Orders with two text columns, one of them with nulls."""
    return table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("STATUS"),
        F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("PRIORITY"),
    )


def normalized_orders(spark, root):
    """Fact and dimensions of the orders."""
    return normalize_table(raw_orders(spark, root), "o_orderkey")


@query("denormalize_by_convention", f"SELECT * FROM {_ORDERS}")
def _denormalize(spark, root):
    fact, dims = normalized_orders(spark, root)
    return denormalize(fact, dims)


@query(
    "reconstruct_from_metadata",
    f"""SELECT o_orderkey, "STATUS", NULL::VARCHAR AS "PRIORITY", NULL::VARCHAR AS "CHANNEL", o_custkey FROM {_ORDERS}""",
)
def _reconstruct(spark, root):
    fact, dims = normalized_orders(spark, root)
    # PRIORITY_ID is stored but not listed as a foreign key, CHANNEL is not stored at all
    return reconstruct(fact, ["o_orderkey", "STATUS", "PRIORITY", "CHANNEL", "o_custkey"], dims, {"STATUS_ID"})


_NATION = "(SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2)"


def _nations(spark, root):
    nation = table(spark, root, "nation").where(F.col("n_regionkey") != 2)
    return nation.select(F.col("n_nationkey").alias("NATION_ID"), F.col("n_name").alias("NATION"))


def _customers(spark, root):
    return table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").alias("NATION_ID"))


@query(
    "dict_lookup",
    f"""SELECT c_custkey, n_name AS "NATION" FROM customer LEFT JOIN {_NATION} ON c_nationkey = n_nationkey""",
)
def _lookup(spark, root):
    return dict_lookup(_customers(spark, root), _nations(spark, root), "NATION_ID", "NATION")


@query(
    "dict_lookup_default",
    f"""SELECT c_custkey, coalesce(n_name, '') AS "NATION" FROM customer
 LEFT JOIN {_NATION} ON c_nationkey = n_nationkey""",
)
def _lookup_default(spark, root):
    dictionaries = {"dict_dim_nation": _nations(spark, root)}
    return report(_customers(spark, root), dictionaries, default="")


# a lookup above the broadcast bound is joined by salted keys instead
@query(
    "lookup_salted",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_custkey FROM lineitem LEFT JOIN
 (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""",
)
def _salted(spark, root):
    from ledgerloom.operators.joins import lookup_join

    o = table(spark, root, "orders").where(F.col("o_orderstatus") != "P")
    li = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lookup_join(li, o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", max_rows=0)


@query(
    "dictionaries",
    """SELECT c_nationkey AS nation, min(c_custkey) AS first_customer FROM customer GROUP BY 1""",
)
def _dictionaries(spark, root):
    c = table(spark, root, "customer")
    repeated = c.select(
        F.nullif(F.col("c_nationkey"), F.lit(-1)).alias("nation"), F.col("c_custkey").alias("first_customer")
    )
    return dictionary(repeated)


@query(
    "rename_by_dim",
    """SELECT o_orderkey, o_custkey AS "SK_ID_CURR", s.id AS "STATUS" FROM orders JOIN
 (SELECT o_orderstatus AS v, row_number() OVER (ORDER BY min(o_orderkey)) AS id FROM orders GROUP BY 1) s
 ON s.v = o_orderstatus""",
)
def _rename(spark, root):
    fact, dims = normalized_orders(spark, root)
    kept = fact.drop("PRIORITY_ID").withColumnRenamed("o_custkey", "SK_ID_CURR")
    return rename_by_dimension(kept, dims)


@query(
    "holdout_anti_join",
    f"""SELECT "SK_ID_CURR", "TARGET" FROM {APPLICATIONS_SQL} WHERE "SK_ID_CURR" NOT IN (SELECT user_id FROM events)""",
)
def _anti(spark, root):
    known = table(spark, root, "events").select(F.col("user_id").alias("SK_ID_CURR"))
    return holdout_truth(applications(spark, root), known, "SK_ID_CURR", "TARGET")


@query(
    "truth_join",
    """SELECT d.doc_id, n_chars, quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
)
def _truth(spark, root):
    return table(spark, root, "documents").select("doc_id", "n_chars").join(
        table(spark, root, "labels").select("doc_id", "quality"), "doc_id"
    )


@query(
    "diff_full_outer",
    """WITH a AS (SELECT l_suppkey, l_quantity, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
 b AS (SELECT l_suppkey, CASE WHEN l_linestatus = 'O' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
 l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
 SELECT l_suppkey, l_quantity, l_returnflag, coalesce(a.n, 0) AS left_copies, coalesce(b.n, 0) AS right_copies
 FROM a FULL JOIN b USING (l_suppkey, l_quantity, l_returnflag) WHERE a.n IS DISTINCT FROM b.n""",
)
def _outer(spark, root):
    li = table(spark, root, "lineitem")
    columns = ["l_suppkey", "l_quantity", "l_returnflag"]
    changed = F.when(F.col("l_linestatus") == "O", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return outer_difference(li.select(*columns), li.withColumn("l_quantity", changed).select(*columns))
