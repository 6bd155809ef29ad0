"""Aggregation to the entity and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.features import aggregate_by_key, bridge_aggregate, feature_table
from ledgerloom.operators.joins import left_join_all
from ledgerloom.operators.lookup import preagg_join
from ledgerloom.plans.registry.base import (
    APPLICATIONS_SQL,
    BALANCES_SQL,
    CREDITS_SQL,
    applications,
    balances,
    credits,
    cut_statistics,
    fixed,
    fixed_sql,
    nunique_sql,
    query,
    stats_sql,
    table,
)

_EVENTS_SQL = """(SELECT user_id, event_type, round(value * 100)::BIGINT AS cents, event_id FROM events)"""


def _credit_columns(prefix: str) -> str:
    return ", ".join(
        [
            f"count(*) AS {prefix}__row_count",
            stats_sql('"SK_ID_BUREAU"', prefix, "sk_id_bureau"),
            stats_sql('"CENTS"', prefix, "cents"),
            nunique_sql('"STATUS"', prefix, "status"),
            nunique_sql('"PRIORITY"', prefix, "priority"),
        ]
    )


_CREDIT_AGG = f"""SELECT "SK_ID_CURR", {_credit_columns('bureau')} FROM {CREDITS_SQL} GROUP BY 1"""


def _bridge_sql(prefix: str, credits_sql: str = CREDITS_SQL, balances_sql: str = BALANCES_SQL) -> str:
    one = f"{prefix}_by_bureau"
    first = ", ".join(
        [
            f"count(*) AS {one}__row_count",
            stats_sql('"QUANTITY"', one, "quantity", final=False),
            nunique_sql('"FLAG"', one, "flag"),
        ]
    )
    whole = [f"{one}__row_count", *[f"{one}__quantity__{s}" for s in ("min", "max", "sum")], f"{one}__flag__nunique"]
    floating = [f"{one}__quantity__{s}" for s in ("mean", "std")]
    second = ", ".join(
        [f"count(*) AS {prefix}__row_count"]
        + [stats_sql(c, prefix, c) for c in whole]
        + [stats_sql(c, prefix, c, floating=True) for c in floating]
    )
    return f"""SELECT "SK_ID_CURR", {second}
 FROM (SELECT DISTINCT "SK_ID_CURR", "SK_ID_BUREAU" FROM {credits_sql}) b
 LEFT JOIN (SELECT "SK_ID_BUREAU", {first} FROM {balances_sql} GROUP BY 1) c USING ("SK_ID_BUREAU")
 GROUP BY 1"""


_EVENT_AGG = f"""SELECT user_id AS "SK_ID_CURR", count(*) AS events__row_count,
 {stats_sql('event_id', 'events', 'event_id')}, {stats_sql('cents', 'events', 'cents')},
 {nunique_sql('event_type', 'events', 'event_type')} FROM {_EVENTS_SQL} GROUP BY 1"""


def _events(spark, root):
    e = table(spark, root, "events")
    return e.select("user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"), "event_id")


@query("aggregate_by_key", _CREDIT_AGG)
def _aggregate(spark, root):
    return cut_statistics(aggregate_by_key(credits(spark, root), "SK_ID_CURR", "bureau"))


# half of the customers' orders get no key: the null key is a group of its own
_NULL_KEY = f"""(SELECT CASE WHEN "SK_ID_BUREAU" % 3 = 0 THEN NULL ELSE "SK_ID_CURR" END AS "SK_ID_CURR",
 "CENTS", "STATUS" FROM {CREDITS_SQL})"""


@query(
    "aggregate_null_key",
    f"""SELECT "SK_ID_CURR", count(*) AS b__row_count, {stats_sql('"CENTS"', 'b', 'cents')},
 {nunique_sql('"STATUS"', 'b', 'status')} FROM {_NULL_KEY} GROUP BY 1""",
)
def _aggregate_null_key(spark, root):
    c = credits(spark, root)
    key = F.when(F.col("SK_ID_BUREAU") % 3 != 0, F.col("SK_ID_CURR")).alias("SK_ID_CURR")
    return cut_statistics(aggregate_by_key(c.select(key, "CENTS", "STATUS"), "SK_ID_CURR", "b"))


@query("bridge_aggregate", _bridge_sql("bureau_balance"))
def _bridge(spark, root):
    frame = bridge_aggregate(
        balances(spark, root), credits(spark, root), "SK_ID_BUREAU", "SK_ID_CURR", "bureau_balance"
    )
    return cut_statistics(frame)


@query(
    "feature_join",
    f"""SELECT * FROM {APPLICATIONS_SQL} a LEFT JOIN ({_CREDIT_AGG}) b USING ("SK_ID_CURR")
 LEFT JOIN ({_EVENT_AGG}) e USING ("SK_ID_CURR")""",
)
def _feature_join(spark, root):
    frames = [
        aggregate_by_key(credits(spark, root), "SK_ID_CURR", "bureau", keep_null_key=False),
        aggregate_by_key(_events(spark, root), "user_id", "events", keep_null_key=False)
        .withColumnRenamed("user_id", "SK_ID_CURR"),
    ]
    return cut_statistics(left_join_all(applications(spark, root), frames, "SK_ID_CURR"))


def _children(spark, root):
    bridge = credits(spark, root)
    return {
        "bureau": {"table": bridge, "key": "SK_ID_CURR"},
        "bureau_balance": {
            "table": balances(spark, root), "bridge": bridge, "bridge_key": "SK_ID_BUREAU",
            "key": "SK_ID_CURR",
        },
        "events": {"table": _events(spark, root), "key": "user_id"},
    }


def _feature_sql(base: str) -> str:
    return f"""SELECT * FROM {base} a LEFT JOIN ({_CREDIT_AGG}) b USING ("SK_ID_CURR")
 LEFT JOIN ({_bridge_sql('bureau_balance')}) bb USING ("SK_ID_CURR")
 LEFT JOIN ({_EVENT_AGG}) e USING ("SK_ID_CURR")"""


def wide_features(spark, root):
    """The feature table of the test data, before it is cut for comparison."""
    return feature_table(applications(spark, root), "SK_ID_CURR", _children(spark, root))


@query("feature_table", _feature_sql(APPLICATIONS_SQL))
def feature_table_query(spark, root):
    return cut_statistics(wide_features(spark, root))


_SCOPE = """(SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')"""


@query(
    "feature_table_scoped",
    _feature_sql(f'(SELECT * FROM {APPLICATIONS_SQL} WHERE "SK_ID_CURR" IN {_SCOPE})'),
)
def _scoped(spark, root):
    ids = table(spark, root, "events").where(F.col("event_type") == "purchase").select("user_id")
    base = applications(spark, root)
    return cut_statistics(feature_table(base, "SK_ID_CURR", _children(spark, root), ids))


@query(
    "preagg_join",
    f"""SELECT a."SK_ID_CURR", a."TARGET", b.credits, b.cents, {fixed_sql('b.mean_cents')} AS mean_cents
 FROM {APPLICATIONS_SQL} a LEFT JOIN (SELECT "SK_ID_CURR", count(*) AS credits,
 sum("CENTS")::BIGINT AS cents, avg("CENTS") AS mean_cents FROM {CREDITS_SQL} GROUP BY 1) b
 USING ("SK_ID_CURR")""",
)
def _preagg(spark, root):
    joined = preagg_join(
        applications(spark, root), credits(spark, root), "SK_ID_CURR",
        {"credits": F.count(F.lit(1)), "cents": F.sum("CENTS"), "mean_cents": F.avg("CENTS")},
    )
    return joined.select(
        "SK_ID_CURR", "TARGET", "credits", "cents", fixed(F.col("mean_cents")).alias("mean_cents")
    )
