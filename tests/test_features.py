"""Aggregation rules on tiny frames."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ledgerloom.operators.features import aggregate_by_key, bridge_aggregate, feature_table
from ledgerloom.operators.mlprep import split_features_target
from ledgerloom.plans.feature_build import build_features
from ledgerloom.sources.tables import scan_table, write_table


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_aggregate_rules(spark):
    rows = [(1, 10.0, "a", 7, True), (1, float("nan"), None, 8, True), (2, None, "b", 9, False), (None, 3.0, "c", 1, True)]
    df = spark.createDataFrame(rows, "k int, x double, t string, _DW_ID int, flag boolean")
    got = _by(aggregate_by_key(df, "k", "p"), "k")
    assert set(got[1]) == {"k", "p__row_count", "p__t__nunique", *[f"p__x__{s}" for s in ("mean", "min", "max", "sum", "std")]}
    assert got[1]["p__row_count"] == 2 and got[1]["p__x__mean"] == 10.0 and got[1]["p__x__max"] == 10.0
    # null is a value of its own, an all-null sum is 0, one row has no deviation
    assert got[1]["p__t__nunique"] == 2 and got[2]["p__t__nunique"] == 1
    assert got[2]["p__x__sum"] == 0.0 and got[2]["p__x__mean"] is None and got[1]["p__x__std"] is None
    assert got[None]["p__row_count"] == 1 and got[None]["p__t__nunique"] == 1
    assert set(_by(aggregate_by_key(df, "k", "p", keep_null_key=False), "k")) == {1, 2}


def test_bridge_keeps_rows_without_children(spark):
    bridge = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 20)], "e int, b int")
    child = spark.createDataFrame([(10, 4), (10, 6)], "b int, m int")
    got = _by(bridge_aggregate(child, bridge, "b", "e", "bb"), "e")
    assert got[1]["bb__row_count"] == 2 and got[2]["bb__row_count"] == 1
    assert got[1]["bb__bb_by_bureau__m__mean__mean"] == 5.0
    assert got[1]["bb__bb_by_bureau__row_count__sum"] == 2 and got[2]["bb__bb_by_bureau__row_count__sum"] == 0
    assert got[2]["bb__bb_by_bureau__m__mean__mean"] is None


def _tables(spark, folder):
    base = spark.createDataFrame([(1, 0, 100.0), (2, 1, 200.0), (2, 1, 200.0), (3, 0, 50.0)], "SK_ID_CURR long, TARGET long, AMT_CREDIT double")
    bureau = spark.createDataFrame(
        [(1, 10, 5.0, "Active"), (1, 11, 7.0, "Closed"), (2, 20, 9.0, "Active")],
        "SK_ID_CURR long, SK_ID_BUREAU long, AMT_CREDIT_SUM double, CREDIT_ACTIVE string",
    )
    balance = spark.createDataFrame([(10, 0), (10, -1), (20, 0)], "SK_ID_BUREAU long, MONTHS_BALANCE long")
    write_table(base, f"{folder}/rep_application_train.parquet")
    write_table(bureau, f"{folder}/rep_bureau.parquet")
    write_table(balance, f"{folder}/rep_bureau_balance.parquet")
    from ledgerloom.plans.config import FEATURE_TABLES, settings

    return settings(feature_tables={k: FEATURE_TABLES[k] for k in ("bureau", "bureau_balance")})


def test_feature_build_has_one_row_per_entity(spark, folder):
    config = _tables(spark, folder)
    got = _by(build_features(spark, folder, config), "SK_ID_CURR")
    assert set(got) == {1, 2, 3}
    assert got[1]["bureau__row_count"] == 2 and got[3]["bureau__row_count"] is None
    assert got[1]["bureau__credit_active__nunique"] == 2
    assert got[1]["bureau_balance__bureau_balance_by_bureau__row_count__max"] == 2


def test_feature_build_scopes(spark, folder):
    config = _tables(spark, folder)
    limited = _by(build_features(spark, folder, config, limit=1), "SK_ID_CURR")
    assert set(limited) == {1} and limited[1]["bureau__row_count"] == 2
    ids = spark.createDataFrame([(2,), (99,)], "SK_ID_CURR long")
    chosen = _by(build_features(spark, folder, config, entity_ids=ids), "SK_ID_CURR")
    assert set(chosen) == {2} and chosen[2]["bureau__amt_credit_sum__sum"] == 9.0


def test_alias_scan(spark, folder):
    _tables(spark, folder)
    assert scan_table(spark, folder, "application_train", ["SK_ID_CURR", "TARGET"]).count() == 4
    assert scan_table(spark, folder, "bureau", limit=0).count() == 0
    ids = spark.createDataFrame([], "SK_ID_CURR long")
    assert scan_table(spark, folder, "bureau", entity_ids=ids, entity_key="SK_ID_CURR").count() == 0
    try:
        scan_table(spark, folder, "nothing")
    except FileNotFoundError:
        pass
    else:
        raise AssertionError("a missing table must be an error")


def test_base_without_children(spark):
    base = spark.createDataFrame([(1, "a"), (1, "a")], "k int, t string")
    assert feature_table(base, "k", {}).collect() == [(1, "a")]


def test_target_split(spark):
    df = spark.createDataFrame([(1, 0, 100, 1.5), (2, 1, 200, 2.5)], "SK_ID_CURR long, TARGET long, _DW_ID long, feature double")
    features, target = split_features_target(df, "TARGET", ["_DW_ID", "SK_ID_CURR"])
    assert features.columns == ["feature"] and target == "TARGET"
    assert split_features_target(features, "TARGET", require_target=False)[1] is None
    try:
        split_features_target(features, "TARGET")
    except ValueError:
        pass
    else:
        raise AssertionError("a missing target must be an error")


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").cast("double").alias("x")
    )
    plan = aggregate_by_key(df, "k", "p")._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
    got = aggregate_by_key(df, "k", "p").where("k = 1").first()
    assert got["p__row_count"] == 10000 + 1 and math.isclose(got["p__x__max"], 29997.0)


def test_wide_rows_are_prepared_without_one_method_over_all_columns(spark, monkeypatch):
    """The session's setting is lower while rows are prepared, and comes back whoever leaves last."""
    from ledgerloom.operators import models
    from ledgerloom.sources.staging import FEW_FIELDS, wide_rows

    name, seen = "spark.sql.codegen.maxFields", []
    before = spark.conf.get(name)
    stage = models.stage
    monkeypatch.setattr(models, "stage", lambda df, label: seen.append(spark.conf.get(name)) or stage(df, label))
    rows = spark.range(60).selectExpr("id", "cast(id % 3 = 0 as int) as target", *[f"id % {n + 2} as c{n}" for n in range(70)])
    _, ready, columns = models.prepare_splits(rows, "id", "target", [], 1, 42)
    assert ready.count() == 60 and len(columns) == 70
    assert seen == [str(FEW_FIELDS)] * 2
    first, second = wide_rows(spark), wide_rows(spark)
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == str(FEW_FIELDS)
    second.__exit__(None, None, None)
    assert spark.conf.get(name) == before
