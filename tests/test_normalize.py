"""Normal form, mappings, dictionaries, round trips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.naming import description_column, matching_dictionary, storage_keys
from ledgerloom.functions.text import model_from_file_name, type_label, without_type
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.lookup import denormalize, dict_lookup, dictionary, report
from ledgerloom.operators.normalize import (
    common_dimension,
    encode,
    integral_columns,
    load_mappings,
    normalize_table,
    rekey,
    to_nullable_integers,
)
from ledgerloom.operators.quality import table_fingerprint
from ledgerloom.plans.normalization import normalize_to, shared_mappings


@pytest.mark.parametrize(
    ("raw", "label", "rest"),
    [
        ("Business Entity Type 3", "Type 3", "Business Entity"),
        ("Trade: type 7", "Type 7", "Trade"),
        ("Industry-TYPE12", "Type 12", "Industry"),
        ("Type 1", "Type 1", "Type 1"),
        ("XNA", "Type 0", "XNA"),
        (None, "Type 0", None),
    ],
)
def test_atomic_values(spark, raw, label, rest):
    df = spark.createDataFrame([(raw,)], "c string")
    assert tuple(df.select(type_label(F.col("c")), without_type(F.col("c"))).first()) == (label, rest)


def test_shared_mappings(spark, folder):
    mappings = shared_mappings(spark)
    sizes = {r["column"]: r["count"] for r in mappings.groupBy("column").count().collect()}
    assert sizes == {
        "NAME_CONTRACT_TYPE": 4, "NAME_TYPE_SUITE": 7, "WEEKDAY_APPR_PROCESS_START": 7, "NAME_CONTRACT_STATUS": 12,
    }
    dim = common_dimension(mappings, "WEEKDAY_APPR_PROCESS_START")
    assert dim.columns == ["WEEKDAY_APPR_PROCESS_START_ID", "WEEKDAY_APPR_PROCESS_START"]
    df = spark.createDataFrame([(1, "MONDAY"), (2, "NODAY"), (3, None)], "k int, WEEKDAY_APPR_PROCESS_START string")
    got = encode(df, mappings, ["WEEKDAY_APPR_PROCESS_START"])
    assert {tuple(r) for r in got.collect()} == {(1, 1), (2, None), (3, None)}
    with open(f"{folder}/m.json", "w") as file:
        file.write('[{"a": {"x": 1,\n "y": 2}}, {"b": {"z": 9}}]')
    assert {tuple(r) for r in load_mappings(spark, f"{folder}/m.json").collect()} == {
        ("A", "x", 1), ("A", "y", 2), ("B", "z", 9),
    }


def _raw(spark):
    rows = [
        (1, "Cash loans", "Self-employed", "b", None), (2, "XNA", "Business Entity Type 3", "a", None),
        (3, None, None, "b", None), (4, "Cash loans", "Type 1", None, None),
    ]
    return spark.createDataFrame(
        rows, "SK_ID_CURR int, NAME_CONTRACT_TYPE string, ORGANIZATION_TYPE string, T string, NOTHING string"
    )


def test_normalize_and_back(spark):
    mappings = shared_mappings(spark)
    fact, dims = normalize_table(_raw(spark), "SK_ID_CURR", mappings, ["NAME_CONTRACT_TYPE"])
    assert fact.columns == [
        "SK_ID_CURR", "NAME_CONTRACT_TYPE_ID", "ORGANIZATION_TYPE_ID", "T_ID", "NOTHING", "ORGANIZATION_TYPE_2_ID",
    ]
    assert {tuple(r) for r in dims["dim_t"].collect()} == {(1, "b"), (2, "a")}
    assert {tuple(r) for r in dims["dim_organization_type_2"].collect()} == {(1, "Type 0"), (2, "Type 3"), (3, "Type 1")}
    all_dims = {**dims, "dim_name_contract_type": common_dimension(mappings, "NAME_CONTRACT_TYPE")}
    back = denormalize(fact, all_dims).select("SK_ID_CURR", "NAME_CONTRACT_TYPE", "T", "NOTHING")
    want = _raw(spark).select("SK_ID_CURR", "NAME_CONTRACT_TYPE", "T", "NOTHING")
    assert table_fingerprint(back).first() == table_fingerprint(want).first()


def test_normalize_to_disk_isolates_a_failing_table(spark, folder):
    tables = {"good": (_raw(spark), "SK_ID_CURR"), "bad": (_raw(spark), "NO_COLUMN"), "application_test": (_raw(spark), "SK_ID_CURR")}
    written, errors = normalize_to(spark, tables, shared_mappings(spark), folder)
    assert set(errors) == {"bad"} and f"{folder}/good/good.parquet" in written
    assert not any("application_test" in p for p in written)
    assert spark.read.parquet(f"{folder}/common_dims/dim_name_type_suite.parquet").count() == 7


def test_rekey_keeps_unmapped_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    pairs = spark.createDataFrame([(1, 7)], "old long, new long")
    assert {r["id"] for r in rekey(df, "id", pairs).collect()} == {7, 2, None}


def test_integral_columns(spark):
    rows = [(1.0, 1.5, None, float("nan")), (None, 2.0, None, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, empty double, n double")
    assert integral_columns(df) == ["a", "n"]
    assert dict(to_nullable_integers(df).dtypes) == {"a": "bigint", "b": "double", "empty": "double", "n": "bigint"}


def test_whole_numbers_of_a_fact_become_integers(spark):
    df = spark.createDataFrame([(1, 2.0, 2.5, "a"), (2, None, 1.0, "b")], "k int, n double, x double, t string")
    fact, _ = normalize_table(df, "k")
    assert dict(fact.dtypes) == {"k": "int", "n": "bigint", "x": "double", "t_ID": "bigint"}


def test_dictionary_matching():
    names = {"dict_dim_organization_type", "dict_dim_status"}
    assert matching_dictionary("STATUS_ID", names) == "dict_dim_status"
    assert matching_dictionary("ORGANIZATION_TYPE_2_ID", names) == "dict_dim_organization_type"
    assert matching_dictionary("ORGANIZATION_TYPE_2_ID", {*names, "dict_dim_organization_type_2"}) == "dict_dim_organization_type_2"
    assert matching_dictionary("STATUS", names) is None and matching_dictionary("OTHER_ID", names) is None
    assert description_column(["S_ID", "OTHER_ID", "S"], "S_ID") == "S" and description_column(["A_ID", "B_ID"], "A_ID") == "B_ID"
    assert storage_keys(["x", "SK_ID_CURR", "SK_ID_PREV"]) == ["SK_ID_CURR", "SK_ID_PREV"] and storage_keys(["x", "y"]) == ["x"]


def test_dictionary_lookup_defaults_and_repeated_keys(spark):
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "c")], "S_ID int, S string")
    assert {tuple(r) for r in dictionary(dim).collect()} == {(1, "a"), (2, "c")}
    fact = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "k int, S_ID int")
    assert {tuple(r) for r in dict_lookup(fact, dim, "S_ID", "S").collect()} == {(10, "a"), (11, None), (12, None)}
    filled = report(fact, {"dict_dim_s": dim}, "")
    assert filled.columns == ["k", "S"] and {tuple(r) for r in filled.collect()} == {(10, "a"), (11, ""), (12, "")}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_broadcast(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = lookup_join(left, right, "k", how)
    large = lookup_join(left, right, "k", how, max_rows=0)
    assert table_fingerprint(small).first() == table_fingerprint(large.select(*small.columns)).first()
    plan = large._jdf.queryExecution().analyzed().toString()
    assert "__salt" in plan


def test_model_name_from_file(spark):
    rows = [("xgboost_run_1_predictions.parquet",), ("tabpfn_mix_run_1_predictions",), ("other_file.parquet",)]
    df = spark.createDataFrame(rows, "n string")
    got = [r[0] for r in df.select(model_from_file_name(F.col("n"), F.lit("run_1"))).collect()]
    assert got == ["xgboost", "tabpfn_mix", "other"]


@pytest.mark.parametrize("same", [False, True])
def test_a_hot_key_is_spread_by_its_measured_share(spark, same):
    """Half of the rows have one key: no task holds above twice the median, and only hot lookup rows are copied."""
    from ledgerloom.operators import joins

    rows = spark.range(200_000, numPartitions=16).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.when(F.lit(not same) | (F.col("id") % 2 == 1), F.col("id")).otherwise(F.lit(0)).alias("v"),
    )
    lookup = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = {r[0]: r[1] for r in joins.hot_keys(rows, ["k"]).collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ((_, copies),) = hot.items()
    assert parts * joins.PIECES // 3 < copies <= parts * joins.PIECES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(rows, lookup, "k", max_rows=0)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 200_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert joined.agg(F.sum(F.col("w") - 2 * F.col("k"))).first()[0] == 0
    # without a hot key nothing is copied
    assert joins.hot_keys(lookup, ["k"]).count() == 0
