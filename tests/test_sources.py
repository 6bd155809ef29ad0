"""Staging, discovery, selection, snapshots."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ledgerloom.functions.text import run_id
from ledgerloom.operators.metrics import one_row
from ledgerloom.sources.staging import stage, staging_root
from ledgerloom.sources.tables import exists, file_catalog, restore_tables, snapshot_tables, table_selection, write_csv, write_metrics


def test_staged_tables_lie_in_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging_root(spark).startswith(folder)
    staged = stage(spark.range(3).select("id", F.lit(None).cast("string").alias("t")), "probe")
    assert staged.count() == 3 and dict(staged.dtypes) == {"id": "bigint", "t": "string"}
    assert any(name.startswith("probe-") for name in os.listdir(staging_root(spark)))
    assert stage(spark.range(0)).count() == 0


def test_files_are_found_at_any_depth(spark, folder):
    write_csv(spark.range(2), f"{folder}/deep/er/Bureau.csv")
    with open(f"{folder}/POS_Cash.csv", "w") as file:
        file.write("a\n1\n")
    write_csv(spark.range(9).repartition(3), f"{folder}/Many.csv")
    found = {r["table"]: r for r in file_catalog(spark, folder).collect()}
    assert set(found) == {"pos_cash", "bureau", "many"}
    assert found["many"]["files"] == 3 and found["pos_cash"]["files"] == 1 and found["pos_cash"]["bytes"] == 4
    assert found["bureau"]["path"].endswith("deep/er/Bureau.csv") and found["many"]["path"].endswith("Many.csv")


def test_table_selection(spark):
    catalog = spark.createDataFrame([("a",), ("b",)], "table string")
    asked = spark.createDataFrame([("x/b.parquet",), ("c",)], "table string")
    assert {tuple(r) for r in table_selection(catalog, asked).collect()} == {("b", "found"), ("c", "missing")}
    assert {tuple(r) for r in table_selection(catalog, asked.limit(0)).collect()} == {("a", "found"), ("b", "found")}


def test_snapshot_and_restore(spark, folder):
    path = snapshot_tables({"a": spark.range(3)}, folder, "dw", "20240101_000000")
    assert path.endswith("dw_20240101_000000") and exists(spark, path) and not exists(spark, f"{path}x")
    assert restore_tables(spark, path, ["a"])["a"].count() == 3


def test_metrics_and_run_ids(spark, folder):
    row = one_row(spark.createDataFrame([(0.5,)], "a double"), spark.createDataFrame([(2,)], "b long"))
    write_metrics(row, f"{folder}/m")
    assert spark.read.json(f"{folder}/m").first().asDict() == {"a": 0.5, "b": 2}
    at = F.to_timestamp(F.lit("2024-01-31 12:05:09"))
    assert spark.range(1).select(run_id("prod", at)).first()[0] == "prod_20240131_120509"


def test_a_staged_table_leaves_no_shuffle_files(spark):
    """Disk is free again as soon as the table is written."""
    import time

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    counts = spark.range(20_000).groupBy((F.col("id") % 77).alias("k")).count().repartition(5, "count")
    before = files()
    counts.write.format("noop").mode("overwrite").save()
    kept = files()
    assert kept - before
    staged = stage(counts)
    for _ in range(50):
        left = files() - kept
        if not left:
            break
        time.sleep(0.1)
    assert not left and staged.count() == 77
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
