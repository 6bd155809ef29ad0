"""Hold-out batches, ledger, refresh, streaming report, warehouse and models end to end."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import (
    RANK,
    holdout_ranks,
    next_batch,
    persist_predictions,
    prediction_rows,
    refresh_rows,
    top_n,
    without_top_n,
)
from ledgerloom.operators.models import AnomalyModel, Bundle, parameter_grid, random_parameters, search, train_model
from ledgerloom.operators.monitor import model_results, model_summaries, run_list
from ledgerloom.plans.deployment import insert_batch, ledger, read_metrics, refresh_batch, score_batch
from ledgerloom.plans.maintenance import backup_rows, delete_rows, restore_rows
from ledgerloom.plans.warehouse import build_warehouse, storage_layout, with_row_id
from ledgerloom.sources.ledger import consumed_rank_max, read_entity_ids, read_manifests, run_status
from ledgerloom.sources.tables import write_table
from ledgerloom.streaming.report_stream import maintain_report, read_report, storage_stream

KEY = "SK_ID_CURR"


def _assets(spark, n):
    ids = spark.range(1, n + 1).select(F.col("id").alias(RANK), (F.col("id") + 100000).alias(KEY))
    source = ids.select(KEY, (F.col(RANK) % 2).cast("int").alias("TARGET"), F.col(RANK).alias("feature"))
    return ids, source


def _parsed(spark, *manifests):
    from ledgerloom.sources.ledger import parse_manifests

    docs = spark.createDataFrame([(json.dumps(m),) for m in manifests] or [("{broken",)], "d string")
    return parse_manifests(docs, "d")


@pytest.mark.parametrize(("end", "rows", "first", "last"), [(10, 1000, 11, 1010), (1010, 10, 1011, 1020)])
def test_batches_continue_after_the_consumed_rank(spark, end, rows, first, last):
    ids, _ = _assets(spark, 2000)
    done = {"run_id": "a", "status": "inserted", "rows_inserted": 5, "holdout_end_rank": end, "entity_ids": [1]}
    batch = next_batch(ids, _parsed(spark, done), rows, KEY)
    got = [r[KEY] for r in batch.ids.orderBy(RANK).collect()]
    assert (batch.start_rank, batch.end_rank) == (first, last) and got == [100000 + r for r in range(first, last + 1)]


def test_only_inserted_manifests_advance(spark):
    ids, _ = _assets(spark, 3)
    written = {"run_id": "a", "status": "manifest_only", "rows_inserted": 0, "holdout_end_rank": 2, "entity_ids": [100001]}
    batch = next_batch(ids, _parsed(spark, written), 2, KEY)
    assert (batch.previous_consumed_rank_max, batch.start_rank, batch.ids.count()) == (0, 1, 2)


def test_batch_errors(spark):
    ids, _ = _assets(spark, 3)
    taken = {"run_id": "a", "status": "inserted", "rows_inserted": 1, "holdout_end_rank": 1, "entity_ids": [100002]}
    with pytest.raises(ValueError, match="inserted before: 100002"):
        next_batch(ids, _parsed(spark, taken), 2, KEY)
    with pytest.raises(ValueError, match="repeat: 100001"):
        next_batch(ids.withColumn(KEY, F.lit(100001).cast("long")), _parsed(spark, taken), 2, KEY)
    with pytest.raises(ValueError, match="no rows in"):
        next_batch(ids, _parsed(spark, {**taken, "holdout_end_rank": 3}), 2, KEY)
    # a batch may be shorter than asked
    assert next_batch(ids, _parsed(spark, {**taken, "entity_ids": [], "holdout_end_rank": 2}), 9, KEY).ids.count() == 1


def test_ledger_skips_bad_documents(spark, folder):
    for name, text in {"a": '{"run_id": "a",\n "status": "inserted", "rows_inserted": 3, "holdout_end_rank": 3}', "b": "{oops", "c": "{}"}.items():
        with open(os.path.join(folder, f"{name}.json"), "w") as file:
            file.write(text)
    manifests = read_manifests(spark, folder)
    assert {r["run_id"] for r in manifests.collect()} == {"a", "c"} and manifests.count() == 2
    assert consumed_rank_max(manifests).first()[0] == 3
    assert consumed_rank_max(manifests.where("run_id = 'c'")).first()[0] == 0


def test_runs_append_in_order(spark, folder):
    ids, source = _assets(spark, 7)
    table, runs = f"{folder}/table", f"{folder}/runs"
    planned = insert_batch(spark, ids, source, runs, table, "r0", 3, KEY, "TARGET", "planned").first()
    assert planned["status"] == "planned" and planned["rows_inserted"] == 0 and not os.path.exists(table)
    first = insert_batch(spark, ids, source, runs, table, "r1", 3, KEY, "TARGET").first()
    assert first["entity_ids"] == [] and first["target_removed"] and first["rows_selected"] == 3
    assert sorted(r[KEY] for r in spark.read.parquet(first["entity_ids_path"]).collect()) == [100001, 100002, 100003]
    insert_batch(spark, ids, source, runs, table, "r2", 3, KEY, "TARGET", "manifest_only")
    third = insert_batch(spark, ids, source, runs, table, "r3", 3, KEY, "TARGET").first()
    assert (third["holdout_start_rank"], third["holdout_end_rank"]) == (4, 6)
    stored = spark.read.parquet(table)
    assert "TARGET" not in stored.columns and sorted(r[KEY] for r in stored.collect()) == list(range(100001, 100007))
    assert consumed_rank_max(ledger(spark, runs)).first()[0] == 6
    assert read_entity_ids(spark, runs).where("run_id = 'r3'").count() == 3
    with pytest.raises(FileExistsError):
        insert_batch(spark, ids, source, runs, table, "r1", 3, KEY, "TARGET")


def test_a_run_that_died_before_its_manifest_repeats_no_rows(spark, folder):
    ids, source = _assets(spark, 5)
    table, runs = f"{folder}/table", f"{folder}/runs"
    write_table(source.drop("TARGET").where(F.col(KEY) <= 100002), table)
    insert_batch(spark, ids, source, runs, table, "r1", 3, KEY, "TARGET")
    assert sorted(r[KEY] for r in spark.read.parquet(table).collect()) == [100001, 100002, 100003]


def test_a_source_without_selected_ids_is_an_error(spark, folder):
    ids, source = _assets(spark, 5)
    with pytest.raises(ValueError, match="lacks selected ids: 100002"):
        insert_batch(spark, ids, source.where(F.col(KEY) != 100002), f"{folder}/runs", f"{folder}/t", "r", 3, KEY, "TARGET")


def test_refresh(spark, folder):
    _, source = _assets(spark, 10)
    write_table(source.where(F.col(KEY) <= 100004), f"{folder}/storage")
    new = source.where(F.col(KEY) > 100007).select(KEY)
    counts = refresh_batch(spark, source, f"{folder}/storage", new, KEY).first()
    assert tuple(counts) == (3, 3) and spark.read.parquet(f"{folder}/storage").count() == 7
    with pytest.raises(ValueError, match="rows of these ids: 100008, 100009, 100010"):
        refresh_batch(spark, source, f"{folder}/storage", new, KEY)
    with pytest.raises(ValueError, match="repeat"):
        refresh_rows(source, source.limit(0), new.union(new), KEY)
    with pytest.raises(ValueError, match="no rows in"):
        refresh_rows(source, source.limit(0), new.limit(0), KEY)


def test_top_n_delete_removes_exactly_n_of_tied_rows(spark):
    rows = [(5, i) for i in range(6)] + [(1, 0), (None, 1), (5, 0)]
    df = spark.createDataFrame(rows, "v int, id int")
    gone, left = top_n(df, "v", 3), without_top_n(df, "v", 3)
    assert gone.count() == 3 and left.count() == 6
    assert sorted(map(str, gone.unionByName(left).collect())) == sorted(map(str, df.collect()))


def test_backup_delete_restore(spark, folder):
    table, backup = f"{folder}/t", f"{folder}/b"
    write_table(spark.range(1, 21).select(F.col("id").alias(KEY)), table)
    assert tuple(backup_rows(spark.read.parquet(table), KEY, 6, backup)) == (6, 15, 20)
    assert tuple(delete_rows(spark, table, KEY, 6)) == (6, 15, 20)
    assert tuple(restore_rows(spark, backup, table, [KEY], 2)) == (2, 15, 16)
    assert sorted(r[KEY] for r in spark.read.parquet(table).collect()) == list(range(1, 17))
    with pytest.warns(UserWarning, match="asked for 99 rows, found 16"):
        backup_rows(spark.read.parquet(table), KEY, 99, backup)
    with pytest.raises(ValueError, match="no row"):
        backup_rows(spark.range(0).select(F.col("id").alias(KEY)), KEY, 3, backup)


def test_predictions_are_appended_once(spark, folder):
    scored = spark.createDataFrame([(101, 0.8, 1, "m"), (102, 0.1, 0, "m")], f"{KEY} long, score double, prediction int, model_name string")
    rows = prediction_rows(scored, "r1", F.current_timestamp(), "p", "q")
    assert rows.columns == ["run_id", "model_name", KEY, "score", "prediction", "predicted_at", "prediction_path", "metrics_path"]
    for _ in range(2):
        persist_predictions(spark, rows, f"{folder}/p")
    persist_predictions(spark, prediction_rows(scored, "r2", F.current_timestamp(), "p", "q"), f"{folder}/p")
    assert spark.read.parquet(f"{folder}/p").groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 2), ("r2", 2)]


def test_run_status(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "run_id string")
    results = spark.createDataFrame(
        [("a", "scored"), ("a", "scored"), ("b", "scored"), ("b", "failed"), ("c", "failed")], "run_id string, status string"
    )
    assert dict(map(tuple, run_status(runs, results).collect())) == {"a": "scored", "b": "partial", "c": "failed", "d": "failed"}


# ---------------------------------------------------------------- warehouse


def test_warehouse_can_be_loaded_twice(spark, folder):
    fact = spark.createDataFrame([(2, 1), (1, 2), (None, None)], "SK_ID_CURR int, STATUS_ID int")
    loose = spark.createDataFrame([(9, 1), (9, 1), (8, 3)], "x int, STATUS_ID int")
    dims = {"dim_status": spark.createDataFrame([(1, "Active"), (2, "Closed")], "STATUS_ID int, STATUS string")}
    for _ in range(2):
        tables = build_warehouse(spark, {"fact": fact, "loose": loose}, dims, folder, keyless=["loose"])
    assert {tuple(r) for r in tables["rep_fact"].collect()} == {(2, "Active"), (1, "Closed"), (None, None)}
    assert sorted(r["_DW_ID"] for r in tables["rep_loose"].collect()) == [0, 1, 2]
    assert tables["rep_loose"].columns == ["_DW_ID", "x", "STATUS"]


def test_storage_is_sorted_and_split_on_a_hot_key(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("SK_ID_CURR"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = storage_layout(df).withColumn("p", F.spark_partition_id())
        rows = parts.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_part = {}
    for r in rows:
        by_part.setdefault(r["p"], []).append(r["SK_ID_CURR"])
    assert all(keys == sorted(keys) for keys in by_part.values())
    spans = [(keys[0], keys[-1]) for _, keys in sorted(by_part.items())]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(7 in keys for keys in by_part.values()) > 1


def test_row_ids_move_no_rows(spark):
    plan = with_row_id(spark.range(100).repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


# ---------------------------------------------------------------- streaming


def test_report_stream_uses_the_dimensions_of_the_moment(spark, folder):
    storage, output, state = f"{folder}/storage", f"{folder}/report", f"{folder}/state"
    dims = {"dict_dim_s": spark.createDataFrame([(1, "one")], "S_ID int, S string")}
    fact = spark.createDataFrame([(10, 1), (11, 2)], "k int, S_ID int")

    def run():
        stream = storage_stream(spark, storage, fact.schema)
        maintain_report(stream, lambda: dims, output, state).awaitTermination()

    write_table(fact, storage, "append")
    run()
    dims = {"dict_dim_s": spark.createDataFrame([(1, "uno"), (2, "dos")], "S_ID int, S string")}
    write_table(spark.createDataFrame([(12, 1), (13, 2)], fact.schema), storage, "append")
    run()
    run()
    got = {tuple(r) for r in read_report(spark, output).select("k", "S").collect()}
    assert got == {(10, "one"), (11, None), (12, "uno"), (13, "dos")}


def test_a_repeated_micro_batch_replaces_itself(spark, folder):
    storage, output = f"{folder}/storage", f"{folder}/report"
    fact = spark.createDataFrame([(10,), (11,)], "k int")
    write_table(fact, storage)
    for attempt in range(2):
        # a new checkpoint makes the stream process batch 0 again, as after a lost commit
        stream = storage_stream(spark, storage, fact.schema)
        maintain_report(stream, lambda: {}, output, f"{folder}/state{attempt}").awaitTermination()
    assert read_report(spark, output).count() == 2


# ---------------------------------------------------------------- models


@pytest.fixture(scope="module")
def features(spark):
    df = spark.range(600).select(
        F.col("id").alias(KEY),
        ((F.col("id") * 7919) % 100 / F.lit(100.0)).alias("a"),
        F.when(F.col("id") % 9 != 0, (F.col("id") * 104729) % 50).alias("b"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("c"),
    )
    return df.withColumn("TARGET", (F.col("a") > 0.7).cast("int"))


@pytest.mark.parametrize(
    ("name", "params", "floor"),
    [
        ("random_forest", {"n_estimators": 10, "max_depth": 4}, 0.9),
        ("pyod_autoencoder", {"components": 2}, 0.0),
    ],
)
def test_train_save_load_score(spark, folder, features, name, params, floor):
    bundle = train_model(features, KEY, "TARGET", name, params)
    assert bundle.metrics["test_roc_auc"] >= floor
    bundle.save(spark, f"{folder}/b")
    loaded = Bundle.load(spark, f"{folder}/b")
    one = {r[KEY]: r["score"] for r in bundle.score(features, KEY).collect()}
    two = {r[KEY]: r["score"] for r in loaded.score(features, KEY).collect()}
    assert len(one) == 600 and one == pytest.approx(two) and all(0 <= s <= 1 for s in one.values())
    assert set(loaded.evaluate(features, KEY)) == {f"full_{m}" for m in ("precision", "recall", "f1", "roc_auc", "pr_auc")}


def test_net_gradients_equal_differences():
    import numpy as np

    from ledgerloom.operators import net

    draw = np.random.default_rng(2)
    sizes = [4, 5, 3, 1]
    flat = draw.normal(size=sum(int(np.prod(s)) for s in net._shapes(sizes)))
    x, y = draw.normal(size=(7, 4)), draw.integers(0, 2, 7).astype(float)

    def loss(flat):
        z = net.forward(net._unflat(flat, sizes), x)[-1][:, 0]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    slope = np.concatenate([g.ravel() for g in net.gradients(net._unflat(flat, sizes), x, y)])
    for at in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-6
        down[at] -= 1e-6
        assert abs((loss(up) - loss(down)) / 2e-6 - slope[at]) < 1e-5


def test_the_net_learns_at_its_rate_and_in_parallel(spark, folder, features, monkeypatch):
    import numpy as np

    from ledgerloom.operators import net

    settings = {"hidden_units": [16, 8], "epochs": 12, "batch_size": 16, "learning_rate": 0.01}
    bundle = train_model(features, KEY, "TARGET", "local_neural_net", settings)
    assert bundle.metrics["test_roc_auc"] > 0.95
    slow = train_model(features, KEY, "TARGET", "local_neural_net", {**settings, "learning_rate": 1e-6})
    assert not np.allclose(slow.model.flat, bundle.model.flat) and slow.metrics["test_pr_auc"] < bundle.metrics["test_pr_auc"]
    bundle.save(spark, f"{folder}/net")
    loaded = Bundle.load(spark, f"{folder}/net")
    one = {r[KEY]: r["score"] for r in bundle.score(features, KEY).collect()}
    assert one == pytest.approx({r[KEY]: r["score"] for r in loaded.score(features, KEY).collect()})
    # several tasks, whose changes are averaged
    monkeypatch.setattr(net, "LEAST_BATCHES", 4)
    monkeypatch.setattr(net, "SLICE", 50)
    parallel = train_model(features, KEY, "TARGET", "local_neural_net", {**settings, "epochs": 30})
    assert parallel.metrics["test_roc_auc"] > 0.9


def test_one_hot_part_of_the_vector(spark, features):
    from pyspark.ml.functions import vector_to_array

    from ledgerloom.operators.mlprep import Preprocessor

    prepared = Preprocessor.fit(features.drop(KEY, "TARGET"), 10)
    assert prepared.widths == {"c": 4}
    strange = features.withColumn("c", F.when(F.col(KEY) == 0, "new").otherwise(F.col("c")))
    vectors = prepared.transform(strange, [KEY]).select(KEY, vector_to_array("features").alias("v")).collect()
    for r in vectors:
        hot = r["v"][2:]
        assert len(hot) == 4 and sum(hot) == (0.0 if r[KEY] == 0 else 1.0)


def test_grid_keeps_failed_trials(spark, features):
    trials = parameter_grid({"n_estimators": [3], "max_depth": [2, -5]})
    got = search(features, KEY, "TARGET", "random_forest", trials).orderBy("trial").collect()
    assert [r["status"] for r in got] == ["COMPLETE", "FAIL"] and got[1]["error"]
    assert random_parameters("xgboost", 3) == random_parameters("xgboost", 3)


def test_one_failing_model_gives_a_partial_run(spark, folder, features):
    good = train_model(features, KEY, "TARGET", "random_forest", {"n_estimators": 3, "max_depth": 3})
    status, results = score_batch(
        spark, {"good": good, "bad": FileNotFoundError("no bundle")}, features, KEY, "run_1", f"{folder}/p"
    )
    assert status == "partial"
    # the run's manifest and the metrics are what the lists show
    runs = f"{folder}/runs"
    source = features.select(KEY, "TARGET")
    insert_batch(spark, source.select(KEY, F.row_number().over(W.orderBy(KEY)).alias(RANK)), source, runs, f"{folder}/t", "run_1", 600, KEY, "TARGET")
    refresh_batch(spark, source.drop("TARGET").limit(0).union(source.select((F.col(KEY) + 10**6).alias(KEY))), f"{folder}/t", source.select((F.col(KEY) + 10**6).alias(KEY)), KEY, None, runs, "run_1")
    again, _ = score_batch(
        spark, {"good": good, "bad": FileNotFoundError("no bundle")}, features, KEY, "run_1", f"{folder}/p", runs, source
    )
    shown = run_list(ledger(spark, runs)).first()
    assert again == "partial" and shown["inference_status"] == "partial" and shown["rows_inserted"] == 600
    manifest = ledger(spark, runs).first()
    assert manifest["dw_refresh"]["entity_count"] == 600 and manifest["dw_refresh"]["storage_count"] == 600
    assert {m["model_name"]: m["clickhouse_status"] for m in manifest["inference"]["models"]} == {"good": "already_present", "bad": None}
    found = model_results(ledger(spark, runs))
    counts = spark.read.parquet(f"{folder}/p").groupBy("run_id", "model_name").agg(F.count(F.lit(1)).alias("rows_scored")).withColumns(
        {"prediction_status": F.lit("available"), "positive_predictions": F.lit(0), "negative_predictions": F.lit(0)})
    summary = {r["model_name"]: r for r in model_summaries(found, counts, read_metrics(spark, f"{folder}/p")).collect()}
    assert summary["good"]["truth_status"] == "evaluated" and summary["good"]["truth_rows_matched"] == 600
    assert summary["good"]["rows_per_second"] > 0 and summary["bad"]["rows_scored"] == 0
    assert {(r["model_name"], r["status"], r["rows_scored"]) for r in results.collect()} == {("good", "scored", 600), ("bad", "failed", 0)}


def test_anomaly_model_needs_normal_rows(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([1.0, 1.5]), 1.0), (Vectors.dense([2.0, 2.5]), 1.0)]
    df = spark.createDataFrame(rows, ["features", "label"])
    with pytest.raises(ValueError, match="label 0"):
        AnomalyModel.fit(df, 1, 0.25)


def test_holdout_ranks_are_contiguous(spark):
    truth = spark.createDataFrame([(30, 0), (10, 1), (20, 0)], f"{KEY} long, TARGET int")
    assert [tuple(r) for r in holdout_ranks(truth, KEY).orderBy(RANK).collect()] == [(1, 10), (2, 20), (3, 30)]
