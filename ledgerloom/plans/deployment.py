"""One production run: next hold-out batch, refresh, scoring, status."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import (
    batch_manifest,
    next_batch,
    persist_predictions,
    prediction_rows,
    prepare_batch,
    refresh_rows,
    scoped_counts,
)
from ledgerloom.operators.joins import anti_join
from ledgerloom.operators.metrics import one_row, truth_metrics
from ledgerloom.operators.models import Bundle, score_models
from ledgerloom.operators.profile import throughput
from ledgerloom.sources.ledger import (
    MANIFEST,
    MODEL_RESULT,
    claim_ranks,
    has_run,
    read_ledger,
    update_manifest,
    write_manifest,
)
from ledgerloom.sources.tables import exists, write_metrics
from ledgerloom.sources.versions import append_rows, open_rows
from ledgerloom.streaming.report_stream import read_report, refresh_report


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests of earlier runs; an empty ledger before the first one."""
    if exists(spark, folder):
        return read_ledger(spark, folder)
    fields = [f for f in MANIFEST if f.name != "_corrupt"]
    return spark.createDataFrame([], type(MANIFEST)(fields))


def insert_batch(
    spark: SparkSession, ranks: DataFrame, source: DataFrame, folder: str, table: str, run_id: str,
    rows: int, key: str, target: str, mode: str = "inserted", unique_ranks: bool = False,
) -> DataFrame:
    """Append the next batch to ``table`` and record it; returns the manifest.

    ``mode`` planned writes nothing, manifest_only does not append. The ranks are claimed before
    anything is written, so of two writers one fails or takes the ranks after the other's. The manifest is written
    last: a run that died before it starts over, and rows it had appended are not repeated.
    """
    if has_run(spark, folder, run_id):
        raise FileExistsError(f"the ledger {folder} has run {run_id!r} already")
    while True:
        batch = next_batch(ranks, ledger(spark, folder), rows, key, unique_ranks=unique_ranks)
        if mode != "inserted" or claim_ranks(spark, folder, run_id, batch.start_rank, batch.end_rank):
            break
    prepared = prepare_batch(batch, source, key, target)
    manifest = batch_manifest(
        batch, run_id, mode, key, target in source.columns, None if mode == "planned" else folder
    )
    if mode == "inserted":
        if exists(spark, table):
            prepared = anti_join(prepared, open_rows(spark, table).select(key), key)
        append_rows(prepared, table)
    if mode != "planned":
        write_manifest(manifest, folder, run_id)
    return manifest


def refresh_batch(
    spark: SparkSession, staging: DataFrame, storage: str, ids: DataFrame, key: str,
    report: str | None = None, folder: str | None = None, run_id: str | None = None,
    dictionaries: Callable[[], Mapping[str, DataFrame]] = dict,
) -> DataFrame:
    """Append the batch's staging rows to storage, bring the report up to date, and count what belongs to the batch.

    The report takes every storage file that it does not hold yet, with the dictionaries as they are now. With
    the ledger's ``folder`` and the run the counts are recorded in its manifest.
    """
    stored = open_rows(spark, storage)
    append_rows(refresh_rows(staging, stored, ids, key).select(*stored.columns), storage)
    counted = {"storage_count": open_rows(spark, storage)}
    if report is not None:
        refresh_report(spark, storage, report, dictionaries)
        counted["reporting_count"] = read_report(spark, report)
    counts = scoped_counts(ids, counted, key)
    if folder is not None and run_id is not None:
        update_manifest(spark, folder, run_id, dw_refresh={"status": "refreshed", **counts.first().asDict()})
    return counts


def score_batch(
    spark: SparkSession, bundles: Mapping[str, Bundle | Exception], features: DataFrame, key: str,
    run_id: str, predictions: str, folder: str | None = None, truth: DataFrame | None = None,
    target: str = "TARGET",
) -> tuple[str, DataFrame]:
    """Score and persist all models; returns the run's status and its model results.

    Per model the metrics (throughput, and against ``truth`` if given) are written beside the predictions. With the
    ledger's ``folder`` the results are recorded in the run's manifest. A model whose predictions are stored
    already is reported as ``already_present``.
    """
    kept: dict[str, str] = {}

    def of_run(name: str) -> DataFrame:
        stored = spark.read.parquet(predictions)
        return stored.where((F.col("run_id") == run_id) & (F.col("model_name") == name))

    def metrics_path(name: str) -> str:
        return f"{predictions.rstrip('/')}_metrics/run_id={run_id}/model_name={name}"

    def sink(name: str, scored: DataFrame) -> int:
        path = f"{predictions}/{name}_{run_id}_predictions"
        rows = prediction_rows(scored, run_id, F.current_timestamp(), path, metrics_path(name), key)
        before = exists(spark, predictions) and not of_run(name).isEmpty()
        persist_predictions(spark, rows, predictions)
        kept[name] = "already_present" if before else "inserted"
        return of_run(name).count()

    results = score_models(bundles, features, key, sink)
    for r in results:
        if r["status"] == "scored":
            name = r["model_name"]
            r.update(prediction_path=predictions, metrics_path=metrics_path(name), clickhouse_status=kept[name])
            timed = spark.createDataFrame(
                [(r["rows_scored"], r["inference_seconds"])], "rows_scored bigint, deployment_inference_seconds double"
            )
            row = throughput(timed, "rows_scored", "deployment_inference_seconds")
            write_metrics(one_row(row, truth_metrics(of_run(name), truth, key, target)), metrics_path(name))
    fields: list[dict[str, Any]] = [{**dict.fromkeys(MODEL_RESULT.names), **r} for r in results]
    scored = sum(r["status"] == "scored" for r in results)
    status = "scored" if results and scored == len(results) else "partial" if scored else "failed"
    if folder is not None:
        update_manifest(spark, folder, run_id, inference={"status": status, "source": predictions, "models": fields})
    return status, spark.createDataFrame([tuple(f[n] for n in MODEL_RESULT.names) for f in fields], MODEL_RESULT)


def read_metrics(spark: SparkSession, predictions: str) -> DataFrame:
    """Written metrics of all runs and models of a predictions table, with run_id and model_name."""
    path = f"{predictions.rstrip('/')}_metrics"
    rows = spark.read.option("basePath", path).json(f"{path}/*/*")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("run_id", "model_name")})
