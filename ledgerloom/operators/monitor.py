"""Read models over runs and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import model_from_file_name
from ledgerloom.operators.joins import lookup_join, semi_join
from ledgerloom.operators.ordering import first_n_per_group, first_rows

# Metrics shown for a model.
MODEL_METRICS = (
    "holdout_precision", "holdout_recall", "holdout_f1", "holdout_roc_auc", "holdout_pr_auc",
    "truth_rows_matched", "truth_status", "production_extract_transform_seconds",
    "production_transform_seconds", "production_predict_seconds", "production_total_seconds",
    "rows_per_second", "avg_latency_ms_per_row", "deployment_inference_seconds",
)


def run_list(manifests: DataFrame) -> DataFrame:
    """Compact runs, newest run id first; a run without status is ``unknown``."""
    return manifests.select(
        "run_id",
        F.coalesce("status", F.lit("unknown")).alias("status"),
        "rows_selected", "rows_inserted", "sk_id_curr_min", "sk_id_curr_max",
        F.col("inference.status").alias("inference_status"),
    ).orderBy(F.col("run_id").desc())


def prediction_list(
    predictions: Sequence[DataFrame] | DataFrame,
    run_id: str | None = None,
    model_name: str | None = None,
    limit: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Predictions of one run or model, from tables whose columns may differ; all, or the first ``limit``."""
    frames = [predictions] if isinstance(predictions, DataFrame) else list(predictions)
    df = frames[0]
    for frame in frames[1:]:
        df = df.unionByName(frame, allowMissingColumns=True)
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    if model_name is not None:
        df = df.where(F.col("model_name") == model_name)
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered if limit is None else ordered.limit(limit)


def wide_preview(
    predictions: DataFrame, key: str, models: Sequence[str], limit: int | None = 50
) -> DataFrame:
    """The first ``limit`` entities, all without one; one row each, score and prediction per fixed model."""
    shown = predictions.where(F.col("model_name").isin(*models) & F.col(key).isNotNull())
    kept = shown
    if limit is not None:
        # Spark broadcasts the ids where they are few
        kept = semi_join(shown, first_rows(shown.select(key).distinct(), [F.col(key)], limit), key)
    cells: list[Column] = []
    for model in models:
        own = F.col("model_name") == model
        cells.append(F.max(F.when(own, F.col("score"))).alias(f"{model}_score"))
        cells.append(F.max(F.when(own, F.col("prediction"))).alias(f"{model}_prediction"))
    return kept.groupBy(key).agg(*cells).orderBy(key)


def prediction_counts(predictions: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """rows_scored, positive_predictions, negative_predictions, prediction_status per group."""
    counted = predictions.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("prediction") == 1).alias("positive_predictions"),
        F.count_if(F.col("prediction") == 0).alias("negative_predictions"),
    )
    return counted.withColumn("prediction_status", F.lit("available"))


def prediction_distribution(
    predictions: DataFrame, run_id: str | None = None, limit: int | None = None
) -> DataFrame:
    """Counts, score range and time range per (run, model, prediction); all groups, or the first ``limit``."""
    keys = ["run_id", "model_name", "prediction"]
    df = predictions if run_id is None else predictions.where(F.col("run_id") == run_id)
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg("score").alias("avg_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.min("predicted_at").alias("first_prediction_at"),
        F.max("predicted_at").alias("last_prediction_at"),
    )
    ordered = grouped.orderBy(*keys)
    return ordered if limit is None else ordered.limit(limit)


def top_predictions(predictions: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` best-scored entities per (run, model)."""
    order = [F.col("score").desc(), F.col(key)]
    return first_n_per_group(predictions, ["run_id", "model_name"], order, n)


def model_results(manifests: DataFrame) -> DataFrame:
    """One row per model result of each manifest."""
    exploded = manifests.select("run_id", F.explode("inference.models").alias("m"))
    return exploded.select(
        "run_id",
        F.coalesce("m.model_name", F.lit("unknown")).alias("model_name"),
        F.col("m.status").alias("status"),
        F.col("m.prediction_path").alias("prediction_path"),
        F.col("m.metrics_path").alias("metrics_path"),
        F.col("m.rows_scored").alias("rows_scored"),
        F.col("m.inference_seconds").alias("inference_seconds"),
    )


def model_summaries(results: DataFrame, counts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Model results with prediction counts and shown metrics.

    A recorded 0 counts as missing: rows fall back to the counted rows, seconds to the
    metrics. Counts and metrics hold one row per (run, model).
    """
    keys = ["run_id", "model_name"]
    counted = counts.withColumnRenamed("rows_scored", "__counted")
    shown = metrics.select(*keys, *[c for c in MODEL_METRICS if c in metrics.columns])
    joined = lookup_join(lookup_join(results, counted, keys), shown, keys)
    rows = F.coalesce(F.nullif("rows_scored", F.lit(0)), "__counted", F.lit(0))
    fallback = (
        F.col("deployment_inference_seconds") if "deployment_inference_seconds" in shown.columns
        else F.lit(None).cast("double")
    )
    seconds = F.coalesce(F.nullif("inference_seconds", F.lit(0.0)), fallback)
    status = F.coalesce("prediction_status", F.lit("missing"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("positive_predictions", "negative_predictions")}
    return joined.withColumns(
        {"rows_scored": rows, "inference_seconds": seconds, "prediction_status": status, **zero}
    ).drop("__counted")


def predictions_from_files(files: DataFrame, run_id: str) -> DataFrame:
    """Predictions of one run read from ``<model>_<run>_predictions`` files or folders.

    ``files`` has a ``path`` column; the model comes from the name when not stored.
    """
    name = F.element_at(F.split("path", "/"), -1)
    named = files.where(name.contains(run_id))
    guess = model_from_file_name(name, F.lit(run_id))
    model = F.coalesce("model_name", guess) if "model_name" in files.columns else guess
    return named.withColumns({"model_name": model, "run_id": F.lit(run_id)})
