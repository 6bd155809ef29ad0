"""Read models over runs and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.monitor import (
    model_results,
    model_summaries,
    prediction_counts,
    prediction_distribution,
    prediction_list,
    predictions_from_files,
    run_list,
    top_predictions,
    wide_preview,
)
from ledgerloom.operators.metrics import truth_metrics
from ledgerloom.plans.config import PREVIEW_MODELS
from ledgerloom.plans.registry.base import fixed, fixed_sql, query, table
from ledgerloom.plans.registry.incremental import (
    KEY,
    LEDGER_SQL,
    PREDICTED_AT_SQL,
    PREDICTIONS_SQL,
    RESULTS_SQL,
    manifests,
    predictions,
    stamped,
)


@query(
    "run_list",
    f"""SELECT run_id, status, n AS rows_selected, inserted AS rows_inserted, lo AS sk_id_curr_min, hi AS sk_id_curr_max,
 CASE WHEN status = 'inserted' THEN 'scored' END AS inference_status FROM {LEDGER_SQL}""",
)
def _runs(spark, root):
    return run_list(manifests(spark, root))


@query(
    "prediction_list",
    f"""SELECT run_id, model_name, "SK_ID_CURR", score, prediction, {PREDICTED_AT_SQL} FROM {PREDICTIONS_SQL}
 WHERE run_id = 'run_en' AND model_name = 'xgboost' ORDER BY "SK_ID_CURR" LIMIT 100""",
)
def _list(spark, root):
    """Two tables, one of them without the path columns."""
    rows = stamped(predictions(spark, root))
    short = rows.where(F.col("prediction") == 1).drop("prediction_path", "metrics_path")
    found = prediction_list([rows.where(F.col("prediction") == 0), short], "run_en", "xgboost", 100, [KEY])
    return found.drop("prediction_path", "metrics_path")


def _preview_sql(models: dict[str, str | None]) -> str:
    cells = ", ".join(
        f"max(score) FILTER (WHERE model_name = '{m}') AS {m}_score, max(prediction) FILTER (WHERE model_name = '{m}')"
        f" AS {m}_prediction" for m in models
    )
    return f"""SELECT "SK_ID_CURR", {cells} FROM {PREDICTIONS_SQL} WHERE run_id = 'run_en' GROUP BY 1
 ORDER BY "SK_ID_CURR" LIMIT 50"""


@query("prediction_preview_wide", _preview_sql(dict.fromkeys(PREVIEW_MODELS)))
def _preview(spark, root):
    run = predictions(spark, root).where(F.col("run_id") == "run_en")
    return wide_preview(run, KEY, PREVIEW_MODELS, 50)


@query(
    "preview_missing_model",
    f"""SELECT "SK_ID_CURR", max(score) AS xgboost_score, max(prediction) AS xgboost_prediction,
 NULL::DOUBLE AS absent_score, NULL::INTEGER AS absent_prediction FROM {PREDICTIONS_SQL}
 WHERE model_name = 'xgboost' GROUP BY 1 ORDER BY 1 LIMIT 50""",
)
def _missing(spark, root):
    return wide_preview(predictions(spark, root), KEY, ["xgboost", "absent"], 50)


_COUNTS_SQL = f"""(SELECT run_id, model_name, count(*) AS rows_scored, count(*) FILTER (WHERE prediction = 1) AS
 positive_predictions, count(*) FILTER (WHERE prediction = 0) AS negative_predictions, 'available' AS prediction_status
 FROM {PREDICTIONS_SQL} GROUP BY 1, 2)"""


@query("prediction_counts", f"SELECT * FROM {_COUNTS_SQL}")
def _counts(spark, root):
    return prediction_counts(predictions(spark, root), ["run_id", "model_name"])


@query(
    "prediction_distribution",
    f"""SELECT run_id, model_name, prediction, count(*) AS prediction_count, {fixed_sql('avg(score)')} AS avg_score,
 min(score) AS min_score, max(score) AS max_score, strftime(min(predicted_at), '%Y-%m-%d %H:%M:%S') AS first_prediction_at,
 strftime(max(predicted_at), '%Y-%m-%d %H:%M:%S') AS last_prediction_at FROM {PREDICTIONS_SQL}
 GROUP BY 1, 2, 3 ORDER BY 1, 2, 3 LIMIT 100""",
)
def _distribution(spark, root):
    found = prediction_distribution(predictions(spark, root))
    texts = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_prediction_at", "last_prediction_at")}
    return found.withColumns({"avg_score": fixed(F.col("avg_score")), **texts})


@query(
    "top_predictions",
    f"""SELECT run_id, model_name, "SK_ID_CURR", score FROM (SELECT *, row_number() OVER
 (PARTITION BY run_id, model_name ORDER BY score DESC, "SK_ID_CURR") AS rn FROM {PREDICTIONS_SQL}) WHERE rn <= 10""",
)
def _top(spark, root):
    return top_predictions(predictions(spark, root), KEY).select("run_id", "model_name", KEY, "score")


@query(
    "model_from_path",
    f"""SELECT model_name, run_id, "SK_ID_CURR" FROM {PREDICTIONS_SQL} WHERE run_id = 'run_en'""",
)
def _from_path(spark, root):
    files = predictions(spark, root).select(
        F.concat(F.lit("/data/"), "prediction_path").alias("path"), KEY
    )
    return predictions_from_files(files, "run_en").select("model_name", "run_id", KEY)


_SUMMARY_RUNS = f"""(SELECT run_id, status, run, model_name, CASE model_name WHEN 'xgboost' THEN 0 ELSE 1 END AS i
 FROM {RESULTS_SQL})"""


# the run of a result is matched with the language runs by number, so that some have predictions
@query(
    "model_summaries",
    f"""WITH r AS (SELECT s.run_id, s.model_name, s.status, s.run, s.i, l.n,
 CASE WHEN s.run = 0 THEN 'run_de' WHEN s.run = 1 THEN 'run_en' WHEN s.run = 4 THEN 'run_es' ELSE s.run_id END AS key
 FROM {_SUMMARY_RUNS} s JOIN {LEDGER_SQL} l USING (run_id))
 SELECT r.key AS run_id, r.model_name, CASE WHEN r.status = 'scored' THEN r.n ELSE coalesce(c.rows_scored, 0) END AS rows_scored,
 coalesce(c.positive_predictions, 0) AS positive_predictions, coalesce(c.negative_predictions, 0) AS negative_predictions,
 coalesce(c.prediction_status, 'missing') AS prediction_status,
 CASE WHEN r.status = 'scored' THEN (r.run + r.i + 1) / 4.0::DOUBLE ELSE 9.5::DOUBLE END AS inference_seconds
 FROM r LEFT JOIN {_COUNTS_SQL} c ON c.run_id = r.key AND c.model_name = r.model_name""",
)
def _summaries(spark, root):
    found = model_results(manifests(spark, root))
    renamed = F.create_map(
        *[F.lit(v) for pair in (("prod_000000", "run_de"), ("prod_000001", "run_en"), ("prod_000004", "run_es")) for v in pair]
    )
    found = found.withColumn("run_id", F.coalesce(renamed[F.col("run_id")], F.col("run_id")))
    counts = prediction_counts(predictions(spark, root), ["run_id", "model_name"])
    metrics = found.select("run_id", "model_name", F.lit(9.5).alias("deployment_inference_seconds"))
    return model_summaries(found, counts, metrics).select(
        "run_id", "model_name", "rows_scored", "positive_predictions", "negative_predictions", "prediction_status",
        "inference_seconds",
    )


_TRUTH = f"""(SELECT p.score, p.prediction, l.toxic AS t FROM {PREDICTIONS_SQL} p
 JOIN labels l ON l.doc_id = p."SK_ID_CURR" WHERE p.model_name = 'xgboost')"""


def ranking_sql(source: str) -> str:
    """SQL of the two ranking metrics over (score, t)."""
    return f"""(SELECT sum(neg * (cp - pos + pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS roc_auc,
 sum(pos * cp::DOUBLE / (cp + cn)) / sum(pos) AS pr_auc FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp,
 sum(neg) OVER (ORDER BY score DESC) AS cn FROM (SELECT score, count(*) FILTER (WHERE t = 1) AS pos,
 count(*) FILTER (WHERE t <> 1) AS neg FROM {source} GROUP BY score)))"""


CONFUSION_SQL = """(SELECT count(*) FILTER (WHERE t = 1 AND prediction = 1) AS tp,
 count(*) FILTER (WHERE t = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE t = 1 AND prediction = 0) AS fn,
 count(*) AS n FROM {source})"""


@query(
    "truth_metrics",
    f"""SELECT 'evaluated' AS truth_status, c.n AS truth_rows_matched, {fixed_sql('tp / (tp + fp)::DOUBLE')} AS holdout_precision,
 {fixed_sql('tp / (tp + fn)::DOUBLE')} AS holdout_recall, {fixed_sql('2 * tp / (2 * tp + fp + fn)::DOUBLE')} AS holdout_f1,
 {fixed_sql('r.roc_auc')} AS holdout_roc_auc, {fixed_sql('r.pr_auc')} AS holdout_pr_auc
 FROM {CONFUSION_SQL.format(source=_TRUTH)} c, {ranking_sql(_TRUTH)} r
 UNION ALL SELECT 'no_matches', 0, NULL, NULL, NULL, NULL, NULL UNION ALL SELECT 'missing', NULL, NULL, NULL, NULL, NULL, NULL""",
)
def _truth(spark, root):
    scored = predictions(spark, root).where(F.col("model_name") == "xgboost")
    truth = table(spark, root, "labels").select(F.col("doc_id").alias(KEY), F.col("toxic").alias("TARGET"))
    strangers = truth.withColumn(KEY, -F.col(KEY) - 1)
    rows = truth_metrics(scored, truth, KEY).unionByName(truth_metrics(scored, strangers, KEY))
    rows = rows.unionByName(truth_metrics(scored, None, KEY))
    return rows.withColumns({c: fixed(F.col(c)) for c in rows.columns if c.startswith("holdout_")})
