"""Hold-out batches, ledgers and idempotent appends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.incremental import (
    RANK,
    already_stored,
    batch_manifest,
    holdout_ranks,
    holdout_truth,
    next_batch,
    persist_predictions,
    prediction_rows,
    prepare_batch,
    scoped_counts,
)
from ledgerloom.operators.ordering import row_ids
from ledgerloom.plans.deployment import insert_batch
from ledgerloom.plans.registry.base import APPLICATIONS_SQL, CREDITS_SQL, applications, credits, query, table
from ledgerloom.sources.ledger import (
    consumed_rank_max,
    inserted_entity_ids,
    latest_results,
    parse_manifests,
    read_id_rows,
    read_ledger,
    run_status,
    update_manifest,
    upsert_results,
    write_entity_ids,
    write_manifest,
)
from ledgerloom.sources.staging import staging_path

KEY, TARGET = "SK_ID_CURR", "TARGET"
_SIZE = 40

RANKS_SQL = f"""(SELECT row_number() OVER (ORDER BY "SK_ID_CURR") AS holdout_rank, "SK_ID_CURR" FROM {APPLICATIONS_SQL}
 WHERE "SK_ID_CURR" NOT IN (SELECT user_id FROM events))"""


def ranks(spark, root):
    """Hold-out entities: customers without events, ranked."""
    known = table(spark, root, "events").select(F.col("user_id").alias(KEY))
    return holdout_ranks(holdout_truth(applications(spark, root), known, KEY, TARGET), KEY)


@query("holdout_rank", f"SELECT * FROM {RANKS_SQL}")
def _ranks(spark, root):
    return ranks(spark, root)


# One run per 40 ranks; every fourth run is only planned, every other fourth only written, and the
# documents of the last batches are cut short, as a crash leaves them.
RUNS_SQL = f"""(SELECT 'prod_' || lpad(run::VARCHAR, 6, '0') AS run_id, run,
 CASE run % 4 WHEN 2 THEN 'manifest_only' WHEN 3 THEN 'planned' ELSE 'inserted' END AS status,
 min(holdout_rank) AS first_rank, max(holdout_rank) AS last_rank, count(*) AS n,
 CASE WHEN run % 4 IN (2, 3) THEN 0 ELSE count(*) END AS inserted, min("SK_ID_CURR") AS lo, max("SK_ID_CURR") AS hi
 FROM (SELECT *, (holdout_rank - 1) // {_SIZE} AS run FROM {RANKS_SQL}) GROUP BY run)"""
# the last half of the batches is not consumed yet
OPEN_SQL = f"(SELECT max(run) // 2 FROM {RUNS_SQL})"
LEDGER_SQL = f"(SELECT * FROM {RUNS_SQL} WHERE run <= {OPEN_SQL})"


def documents(spark, root):
    """Manifests as JSON text; runs after the middle one are unreadable."""
    run = F.floor((F.col("holdout_rank") - 1) / _SIZE).cast("bigint")
    runs = ranks(spark, root).withColumn("run", run)
    status = (
        F.when(F.col("run") % 4 == 2, "manifest_only").when(F.col("run") % 4 == 3, "planned").otherwise("inserted")
    )
    grouped = runs.groupBy("run").agg(
        F.min("holdout_rank").alias("holdout_start_rank"), F.max("holdout_rank").alias("holdout_end_rank"),
        F.count(F.lit(1)).alias("rows_selected"), F.min(KEY).alias("sk_id_curr_min"), F.max(KEY).alias("sk_id_curr_max"),
        # bounded by the batch size
        F.sort_array(F.collect_list(KEY)).alias("entity_ids"),
    ).withColumn("status", status)
    middle = grouped.agg(F.max("run").alias("m")).first()["m"] // 2
    last = F.lit(middle)
    named = grouped.withColumns(
        {
            "run_id": F.concat(F.lit("prod_"), F.lpad(F.col("run").cast("string"), 6, "0")),
            "rows_inserted": F.when(F.col("status") == "inserted", F.col("rows_selected")).otherwise(F.lit(0)),
        }
    )
    models = F.array(
        *[
            F.struct(
                F.lit(m).alias("model_name"),
                F.when((F.col("run") + i) % 3 == 0, "failed").otherwise("scored").alias("status"),
                F.when((F.col("run") + i) % 3 == 0, F.lit(0)).otherwise(F.col("rows_selected")).alias("rows_scored"),
                F.when((F.col("run") + i) % 3 != 0, (F.col("run") + i + 1) / F.lit(4.0)).alias("inference_seconds"),
            )
            for i, m in enumerate(("xgboost", "tabpfn_mix"))
        ]
    )
    inference = F.when(F.col("status") == "inserted", F.struct(F.lit("scored").alias("status"), models.alias("models")))
    text = F.to_json(F.struct(*[c for c in named.columns if c != "run"], inference.alias("inference")))
    whole = F.col("run") <= last
    return named.select(F.when(whole, text).otherwise(F.concat(F.left(text, F.lit(40)), F.lit("…"))).alias("document"))


def manifests(spark, root):
    """Readable manifests."""
    return parse_manifests(documents(spark, root), "document")


@query(
    "manifest_ledger",
    f"""SELECT run_id, status, first_rank AS holdout_start_rank, last_rank AS holdout_end_rank, n AS rows_selected,
 inserted AS rows_inserted, n AS ids FROM {LEDGER_SQL}""",
)
def _ledger(spark, root):
    return manifests(spark, root).select(
        "run_id", "status", "holdout_start_rank", "holdout_end_rank", "rows_selected", "rows_inserted",
        F.size("entity_ids").cast("bigint").alias("ids"),
    )


@query(
    "consumed_rank_max",
    f"""SELECT max(last_rank) AS consumed_rank_max FROM {LEDGER_SQL} WHERE status = 'inserted'""",
)
def _consumed(spark, root):
    return consumed_rank_max(manifests(spark, root))


@query(
    "inserted_ids",
    f"""SELECT "SK_ID_CURR" FROM {RANKS_SQL} r JOIN {LEDGER_SQL} l
 ON r.holdout_rank BETWEEN l.first_rank AND l.last_rank WHERE l.status = 'inserted'""",
)
def _inserted(spark, root):
    return inserted_entity_ids(manifests(spark, root), KEY)


@query("inserted_ids_large", """SELECT o_orderkey AS "SK_ID_CURR" FROM orders""")
def _inserted_large(spark, root):
    """A batch of any size leaves its ids as rows; the manifest names them and later batches see them."""
    ids = table(spark, root, "orders").select(F.col("o_orderkey").alias(KEY))
    placed = row_ids(ids, RANK, [F.col(KEY)], start=1, unique_order=True)
    folder = staging_path(spark, "runs")
    batch = next_batch(placed, manifests(spark, root).limit(0), 1 << 40, KEY, unique_ranks=True)
    write_manifest(batch_manifest(batch, "all", "inserted", KEY, True, folder), folder, "all")
    return inserted_entity_ids(read_ledger(spark, folder), KEY)


_NEXT_SQL = f"""(SELECT holdout_rank, "SK_ID_CURR" FROM {RANKS_SQL} WHERE holdout_rank BETWEEN
 (SELECT max(last_rank) + 1 FROM {LEDGER_SQL} WHERE status = 'inserted') AND
 (SELECT max(last_rank) + 100 FROM {LEDGER_SQL} WHERE status = 'inserted'))"""


@query(
    "holdout_next_batch",
    f"""SELECT "SK_ID_CURR", c_nationkey, c_acctbal, c_mktsegment FROM {APPLICATIONS_SQL}
 WHERE "SK_ID_CURR" IN (SELECT "SK_ID_CURR" FROM {_NEXT_SQL})""",
)
def _next(spark, root):
    batch = next_batch(ranks(spark, root), manifests(spark, root), 100, KEY, unique_ranks=True)
    return prepare_batch(batch, applications(spark, root), KEY, TARGET)


@query(
    "batch_manifest",
    f"""SELECT 'prod_next' AS run_id, 'inserted' AS status,
 (SELECT max(last_rank) FROM {LEDGER_SQL} WHERE status = 'inserted') AS previous_consumed_rank_max,
 min(holdout_rank) AS holdout_start_rank, max(holdout_rank) AS holdout_end_rank, count(*) AS rows_inserted,
 min("SK_ID_CURR") AS sk_id_curr_min, max("SK_ID_CURR") AS sk_id_curr_max, true AS target_removed FROM {_NEXT_SQL}""",
)
def _manifest(spark, root):
    """The manifest is written to the ledger folder and read back."""
    batch = next_batch(ranks(spark, root), manifests(spark, root), 100, KEY, unique_ranks=True)
    folder = staging_path(spark, "runs")
    write_manifest(batch_manifest(batch, "prod_next", "inserted", KEY, True), folder, "prod_next")
    return read_ledger(spark, folder).select(
        "run_id", "status", "previous_consumed_rank_max", "holdout_start_rank", "holdout_end_rank", "rows_inserted",
        "sk_id_curr_min", "sk_id_curr_max", "target_removed",
    )


_RUNS_OF = 15


@query(
    "batches_in_turn",
    f"""SELECT CASE WHEN holdout_rank <= {_RUNS_OF} THEN 'r1' ELSE 'r2' END AS run_id, 'refreshed' AS refresh,
 count(*) AS rows_inserted, min(holdout_rank) AS holdout_start_rank, max(holdout_rank) AS holdout_end_rank, sum("SK_ID_CURR")::BIGINT AS id_sum
 FROM {RANKS_SQL} WHERE holdout_rank <= {2 * _RUNS_OF} GROUP BY 1""",
)
def _in_turn(spark, root):
    """Two runs claim their ranks, append, commit their manifests, and commit a further version of them."""
    placed, source = ranks(spark, root), applications(spark, root)
    folder, storage = staging_path(spark, "runs"), staging_path(spark, "table")
    for run in ("r1", "r2"):
        insert_batch(spark, placed, source, folder, storage, run, _RUNS_OF, KEY, TARGET, unique_ranks=True)
        update_manifest(spark, folder, run, dw_refresh={"status": "refreshed"})
    found = read_ledger(spark, folder).select("run_id", "dw_refresh.status", "rows_inserted", "holdout_start_rank", "holdout_end_rank")
    stored = spark.read.parquet(storage).select(KEY)
    sums = read_id_rows(spark, f"{folder}_ids").join(stored, KEY, "left_semi").groupBy("run_id").agg(F.sum(KEY).cast("bigint").alias("id_sum"))
    return found.withColumnRenamed("status", "refresh").join(sums, "run_id")


@query(
    "inserted_ids_folders",
    """SELECT o_orderkey AS "SK_ID_CURR" FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def _inserted_folders(spark, root):
    """Manifests of one ledger may name ids below several folders."""
    ids = table(spark, root, "orders").select(F.col("o_orderkey").alias(KEY), "o_orderstatus")
    folders = {s: staging_path(spark, f"runs-{s}") for s in ("F", "O")}
    rows = []
    for end, (status, folder) in enumerate(folders.items(), 1):
        path = write_entity_ids(ids.where(F.col("o_orderstatus") == status), folder, f"run_{status}", KEY)
        rows.append((f'{{"run_id": "run_{status}", "status": "inserted", "rows_inserted": 1, "holdout_end_rank": {end}, "entity_ids_path": "{path}"}}',))
    found = parse_manifests(spark.createDataFrame(rows, "document string"), "document")
    return inserted_entity_ids(found, KEY)


@query(
    "preflight_duplicates",
    f"""SELECT "SK_ID_CURR", count(*) AS rows FROM {CREDITS_SQL}
 WHERE "SK_ID_CURR" IN (SELECT "SK_ID_CURR" FROM {_NEXT_SQL}) GROUP BY 1""",
)
def _preflight(spark, root):
    batch = next_batch(ranks(spark, root), manifests(spark, root), 100, KEY, unique_ranks=True)
    return already_stored(credits(spark, root), batch.ids.select(KEY), KEY)


@query(
    "manifest_counts",
    f"""SELECT (SELECT count(*) FROM {_NEXT_SQL}) AS entity_count,
 (SELECT count(*) FROM {CREDITS_SQL} WHERE "SK_ID_CURR" IN (SELECT "SK_ID_CURR" FROM {_NEXT_SQL})) AS bureau,
 (SELECT count(*) FROM {APPLICATIONS_SQL} WHERE "SK_ID_CURR" IN (SELECT "SK_ID_CURR" FROM {_NEXT_SQL})) AS application""",
)
def _counts(spark, root):
    batch = next_batch(ranks(spark, root), manifests(spark, root), 100, KEY, unique_ranks=True)
    tables = {"bureau": credits(spark, root), "application": applications(spark, root)}
    return scoped_counts(batch.ids.select(KEY), tables, KEY)


# ---------------------------------------------------------------- model results

RESULTS_SQL = f"""(SELECT run_id, run, m.name AS model_name, CASE WHEN (run + m.i) % 3 = 0 THEN 'failed' ELSE 'scored' END
 AS status FROM {LEDGER_SQL}, (VALUES (0, 'xgboost'), (1, 'tabpfn_mix')) m(i, name) WHERE status = 'inserted')"""


def results(spark, root):
    """(run_id, model_name, status) of all model results."""
    exploded = manifests(spark, root).select("run_id", F.explode("inference.models").alias("m"))
    return exploded.select("run_id", "m.model_name", "m.status")


@query(
    "run_status",
    f"""SELECT run_id, CASE WHEN count(r.status) FILTER (WHERE r.status = 'scored') = 0 THEN 'failed'
 WHEN count(*) FILTER (WHERE r.status = 'scored') = count(*) THEN 'scored' ELSE 'partial' END AS inference_status
 FROM {LEDGER_SQL} l LEFT JOIN {RESULTS_SQL} r USING (run_id) GROUP BY 1""",
)
def _status(spark, root):
    return run_status(manifests(spark, root), results(spark, root))


@query(
    "model_result_upsert",
    f"""SELECT run_id, model_name, CASE WHEN model_name = 'xgboost' THEN 'scored' ELSE status END AS status
 FROM {RESULTS_SQL} UNION ALL SELECT DISTINCT run_id, 'pyod_autoencoder', 'scored' FROM {RESULTS_SQL}""",
)
def _upsert(spark, root):
    """A second scoring replaces one model's results and adds another model."""
    first = results(spark, root)
    again = first.where(F.col("model_name") == "xgboost").withColumn("status", F.lit("scored"))
    added = again.withColumn("model_name", F.lit("pyod_autoencoder"))
    return upsert_results(first, again.unionByName(added))


@query("model_result_latest", f"SELECT run_id, model_name, 'retried' AS status, 2 AS attempt FROM {RESULTS_SQL}")
def _latest(spark, root):
    first = results(spark, root).withColumn("attempt", F.lit(1))
    return latest_results(first.unionByName(first.withColumns({"attempt": F.lit(2), "status": F.lit("retried")})), "attempt")


# ---------------------------------------------------------------- predictions

MODELS = (("xgboost", 1), ("tabpfn_mix", 7), ("pyod_autoencoder", 13))
PREDICTIONS_SQL = """(SELECT 'run_' || lang AS run_id, m.name AS model_name, doc_id AS "SK_ID_CURR",
 ((n_chars * m.f) % 1000) / 1000.0::DOUBLE AS score, (((n_chars * m.f) % 1000) >= 500)::INTEGER AS prediction,
 TIMESTAMP '2024-01-31 12:00:00' + to_seconds(doc_id) AS predicted_at,
 m.name || '_run_' || lang || '_predictions.parquet' AS prediction_path, m.name || '_run_' || lang || '_metrics.json' AS metrics_path
 FROM documents, (VALUES ('xgboost', 1), ('tabpfn_mix', 7), ('pyod_autoencoder', 13)) m(name, f))"""
PREDICTED_AT_SQL = "strftime(predicted_at, '%Y-%m-%d %H:%M:%S') AS predicted_at"


def predictions(spark, root):
    """Stored predictions: three models over all documents, one run per language."""
    d = table(spark, root, "documents").select("doc_id", "lang", "n_chars")
    per_model = d.withColumn(
        "m", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(f).alias("f")) for n, f in MODELS]))
    )
    permille = (F.col("n_chars") * F.col("m.f")) % 1000
    scored = per_model.select(
        F.col("doc_id").alias(KEY), "lang", F.col("m.name").alias("model_name"),
        (permille / F.lit(1000.0)).alias("score"), (permille >= 500).cast("int").alias("prediction"),
    )
    run = F.concat(F.lit("run_"), "lang")
    stem = F.concat("model_name", F.lit("_"), run)
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-31 12:00:00")) + F.col(KEY))
    return prediction_rows(
        scored, run, at, F.concat(stem, F.lit("_predictions.parquet")), F.concat(stem, F.lit("_metrics.json")), KEY
    )


def stamped(df):
    """Timestamps as text."""
    return df.withColumn("predicted_at", F.date_format("predicted_at", "yyyy-MM-dd HH:mm:ss"))


@query("prediction_rows", f"SELECT * REPLACE ({PREDICTED_AT_SQL}) FROM {PREDICTIONS_SQL}")
def _rows(spark, root):
    return stamped(predictions(spark, root))


# the first delivery holds two models, the second all three with other scores: only the third is new
@query(
    "predictions_idempotent",
    f"""SELECT run_id, model_name, "SK_ID_CURR", CASE WHEN model_name = 'pyod_autoencoder' THEN -1.0::DOUBLE
 ELSE score END AS score FROM {PREDICTIONS_SQL}""",
)
def _idempotent(spark, root):
    path = staging_path(spark, "predictions")
    all_rows = predictions(spark, root)
    persist_predictions(spark, all_rows.where(F.col("model_name") != "pyod_autoencoder"), path)
    again = all_rows.withColumn("score", F.lit(-1.0))
    persist_predictions(spark, again, path)
    persist_predictions(spark, again, path)
    return spark.read.parquet(path).select("run_id", "model_name", KEY, "score")
