"""Run ledger: manifests as JSON documents, numbered versions per run, plus their entity ids as rows.

A manifest is never changed: an update is a further version, created only if no other writer created it, and the
ledger is the fold over the versions. Ranks are claimed in the same way before a batch is written.

The ids of a batch are a Parquet table partitioned by run. A manifest lists them only
for batches of a bounded size; lists found in manifests written elsewhere are read too.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.commits import CommitLog, Conflict
from ledgerloom.sources.tables import exists

MODEL_RESULT = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("prediction_path", T.StringType()),
        T.StructField("metrics_path", T.StringType()),
        T.StructField("rows_scored", T.LongType()),
        T.StructField("inference_seconds", T.DoubleType()),
        T.StructField("clickhouse_status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("previous_consumed_rank_max", T.LongType()),
        T.StructField("holdout_start_rank", T.LongType()),
        T.StructField("holdout_end_rank", T.LongType()),
        T.StructField("rows_requested", T.LongType()),
        T.StructField("rows_selected", T.LongType()),
        T.StructField("rows_prepared", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("sk_id_curr_min", T.LongType()),
        T.StructField("sk_id_curr_max", T.LongType()),
        T.StructField("entity_ids", T.ArrayType(T.LongType())),
        T.StructField("entity_ids_path", T.StringType()),
        T.StructField("target_removed", T.BooleanType()),
        T.StructField("dw_refresh", T.StructType(
            [
                T.StructField("status", T.StringType()),
                T.StructField("entity_count", T.LongType()),
                T.StructField("storage_count", T.LongType()),
                T.StructField("reporting_count", T.LongType()),
            ]
        )),
        T.StructField("inference", T.StructType(
            [
                T.StructField("status", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("models", T.ArrayType(MODEL_RESULT)),
            ]
        )),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifests of a folder: of a run with numbered versions the last one; documents that are not JSON are skipped."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    number = F.regexp_extract(name, r"^v(\d{8})$", 1)
    text = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "[!.]*.json").text(path, wholetext=True)
        .select("value", name.alias("stem"), F.col("_metadata.file_path").alias("file"), number.try_cast("bigint").alias("version"))
    )
    folder = F.regexp_replace("file", r"/[^/]*$", "")
    # a document of other origin stands for itself, a version for the run whose folder it lies in
    run = F.when(F.col("version").isNotNull(), folder).otherwise(F.col("file"))
    last = text.groupBy(run.alias("run")).agg(F.max_by(F.struct("value", "stem"), F.coalesce("version", F.lit(0))).alias("m"))
    return parse_manifests(last.select("m.*"), "value", "stem")


def parse_manifests(documents: DataFrame, column: str, stem: str | None = None) -> DataFrame:
    """Manifests held as JSON text; bad documents are skipped, ``stem`` names unnamed runs."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    name = F.col(stem) if stem else F.lit(None).cast("string")
    parsed = documents.select(
        name.alias("__stem"), F.from_json(column, MANIFEST, options).alias("m")
    ).select("__stem", "m.*")
    good = parsed.where(F.col("_corrupt").isNull())
    return good.withColumn("run_id", F.coalesce("run_id", "__stem")).drop("_corrupt", "__stem")


def is_inserted() -> Column:
    """Manifest of rows that were really inserted."""
    return (
        (F.col("status") == "inserted")
        & (F.coalesce("rows_inserted", F.lit(0)) > 0)
        & (F.coalesce("holdout_end_rank", F.lit(0)) > 0)
    )


def consumed_rank_max(manifests: DataFrame) -> DataFrame:
    """One row: the highest rank an inserted manifest ends at, 0 without one."""
    top = manifests.where(is_inserted()).agg(F.max("holdout_end_rank").alias("m"))
    return top.select(F.coalesce("m", F.lit(0)).cast("bigint").alias("consumed_rank_max"))


def inserted_entity_ids(
    manifests: DataFrame, key: str = "SK_ID_CURR", stored: DataFrame | None = None
) -> DataFrame:
    """Distinct entity ids of inserted manifests: the rows at the paths they name, in ``stored``, and lists they hold."""
    inserted = manifests.where(is_inserted())
    listed = inserted.select(F.explode("entity_ids").alias(key))
    sources = [] if stored is None else [stored]
    if "entity_ids_path" in manifests.columns:
        # the runs' ids lie below a folder or a few
        above = F.regexp_replace("entity_ids_path", r"/[^/]*/?$", "")
        folders = inserted.where(F.col("entity_ids_path").isNotNull()).select(above).distinct().collect()
        found = (read_id_rows(manifests.sparkSession, f[0]) for f in folders)
        sources += [f for f in found if f is not None]
    runs = inserted.select("run_id").distinct()
    for rows in sources:
        listed = listed.unionByName(rows.join(runs, "run_id", "left_semi").select(F.col(key).cast("bigint").alias(key)))
    return listed.distinct()


def write_entity_ids(ids: DataFrame, folder: str, run_id: str, key: str = "SK_ID_CURR") -> str:
    """Write the id rows of a run and return their path; writing the same run again replaces them."""
    path = f"{folder.rstrip('/')}_ids/run_id={run_id}"
    ids.select(F.col(key).cast("bigint").alias(key)).write.mode("overwrite").parquet(path)
    return path


def read_entity_ids(spark: SparkSession, folder: str) -> DataFrame | None:
    """(key, run_id) rows of all runs, None before the first."""
    return read_id_rows(spark, f"{folder.rstrip('/')}_ids")


def read_id_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """(key, run_id) rows below a folder of ids, None if it does not exist."""
    if not exists(spark, path):
        return None
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.withColumn("run_id", F.col("run_id").cast("string"))


def _log(spark: SparkSession, folder: str, run_id: str) -> CommitLog:
    return CommitLog(spark, f"{folder.rstrip('/')}/{run_id}")


def write_manifest(manifest: DataFrame, folder: str, run_id: str) -> None:
    """Commit the one-row manifest of a run as its first version; a run that has one is an error."""
    # one row by contract
    text = manifest.toJSON().first()
    if not _log(manifest.sparkSession, folder, run_id).commit(1, json.loads(text)):
        raise FileExistsError(f"the ledger {folder} has run {run_id!r} already")


def has_run(spark: SparkSession, folder: str, run_id: str) -> bool:
    """Whether the ledger has a manifest of the run."""
    return _log(spark, folder, run_id).last() > 0


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The last version of every manifest below ``folder``."""
    return read_manifests(spark, folder)


def update_manifest(spark: SparkSession, folder: str, run_id: str, **fields: dict) -> int:
    """Commit a further version of a run's manifest with these fields set, such as ``dw_refresh`` and ``inference``.

    Fields that are not set stay, known or not; versions of writers that came between are built upon. Returns the version,
    0 for a run without a manifest.
    """
    log = _log(spark, folder, run_id)
    while (last := log.last()) and not log.commit(last + 1, {**log.read(last), **fields}):
        continue
    return last + 1 if last else 0


# ---------------------------------------------------------------- claims


def claim_ranks(spark: SparkSession, folder: str, run_id: str, start: int, end: int) -> bool:
    """Take the ranks from ``start`` on for a run before any of its rows are written; at most one run holds them.

    True: the run holds them, perhaps since an attempt that died. False: they were inserted meanwhile, so the
    caller's view of the ledger is old. Another run's claim without an end is a ``Conflict``; ``give_up`` ends it.
    """
    # beside the ledger, as the rows of ids are: claims are no manifests
    log = CommitLog(spark, f"{folder.rstrip('/')}_claims/{start:020d}")
    while True:
        last = log.last()
        if last:
            holder = log.read(last)["run_id"]
            manifest = _log(spark, folder, holder)
            done = manifest.last()
            status = manifest.read(done).get("status") if done else None
            if holder == run_id and status is None:
                return True
            if status == "inserted":
                return False
            if status != "given_up":
                raise Conflict(f"ranks from {start} are held by run {holder!r}, which has not ended")
        if log.commit(last + 1, {"run_id": run_id, "start": start, "end": end}):
            return True


def give_up(spark: SparkSession, folder: str, run_id: str) -> None:
    """End a run that died before its manifest, so that another can take its ranks; a run with a manifest is an error.

    Rows that it may have appended stay; the run that takes the ranks does not repeat them.
    """
    if not _log(spark, folder, run_id).commit(1, {"run_id": run_id, "status": "given_up", "rows_inserted": 0}):
        raise FileExistsError(f"run {run_id!r} has ended: it is in the ledger {folder}")


def upsert_results(results: DataFrame, updates: DataFrame) -> DataFrame:
    """Model results with updates replacing earlier ones of the same (run, model)."""
    keys = ["run_id", "model_name"]
    return results.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)


def latest_results(results: DataFrame, sequence: str) -> DataFrame:
    """Last result per (run, model) by ``sequence``."""
    order = W.partitionBy("run_id", "model_name").orderBy(F.col(sequence).desc())
    ranked = results.withColumn("__rn", F.row_number().over(order))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def run_status(runs: DataFrame, results: DataFrame) -> DataFrame:
    """(run_id, inference_status): scored, partial or failed; failed without results."""
    counted = results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "scored").alias("scored")
    )
    status = (
        F.when(F.coalesce("scored", F.lit(0)) == 0, "failed")
        .when(F.col("scored") == F.col("n"), "scored")
        .otherwise("partial")
    )
    return runs.select("run_id").join(counted, "run_id", "left").select(
        "run_id", status.alias("inference_status")
    )
