"""Hold-out batches, manifest-scoped refresh, idempotent appends, top-n backup and delete."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import anti_join, lookup_join, semi_join
from ledgerloom.operators.ordering import dedup_by_key, first_rows, row_ids, total_order
from ledgerloom.operators.quality import require_columns, require_non_empty, require_positive, require_unique
from ledgerloom.sources.ledger import consumed_rank_max, inserted_entity_ids, write_entity_ids
from ledgerloom.sources.staging import stage

RANK = "holdout_rank"

# Column order of a stored prediction.
PREDICTION_COLUMNS = (
    "run_id", "model_name", "SK_ID_CURR", "score", "prediction", "predicted_at",
    "prediction_path", "metrics_path",
)


def holdout_truth(raw: DataFrame, warehouse: DataFrame, key: str, target: str) -> DataFrame:
    """(key, target) of raw rows whose key the warehouse does not have, one per key."""
    absent = anti_join(raw.select(key, target), warehouse.select(key), key)
    return dedup_by_key(absent, key)


def holdout_ranks(truth: DataFrame, key: str) -> DataFrame:
    """(holdout_rank, key): contiguous ranks 1..n in key order."""
    return row_ids(truth.select(key), RANK, [F.col(key)], start=1, unique_order=True)


@dataclass(frozen=True)
class Batch:
    """Ids of the next batch with the ranks it covers."""

    ids: DataFrame
    start_rank: int
    end_rank: int
    rows_requested: int
    previous_consumed_rank_max: int


def next_batch(
    ranks: DataFrame, manifests: DataFrame, rows: int, key: str, stored_ids: DataFrame | None = None,
    unique_ranks: bool = False,
) -> Batch:
    """Ids that follow the highest rank of an inserted manifest, up to ``rows`` of them.

    Errors: no ids left, repeated ranks or ids, ids that were inserted before. ``unique_ranks`` says
    that the ranks come from ``holdout_ranks``, which repeats none; others are checked in full. Only the
    rank mark and the batch's bounds, a few numbers, come to the driver.
    """
    require_positive(rows, "rows")
    require_columns(ranks, [RANK, key], "holdout ids")
    if not unique_ranks:
        require_unique(ranks, RANK, RANK)
        require_unique(ranks, key, key)
    consumed = consumed_rank_max(manifests).first()["consumed_rank_max"]
    ids = stage(rank_range(ranks, consumed + 1, consumed + rows).select(RANK, key), "batch")
    last = ids.agg(F.max(RANK).alias("m")).first()["m"]
    if last is None:
        require_non_empty(ids, "holdout batch")
    overlap = semi_join(ids, inserted_entity_ids(manifests, key, stored_ids), key)
    taken = [str(r[key]) for r in overlap.orderBy(key).limit(10).collect()]
    if taken:
        raise ValueError(f"ids of the next batch were inserted before: {', '.join(taken)}")
    return Batch(ids, consumed + 1, last, rows, consumed)


def rank_range(ranks: DataFrame, first: int, last: int) -> DataFrame:
    """Rows with ``first <= holdout_rank <= last``."""
    return ranks.where(F.col(RANK).between(first, last))


def missing_ids(ids: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Selected ids without a row in the source."""
    return anti_join(ids.select(key), source.select(key), key)


def prepare_batch(batch: Batch, source: DataFrame, key: str, target: str) -> DataFrame:
    """Source rows of the batch without the target, in no order; every id must be there."""
    absent = [str(r[key]) for r in missing_ids(batch.ids, source, key).orderBy(key).limit(10).collect()]
    if absent:
        raise ValueError(f"source lacks selected ids: {', '.join(absent)}")
    rows = semi_join(source, batch.ids, key)
    require_unique(rows, key, f"prepared {key}")
    return rows.drop(target)


def batch_manifest(
    batch: Batch, run_id: str, status: str, key: str, target_removed: bool, folder: str | None = None
) -> DataFrame:
    """One-row manifest of a batch: planned, manifest_only or inserted.

    The ids are rows at any size: with a ``folder`` they are written beside it, and the manifest names their
    path, number and range. It lists none itself; lists in manifests of other origin are read as well.
    """
    path = None if folder is None else write_entity_ids(batch.ids, folder, run_id, key)
    bounds = batch.ids.agg(
        F.count(F.lit(1)).alias("rows_selected"),
        F.min(key).alias("sk_id_curr_min"),
        F.max(key).alias("sk_id_curr_max"),
    )
    inserted = F.col("rows_selected") if status == "inserted" else F.lit(0)
    return bounds.select(
        F.lit(run_id).alias("run_id"),
        F.lit(status).alias("status"),
        F.lit(batch.previous_consumed_rank_max).cast("bigint").alias("previous_consumed_rank_max"),
        F.lit(batch.start_rank).cast("bigint").alias("holdout_start_rank"),
        F.lit(batch.end_rank).cast("bigint").alias("holdout_end_rank"),
        F.lit(batch.rows_requested).cast("bigint").alias("rows_requested"),
        "rows_selected",
        F.col("rows_selected").alias("rows_prepared"),
        inserted.cast("bigint").alias("rows_inserted"),
        "sk_id_curr_min", "sk_id_curr_max",
        F.array().cast("array<bigint>").alias("entity_ids"),
        F.lit(path).cast("string").alias("entity_ids_path"),
        F.lit(target_removed).alias("target_removed"),
    )


# ---------------------------------------------------------------- refresh


def already_stored(storage: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """(key, rows) of the ids the storage table has rows for, in key order."""
    counted = storage.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return semi_join(counted, ids, key).orderBy(key)


def refresh_rows(staging: DataFrame, storage: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Staging rows of the ids; an error names up to ten ids that storage already has."""
    require_non_empty(ids, "manifest entity_ids")
    require_unique(ids, key, "manifest entity_ids")
    stored = [str(r[key]) for r in already_stored(storage, ids, key).limit(10).collect()]
    if stored:
        raise ValueError(f"storage has rows of these ids: {', '.join(stored)}")
    return semi_join(staging, ids, key)


def scoped_counts(ids: DataFrame, tables: dict[str, DataFrame], key: str) -> DataFrame:
    """One row: entity_count and, per named table, its rows that belong to the ids."""
    counts = ids.agg(F.count(F.lit(1)).alias("n")).select(F.lit("entity_count").alias("name"), "n")
    for name, df in tables.items():
        scoped = semi_join(df.select(key), ids, key).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.unionByName(scoped.select(F.lit(name).alias("name"), "n"))
    names = ["entity_count", *tables]
    return counts.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


# ---------------------------------------------------------------- predictions


def prediction_rows(
    predictions: DataFrame, run_id: str | Column, predicted_at: Column, prediction_path: str | Column,
    metrics_path: str | Column, key: str = "SK_ID_CURR",
) -> DataFrame:
    """Scored rows with run metadata in the stored column order."""
    def column(value: str | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    extended = predictions.withColumns(
        {
            "run_id": column(run_id), "predicted_at": predicted_at,
            "prediction_path": column(prediction_path), "metrics_path": column(metrics_path),
        }
    )
    return extended.select(*[key if c == "SK_ID_CURR" else c for c in PREDICTION_COLUMNS])


def new_predictions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows of (run, model) pairs that are not stored yet.

    The stored pairs are few; incoming rows are not shuffled by them, for one pair may
    be all of the input.
    """
    keys = ["run_id", "model_name"]
    pairs = stored.select(*keys).distinct().withColumn("__stored", F.lit(True))
    return lookup_join(incoming, pairs, keys, "left").where(F.col("__stored").isNull()).drop("__stored")


def persist_predictions(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    """Append the (run, model) pairs the table does not have; a re-run adds nothing."""
    from ledgerloom.sources.tables import exists, write_table

    if exists(spark, path):
        incoming = new_predictions(spark.read.schema(incoming.schema).parquet(path), incoming)
    write_table(incoming, path, "append", ["run_id", "model_name"])


# ---------------------------------------------------------------- top-n backup, delete, restore


def top_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest ``column``, ascending; ties by the other columns."""
    order = [F.col(column).desc_nulls_last(), *total_order(df, [column])[1:]]
    return first_rows(df, order, n).orderBy(*total_order(df, [column]))


def top_n_preview(df: DataFrame, column: str, n: int) -> DataFrame:
    """One row: count, minimum and maximum of the rows a top-n delete removes."""
    return id_range(top_n(df, column, n), column)


def id_range(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, min_id, max_id."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("min_id"), F.max(column).alias("max_id")
    )


def without_top_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """The table without exactly the rows of ``top_n``.

    Rows beyond the boundary value are dropped by a pushed-down filter; only rows equal to
    it are numbered, by a distributed sort, and lose as many as the top held.
    """
    c = F.col(column)
    top = top_n(df, column, n).agg(
        F.count(c).alias("filled"), F.count_if(c.isNull()).alias("nulls"), F.min(c).alias("edge")
    ).first()
    if top["filled"] + top["nulls"] == 0:
        return df
    if top["nulls"]:
        return _without_first(df.where(c.isNull()), top["nulls"])
    edge = F.lit(top["edge"])
    beyond = df.agg(F.count_if(c > edge).alias("n")).first()["n"]
    tied = _without_first(df.where(c == edge), top["filled"] - beyond)
    return df.where((c < edge) | c.isNull()).unionByName(tied)


def _without_first(df: DataFrame, n: int) -> DataFrame:
    """All but the first ``n`` rows in total order."""
    return row_ids(df, "__n", total_order(df), start=1).where(F.col("__n") > n).drop("__n")


def first_n(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of a backup in key order."""
    return first_rows(df, total_order(df, order_by), n)
