"""Classification metrics as distributed aggregates over scored rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import ratio
from ledgerloom.operators.ordering import running_totals


def confusion_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: precision, recall, f1; 0 where a divisor is 0."""
    t, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn")
    )
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn"))
    return counts.select(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def ranked_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg, cum_pos, cum_neg) per distinct score, best score first.

    Rows are counted per score before they are sorted, so ties cost nothing.
    """
    groups = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_totals(groups, [F.col("score").desc()], {"cum_pos": "pos", "cum_neg": "neg"})


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: roc_auc (ties count half) and pr_auc (step-wise average precision).

    With one class only, roc_auc is 0; without positives pr_auc is 0.
    """
    before = F.col("cum_pos") - F.col("pos")
    sums = ranked_counts(df, label, score).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("p"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n"),
        F.sum(F.col("neg") * (before + F.col("pos") / 2.0)).alias("area"),
        F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("steps"),
    )
    return sums.select(
        ratio(F.col("area"), F.col("p") * F.col("n")).alias("roc_auc"),
        ratio(F.col("steps"), F.col("p")).alias("pr_auc"),
    )


def classification_metrics(
    df: DataFrame, label: str, prediction: str, score: str, prefix: str = ""
) -> DataFrame:
    """One row of all five metrics, names prefixed."""
    row = one_row(confusion_metrics(df, label, prediction), ranking_metrics(df, label, score))
    return row.select(*[F.col(c).alias(f"{prefix}{c}") for c in row.columns])


def one_row(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns put side by side."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def truth_metrics(
    predictions: DataFrame, truth: DataFrame | None, key: str, target: str = "TARGET"
) -> DataFrame:
    """One row: truth_status, truth_rows_matched and the ``holdout_`` metrics, null if undefined."""
    spark = predictions.sparkSession
    names = ["precision", "recall", "f1", "roc_auc", "pr_auc"]
    if truth is None:
        status = spark.createDataFrame([("missing", None)], "truth_status string, truth_rows_matched bigint")
        return status.select("*", *[F.lit(None).cast("double").alias(f"holdout_{n}") for n in names])
    joined = predictions.join(truth.select(key, target), key)
    matched = joined.agg(F.count(F.lit(1)).alias("truth_rows_matched"))
    row = one_row(matched, classification_metrics(joined, target, "prediction", "score", "holdout_"))
    any_row = F.col("truth_rows_matched") > 0
    return row.select(
        F.when(any_row, "evaluated").otherwise("no_matches").alias("truth_status"),
        "truth_rows_matched",
        *[F.when(any_row, F.col(f"holdout_{n}")).alias(f"holdout_{n}") for n in names],
    )
