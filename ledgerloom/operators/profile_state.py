"""Profiles that grow with a table: a stored state per file, merged for the whole table.

A file's state holds, for every column, its rows, nulls, moments, bounds, a sketch of the distinct values and one of the
quantiles. States are added for files that are new, in one commit with the files' names, and merging them never
reads the table. Counts, means, deviations and bounds are exact; distinct counts and quantiles are estimates.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.naming import numeric_columns
from ledgerloom.sources.versions import VersionedTable, files_of, open_rows

#: Standard error of a distinct count is about 1.04 / sqrt(2 ** DISTINCT_BITS): 1.6 per cent.
DISTINCT_BITS = 12


def _missing(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    return F.nanvl(value, F.lit(None).cast(dict(df.dtypes)[column])) if dict(df.dtypes)[column] in ("float", "double") else value


def file_states(df: DataFrame) -> DataFrame:
    """(file, column, type, rows, filled, mean, squares, low, high, text_low, text_high, distinct, quantiles) of a scan's files.

    ``squares`` are the summed squares about the file's mean; ``low`` and ``high`` are of numbers, the text bounds of all else.
    NaN is null. One pass, aggregated per file before the shuffle.
    """
    numbers, kinds = set(numeric_columns(df.schema)), dict(df.dtypes)
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def state(c: str) -> Column:
        v = _missing(df, c)
        n = v.cast("double") if c in numbers else none
        t = text if c in numbers else v.cast("string")
        return F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.count(F.lit(1)).alias("rows"), F.count(v).alias("filled"),
            F.avg(n).alias("mean"), (F.var_pop(n) * F.count(n)).alias("squares"), F.min(n).alias("low"), F.max(n).alias("high"),
            F.min(t).alias("text_low"), F.max(t).alias("text_high"), F.hll_sketch_agg(v.cast("string"), DISTINCT_BITS).alias("distinct"),
            F.kll_sketch_agg_double(n).alias("quantiles"),
        )

    states = [state(c).alias(f"s{i}") for i, c in enumerate(df.columns)]
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(*states)
    return per_file.select("file", F.explode(F.array(*[f"s{i}" for i in range(len(states))])).alias("s")).select("file", "s.*")


def refresh_profile(spark: SparkSession, table: str, state: str) -> int:
    """Add the states of the table's files that ``state`` does not hold; returns their number. Only those files are read."""
    stored = VersionedTable(spark, state)
    while True:
        fresh = sorted(set(files_of(spark, table)) - stored.inputs())
        if not fresh:
            return 0
        root = urlparse(table)
        paths = [f"{root.scheme}://{root.netloc}{f}" if root.scheme else f for f in fresh]
        rows = file_states(spark.read.schema(open_rows(spark, table).schema).parquet(*paths))
        named = rows.withColumn("file", F.parse_url("file", F.lit("PATH")))
        if stored.append(named, fresh) is not None:
            return len(fresh)


def merged(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, type, rows, null_count, mean, std, low, high, text_low, text_high, distinct_values, quantiles) over all files.

    The deviation is that of a sample. Files' squares are moved to the common mean, so files of any sizes merge exactly.
    """
    filled = F.sum("filled")
    mean = F.sum(F.col("mean") * F.col("filled")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("filled")))
    whole = states.groupBy("column").agg(
        F.max("type").alias("type"), F.sum("rows").alias("rows"), (F.sum("rows") - filled).alias("null_count"), filled.alias("__n"),
        mean.alias("mean"), F.sum("squares").alias("__within"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("text_low").alias("text_low"), F.max("text_high").alias("text_high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
        F.kll_merge_agg_double("quantiles").alias("__sketch"),
    )
    between = states.join(whole.select("column", F.col("mean").alias("__mean")), "column").groupBy("column").agg(
        F.sum(F.col("filled") * (F.col("mean") - F.col("__mean")) * (F.col("mean") - F.col("__mean"))).alias("__between")
    )
    std = F.sqrt((F.col("__within") + F.col("__between")) / F.when(F.col("__n") > 1, F.col("__n") - 1))
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    quantiles = F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("__sketch", asked))
    return whole.join(between, "column").select(
        "column", "type", "rows", "null_count", "mean", std.alias("std"), "low", "high", "text_low", "text_high", "distinct_values",
        quantiles.alias("quantiles"),
    )


def profile_of(spark: SparkSession, table: str, state: str) -> DataFrame:
    """The merged profile of the files that the table has now; those that it no longer has are passed over."""
    now = spark.createDataFrame([(f,) for f in files_of(spark, table)], "file string")
    return merged(VersionedTable(spark, state).read().join(now, "file", "left_semi"))
