"""Table profiles: columns, variance, correlation, description, samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.naming import numeric_columns
from ledgerloom.functions.numbers import ratio
from ledgerloom.operators.ordering import exact_quantiles, first_rows
from ledgerloom.operators.quality import _long
from ledgerloom.sources.commits import Conflict
from ledgerloom.sources.versions import VersionedTable

# Pairs up to this number are one built-in aggregate each; more are summed per batch.
MAX_CORR_AGGREGATES = 300


def _distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_values): values are deduplicated as narrow rows before the shuffle.

    Whole numbers, dates and times travel as eight bytes and floats as doubles; only what is text stays text.
    """
    kinds = dict(df.dtypes)
    groups: dict[str, list[Column]] = {"bigint": [], "double": [], "string": []}
    for c in columns:
        v, kind = F.col(f"`{c}`"), kinds[c]
        if kind in ("float", "double"):
            # -0.0 becomes 0.0
            group, v = "double", (F.nanvl(v, F.lit(None).cast(kind)) + F.lit(0.0)).cast("double")
        elif kind in ("tinyint", "smallint", "int", "bigint", "boolean"):
            group = "bigint"
        elif kind == "date":
            group, v = "bigint", F.unix_date(v)
        elif kind == "timestamp":
            group, v = "bigint", F.unix_micros(v)
        else:
            group = "string"
        groups[group].append(v.cast(group).alias(c))
    counts = []
    for cells in groups.values():
        if cells:
            chosen = df.select(*cells)
            long = chosen.unpivot([], chosen.columns, "column", "value")
            values = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.lit(1).alias("o"))
            counts.append(values.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values")))
    return reduce(DataFrame.unionByName, counts)


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, null_count, null_pct, distinct_values) sorted by column; NaN is null."""
    kinds = dict(df.dtypes)
    columns = df.columns

    def missing(c: str):
        v = F.col(f"`{c}`")
        return v.isNull() | F.isnan(v) if kinds[c] in ("float", "double") else v.isNull()

    counted = df.agg(
        *[F.count_if(missing(c)).alias(f"null_count{i}") for i, c in enumerate(columns)],
        *[F.count(F.lit(1)).alias(f"rows{i}") for i in range(len(columns))],
        *[F.max(F.lit(kinds[c])).alias(f"type{i}") for i, c in enumerate(columns)],
    )
    long = _long(counted, columns, ["type", "null_count", "rows"])
    pct = F.when(F.col("rows") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("null_count") / F.col("rows") * 100, 4)
    )
    joined = long.join(_distinct_counts(df, columns), "column", "left")
    return joined.select(
        "column",
        F.coalesce("type", F.lit("")).alias("type"),
        "null_count",
        pct.alias("null_pct"),
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
    ).orderBy("column")


def _number(column: str):
    """A numeric column as double, NaN as null."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def low_variance(df: DataFrame) -> DataFrame:
    """(column, variance, distinct_values, is_constant) of numeric columns, least varying first; NaN is null."""
    columns = numeric_columns(df.schema)
    counted = df.agg(*[F.var_samp(_number(c)).alias(f"variance{i}") for i, c in enumerate(columns)])
    long = _long(counted, columns, ["variance"])
    joined = long.join(_distinct_counts(df, columns), "column", "left")
    distinct = F.coalesce("distinct_values", F.lit(0))
    return joined.select(
        "column", "variance", distinct.alias("distinct_values"), (distinct <= 1).alias("is_constant")
    ).orderBy(F.col("variance").asc_nulls_last(), "column")


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(a, b, correlation) of column pairs over the rows where both are present; NaN is absent.

    The number of pairs decides the plan only: both forms fold NaN and centre the values, and give null
    where a column does not vary.
    """
    if len(pairs) <= MAX_CORR_AGGREGATES:
        row = df.agg(
            *[
                F.nanvl(F.corr(_number(a), _number(b)), F.lit(None).cast("double")).alias(f"r{i}")
                for i, (a, b) in enumerate(pairs)
            ]
        )
        entries = [
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
        return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return _summed_correlations(df, pairs)


def _summed_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Correlations of very many pairs: matrix products per Arrow batch, summed by Spark.

    Values are centred on the column means first, so the sums of squares keep their
    digits. Each task emits one row per pair, however many rows it reads.
    """
    columns = sorted({c for p in pairs for c in p})
    wanted = sorted({tuple(sorted((columns.index(a), columns.index(b)))) for a, b in pairs})
    clean = df.select(*[_number(c).alias(c) for c in columns])
    means = clean.agg(*[F.mean(c).alias(c) for c in columns]).first()
    centre = [float(means[c] or 0.0) for c in columns]

    def partial(batches):
        import numpy as np
        import pandas as pd

        left = np.array([i for i, _ in wanted])
        right = np.array([j for _, j in wanted])
        total = None
        for batch in batches:
            x = batch.to_numpy(dtype=float) - np.array(centre)
            m = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            sums = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
            total = sums if total is None else total + sums
        if total is not None:
            cells = total[:, left, right]
            yield pd.DataFrame(
                {"i": left, "j": right,
                 **{k: cells[n] for n, k in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy"))}}
            )

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = clean.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    r = F.when((F.col("n") > 1) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in columns])
    found = sums.select(
        F.element_at(names, F.col("i") + 1).alias("x"),
        F.element_at(names, F.col("j") + 1).alias("y"),
        r.alias("correlation"),
    )
    asked = df.sparkSession.createDataFrame(
        [(a, b, *sorted((a, b))) for a, b in pairs], "a string, b string, x string, y string"
    )
    return asked.join(found, ["x", "y"], "left").select("a", "b", "correlation")


def correlation_matrix(df: DataFrame) -> DataFrame:
    """(a, b, correlation) of every pair of numeric columns with ``a < b``; none below two."""
    columns = sorted(numeric_columns(df.schema))
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, correlation double")
    return correlations(df, list(combinations(columns, 2)))


def target_correlation(df: DataFrame, target: str, top: int | None = None) -> DataFrame:
    """(column, correlation) with the target, strongest first; all, or the first ``top``."""
    others = [c for c in numeric_columns(df.schema) if c != target]
    found = correlations(df, [(target, c) for c in others])
    ranked = found.select(F.col("b").alias("column"), "correlation")
    ordered = ranked.orderBy(F.abs("correlation").desc_nulls_last(), "column")
    return ordered if top is None else ordered.limit(top)


def describe_numeric(df: DataFrame) -> DataFrame:
    """(column, n, nulls, mean, std, min, p25, p50, p75, max) with exact quartiles."""
    columns = numeric_columns(df.schema)
    kinds = dict(df.dtypes)

    def number(c: str):
        v = F.col(f"`{c}`")
        return F.nanvl(v, F.lit(None).cast(kinds[c])) if kinds[c] in ("float", "double") else v

    fields = {
        "n": lambda c: F.count(c), "nulls": lambda c: F.count_if(c.isNull()),
        "mean": F.mean, "std": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
    }
    basic = df.agg(
        *[f(number(c)).alias(f"{name}{i}") for name, f in fields.items() for i, c in enumerate(columns)]
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = quartiles.groupBy("column").pivot("probability", [0.25, 0.5, 0.75]).agg(F.max("value"))
    named = wide.toDF("column", "p25", "p50", "p75")
    return _long(basic, columns, list(fields)).join(named, "column", "left")


def _sample_hash(key: Sequence[str], seed: int):
    return F.md5(F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in key], F.lit(str(seed))))


def reproducible_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows chosen by the md5 of key and seed; a smaller table comes back whole.

    The rows with the smallest hashes are the sample. The row count tells below which hash they must lie, so one scan keeps
    little more than ``n`` rows and only those are ordered; a bound that keeps too few is doubled.
    """
    hashed = df.withColumn("__h", _sample_hash(key, seed))
    total = df.count()
    share = 1.0 if total <= n else min(1.0, (n + 8 * math.sqrt(n) + 32) / total)
    while share < 1.0:
        # the first 15 hexadecimal digits are a number below 2**60
        low = hashed.where(F.conv(F.left("__h", F.lit(15)), 16, 10).cast("bigint") < F.lit(int(share * (1 << 60))))
        if low.count() >= n:
            hashed = low
            break
        share *= 2
    return first_rows(hashed, ["__h", *key], n).drop("__h")


def running_sample(state: DataFrame | None, batch: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """The sample of all rows so far from that of the earlier ones and a batch: the same for any split into batches."""
    rows = reproducible_sample(batch, n, key, seed)
    return rows if state is None else reproducible_sample(state.unionByName(rows), n, key, seed)


def maintain_sample(stream: DataFrame, output: str, checkpoint: str, n: int, key: Sequence[str], seed: int = 42) -> StreamingQuery:
    """Keep the sample of a stream's rows in the versioned table ``output``; a batch that is redone counts once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, output)
        name = f"{checkpoint}#{batch_id}"
        while name not in table.inputs():
            state = table.read() if table.version() else None
            try:
                table.replace(running_sample(state, batch, n, key, seed), [name])
            except Conflict:
                continue

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column profiles of all tables in one frame."""
    parts = [column_profile(df).withColumn("table", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def profile_report(
    df: DataFrame, name: str, target: str | None = None
) -> str:
    """Markdown summary of one table, with all rows of its profile frames (one per column)."""
    lines = [f"# {name}", "", "| column | type | nulls | null % | distinct |", "|---|---|---|---|---|"]
    for r in column_profile(df).toLocalIterator():
        lines.append(
            f"| {r['column']} | {r['type']} | {r['null_count']} | {r['null_pct']} | {r['distinct_values']} |"
        )
    lines += ["", "## Lowest variance", ""]
    for r in low_variance(df).toLocalIterator():
        lines.append(f"- {r['column']}: {r['variance']} ({r['distinct_values']} values)")
    if target in df.columns:
        lines += ["", f"## Correlation with {target}", ""]
        for r in target_correlation(df, target).toLocalIterator():
            lines.append(f"- {r['column']}: {r['correlation']}")
    return "\n".join(lines)


def throughput(df: DataFrame, rows: str, seconds: str) -> DataFrame:
    """Add rows_per_second and avg_latency_ms_per_row, 0 where the divisor is missing."""
    n, s = F.coalesce(F.col(rows), F.lit(0)), F.coalesce(F.col(seconds), F.lit(0))
    return df.withColumns(
        {
            "rows_per_second": F.round(ratio(n, s), 6),
            "avg_latency_ms_per_row": F.round(ratio(s * 1000, n), 6),
        }
    )
