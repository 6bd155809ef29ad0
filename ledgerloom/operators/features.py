"""One-to-many history reduced to one row per entity, and the wide feature table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.naming import (
    TECHNICAL_COLUMNS,
    feature_name,
    numeric_columns,
    string_columns,
)
from ledgerloom.operators.joins import left_join_all, semi_join
from ledgerloom.operators.ordering import dedup_by_key

_STATS = ("mean", "min", "max", "sum", "std")
_ROWS = "__rows"


def _statistics(column: str, prefix: str, kind: str) -> list[Column]:
    """SQL text keeps the driver's work small: a wide table has thousands of these."""
    floating = kind in ("float", "double")
    # NaN is a missing measure: no statistic counts it
    c = f"nanvl(`{column}`, cast(null as {kind}))" if floating else f"`{column}`"
    zero = "0D" if floating else "0L"
    values = {
        "mean": f"avg({c})", "min": f"min({c})", "max": f"max({c})", "sum": f"coalesce(sum({c}), {zero})",
        "std": f"stddev_samp({c})",
    }
    return [F.expr(f"{values[s]} AS `{feature_name(prefix, column, s)}`") for s in _STATS]


def aggregate_by_key(
    df: DataFrame,
    key: str,
    prefix: str,
    excluded: Collection[str] = (),
    keep_null_key: bool = True,
) -> DataFrame:
    """One row per key: row count, five statistics per number, distinct values per text.

    Statistics of numbers are one partially aggregated pass. Distinct texts are counted
    on narrow (key, column, value) rows, which are deduplicated before they are
    shuffled, instead of widening every row once per text column; a null counts as a
    value of its own. Both halves are partitioned by the key, so joining them
    moves nothing when null keys are left out.
    """
    skipped = set(excluded) | TECHNICAL_COLUMNS | {key}
    numbers = [c for c in numeric_columns(df.schema) if c not in skipped]
    texts = [c for c in string_columns(df.schema) if c not in skipped]
    if not keep_null_key:
        df = df.where(F.col(key).isNotNull())
    kinds = dict(df.dtypes)
    stats = [e for c in numbers for e in _statistics(c, prefix, kinds[c])]
    result = df.groupBy(key).agg(F.count(F.lit(1)).alias(f"{prefix}__row_count"), *stats)
    if not texts:
        return result
    counted = _distinct_texts(df, key, prefix, texts)
    if not keep_null_key:
        return result.join(counted, key, "left")
    other = counted.withColumnRenamed(key, "__key")
    joined = result.join(other, result[key].eqNullSafe(other["__key"]), "left")
    return joined.drop("__key")


def _distinct_texts(df: DataFrame, key: str, prefix: str, texts: list[str]) -> DataFrame:
    cells = df.select(
        key,
        F.explode(
            F.array(
                *[F.struct(F.lit(i).alias("c"), F.col(f"`{t}`").alias("v")) for i, t in enumerate(texts)]
            )
        ).alias("cell"),
    ).select(key, "cell.c", "cell.v")
    values = cells.groupBy(key, "c", "v").agg(F.lit(1).alias("one"))
    return values.groupBy(key).agg(
        *[
            F.count(F.when(F.col("c") == i, F.lit(1))).alias(feature_name(prefix, t, "nunique"))
            for i, t in enumerate(texts)
        ]
    )


def bridge_aggregate(
    child: DataFrame, bridge: DataFrame, bridge_key: str, entity_key: str, prefix: str,
    keep_null_key: bool = True, entity_ids: DataFrame | None = None,
) -> DataFrame:
    """Aggregate ``child`` per bridge row, then per entity over the entity's bridge rows.

    Bridge rows without children stay, with nulls. The statistics of the first level,
    its row count and distinct counts are numbers of the second level.
    """
    per_bridge = aggregate_by_key(child, bridge_key, f"{prefix}_by_bureau", keep_null_key=False)
    pairs = bridge.select(entity_key, bridge_key).distinct()
    if entity_ids is not None:
        pairs = semi_join(pairs, entity_ids, entity_key)
    joined = pairs.join(per_bridge, bridge_key, "left")
    return aggregate_by_key(joined, entity_key, prefix, {bridge_key}, keep_null_key)


def feature_table(
    base: DataFrame,
    key: str,
    children: dict[str, dict],
    entity_ids: DataFrame | None = None,
) -> DataFrame:
    """Base rows (one per key) with the aggregates of every child table joined on.

    ``children`` maps a prefix to ``{"table": df, "key": column}`` or, through a bridge,
    ``{"table": df, "bridge": df, "bridge_key": column, "key": column}``. With
    ``entity_ids`` the base and every child's aggregate are reduced by semi joins. The
    join stands above the aggregate, so a hot key is one row per task before any
    shuffle; Catalyst moves it below where the ids are few enough to be broadcast.
    """
    if entity_ids is not None:
        base = semi_join(base, entity_ids, key)
    frames = []
    for prefix, spec in children.items():
        table, child_key = spec["table"], spec["key"]
        if "bridge" in spec:
            bridge, bridge_key = spec["bridge"], spec["bridge_key"]
            frame = bridge_aggregate(
                table, bridge, bridge_key, child_key, prefix, keep_null_key=False, entity_ids=entity_ids
            )
        else:
            frame = aggregate_by_key(table, child_key, prefix, keep_null_key=False)
            if entity_ids is not None:
                frame = semi_join(frame, entity_ids, child_key)
        frames.append(frame.withColumnRenamed(child_key, key) if child_key != key else frame)
    return left_join_all(dedup_by_key(base, key), frames, key)
