"""Lookup joins that broadcast only a measured small side and spread measured hot keys otherwise."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys that a sketch of the key column names at most, its counters, and the pieces into which a task's fair share is cut.
HOT_KEYS, COUNTERS, PIECES = 1024, 8192, 16
_SALT, _HASH, _COPIES = "__salt", "__key_hash", "__copies"


def broadcast_size(df: DataFrame) -> tuple[int, int]:
    """Rows and an upper estimate of bytes, from one partially aggregated pass."""
    text = [c for c, t in df.dtypes if t in ("string", "binary")]
    complex_ = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    fixed = 16 * len(df.columns)
    width: Column = F.lit(fixed)
    for name in text:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    for name in complex_:
        width = width + F.coalesce(
            F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0)
        )
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether the measured size of ``df`` lies within the broadcast bounds."""
    rows, size = broadcast_size(df)
    return rows <= max_rows and size <= max_bytes


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(hash of the key, copies) of keys with many rows: a key gets a copy for each piece of a task's fair share.

    One pass counts the rows and sketches the keys' frequencies. At most ``HOT_KEYS`` rows, and in all not
    more copies than ``PIECES`` a task and one a key, whatever the data.
    """
    spark = df.sparkSession
    row = df.select(F.xxhash64(*keys).alias(_HASH)).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({_HASH}, {HOT_KEYS}, {COUNTERS})").alias("top")
    ).first()
    piece = max(1.0, row["n"] / (PIECES * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = [(t["item"], math.ceil(t["count"] / piece)) for t in row["top"] or ()]
    return spark.createDataFrame([f for f in found if f[1] > 1], f"{_HASH} bigint, {_COPIES} int")


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a possibly skewed ``left`` to a ``lookup`` with unique keys.

    A lookup within the bounds is broadcast, so ``left`` is not shuffled. For a larger one the
    frequencies of the keys are measured: rows of a hot or null key are spread over as many tasks as its share asks
    for, and only that key's lookup row is copied; all other rows are joined plainly. Rows that are alike are spread
    too, as far as they come from different tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup, max_rows, max_bytes):
        return left.join(F.broadcast(lookup), keys, how)
    hot = F.broadcast(hot_keys(left, keys))
    copies = F.coalesce(F.col(_COPIES), F.lit(1))
    # the same on every run of a task, for a task always holds the same rows
    spread = F.xxhash64(F.spark_partition_id(), *_hashable(left))
    marked = left.withColumns({_HASH: F.xxhash64(*keys), _SALT: spread}).join(hot, _HASH, "left")
    salted = marked.withColumn(_SALT, F.pmod(_SALT, copies).cast("int")).drop(_HASH, _COPIES)
    copied = lookup.withColumn(_HASH, F.xxhash64(*keys)).join(hot, _HASH, "left")
    copied = copied.withColumn(_SALT, F.explode(F.sequence(F.lit(0), copies - 1))).drop(_HASH, _COPIES)
    return salted.join(copied, [*keys, _SALT], how).drop(_SALT)


def left_join_all(base: DataFrame, frames: Iterable[DataFrame], key: str) -> DataFrame:
    """Fold of left joins on one key; without frames the base itself."""
    return reduce(lambda left, right: left.join(right, key, "left"), frames, base)


def key_set(ids: DataFrame, key: str) -> DataFrame:
    """Distinct ``key`` values of ``ids``; a table without that column gives its only column."""
    if key not in ids.columns and len(ids.columns) != 1:
        raise ValueError(f"ids have no column {key}: {ids.columns}")
    return ids.select(F.col(key if key in ids.columns else ids.columns[0]).alias(key)).distinct()


def semi_join(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids``; ids stay a DataFrame at any size."""
    return df.join(key_set(ids, key), key, "left_semi")


def anti_join(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``ids``; null keys are kept."""
    return df.join(key_set(ids, key), key, "left_anti")


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]
