"""Naming conventions that tie columns, dimensions, dictionaries and features together."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

# Technical row id, the keys that never name a dimension, reserved prefixes.
ROW_ID = "_DW_ID"
TECHNICAL_COLUMNS = frozenset({ROW_ID})
ENTITY_KEYS = ("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV")
REPORT_PREFIX = "rep_"
DIMENSION_PREFIX = "dim_"
DICTIONARY_PREFIX = "dict_dim_"

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
)


def numeric_columns(schema: T.StructType) -> list[str]:
    """Integer and floating columns; boolean, decimal, date and timestamp do not count."""
    return [f.name for f in schema if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(schema: T.StructType) -> list[str]:
    """Text columns in schema order."""
    return [f.name for f in schema if isinstance(f.dataType, T.StringType)]


def feature_name(prefix: str, column: str, statistic: str) -> str:
    """``prefix__column__statistic`` with a lower-case column."""
    return f"{prefix}__{column.lower()}__{statistic}"


def dimension_name(column: str) -> str:
    """Dimension table of a descriptive column."""
    return DIMENSION_PREFIX + column.lower()


def base_column(id_column: str) -> str | None:
    """Descriptive column behind an ``X_ID`` column, or None."""
    return id_column[:-3] if id_column.upper().endswith("_ID") else None


def matching_dictionary(id_column: str, dictionaries: Collection[str]) -> str | None:
    """Dictionary of an id column; a trailing ``_<digit>`` of the base name may be absent."""
    base = base_column(id_column)
    if base is None:
        return None
    names = [base.lower()]
    if len(base) > 2 and base[-2] == "_" and base[-1].isdigit():
        names.append(base[:-2].lower())
    found = (DICTIONARY_PREFIX + name for name in names)
    return next((name for name in found if name in dictionaries), None)


def description_column(columns: list[str], key: str) -> str | None:
    """First column that is neither the key nor an id, else the second column."""
    named = [c for c in columns if c != key and not c.endswith("_ID")]
    return named[0] if named else (columns[1] if len(columns) > 1 else None)


def storage_keys(columns: list[str]) -> list[str]:
    """Sort key of a storage table: all entity key columns, else the first column."""
    return [c for c in columns if c.startswith("SK_ID")] or columns[:1]
