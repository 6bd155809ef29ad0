"""Denormalisation: dimension joins by convention, by key metadata, and by dictionary."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.naming import (
    ENTITY_KEYS,
    base_column,
    description_column,
    dimension_name,
    matching_dictionary,
)
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.ordering import dedup_by_key

_KEY = "__lookup_key"
_TEXT = "__lookup_text"


def dictionary(dim: DataFrame, key: str | None = None) -> DataFrame:
    """Lookup table of a dimension: its key column first, one row per non-null key."""
    key = key or dim.columns[0]
    rest = [c for c in dim.columns if c != key]
    return dedup_by_key(dim.where(F.col(key).isNotNull()).select(key, *rest), key)


def dict_lookup(
    fact: DataFrame,
    dim: DataFrame,
    id_column: str,
    target: str,
    default: str | None = None,
    key: str | None = None,
    text: str | None = None,
) -> DataFrame:
    """Replace ``id_column`` in place by the description ``target`` found in ``dim``.

    An id without an entry gives ``default``, or null.
    """
    key = key or dim.columns[0]
    text = text or description_column(dim.columns, key)
    pairs = dictionary(dim, key).select(F.col(key).alias(_KEY), F.col(text).alias(_TEXT))
    joined = lookup_join(fact.withColumn(_KEY, F.col(id_column)), pairs, _KEY, "left")
    found = F.col(_TEXT) if default is None else F.coalesce(F.col(_TEXT), F.lit(default))
    return joined.select(
        *[found.alias(target) if c == id_column else F.col(f"`{c}`") for c in fact.columns]
    )


def denormalize(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Every ``X_ID`` with a ``dim_x`` becomes ``X``, taken from the dimension's second column."""
    def replace(df: DataFrame, column: str) -> DataFrame:
        base = base_column(column)
        dim = dims.get(dimension_name(base)) if base else None
        if dim is None:
            return df
        return dict_lookup(df, dim, column, base, text=dim.columns[1])

    return reduce(replace, fact.columns, fact)


def reconstruct(
    fact: DataFrame, expected: list[str], dims: Mapping[str, DataFrame], foreign_keys: Collection[str]
) -> DataFrame:
    """The expected source columns in order: stored, or behind a listed foreign key, or null."""
    out = fact
    for column in expected:
        fk = f"{column}_ID"
        if column not in fact.columns and fk in fact.columns and fk in foreign_keys:
            dim = dims[dimension_name(column)]
            out = dict_lookup(out.withColumn(column, F.col(fk)), dim, column, column, key=fk, text=column)
    return out.select(
        *[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in expected]
    )


def report(
    storage: DataFrame, dictionaries: Mapping[str, DataFrame], default: str | None = None
) -> DataFrame:
    """Report rows of a storage table: each id with a dictionary becomes its description."""
    out = storage
    for column in storage.columns:
        name = matching_dictionary(column, dictionaries.keys())
        if name is None:
            continue
        dim = dictionaries[name]
        if description_column(dim.columns, column) is None:
            continue
        text = description_column(dim.columns, column)
        out = dict_lookup(out, dim, column, base_column(column), default, text=text)
    return out


def rename_by_dimension(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rename ``X_ID`` to the second column of its dimension; entity keys keep their name."""
    names = {}
    for column in df.columns:
        base = base_column(column)
        if base is None or column in ENTITY_KEYS:
            continue
        dim = dims.get(dimension_name(base))
        if dim is not None and len(dim.columns) > 1:
            names[column] = dim.columns[1]
    return df.withColumnsRenamed(names)


def preagg_join(base: DataFrame, child: DataFrame, key: str, aggregates: dict) -> DataFrame:
    """Aggregate the many side to the key first, then left join: no base row is repeated."""
    grouped = child.groupBy(key).agg(*[expr.alias(name) for name, expr in aggregates.items()])
    return base.join(grouped, key, "left")
