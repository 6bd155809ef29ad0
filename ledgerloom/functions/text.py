"""Text expressions of the normalisation and comparison jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for a missing value once trimmed and upper-cased.
NULL_TOKENS = ("", "NA", "N/A", "NULL", "NAN")


def type_label(column: Column) -> Column:
    """``Type <n>`` for a value that holds a numbered type, else ``Type 0``."""
    number = F.regexp_extract(F.lower(column), r"type\s*(\d+)", 1)
    return F.when(F.coalesce(number, F.lit("")) == "", F.lit("Type 0")).otherwise(
        F.concat(F.lit("Type "), number)
    )


def without_type(column: Column) -> Column:
    """The value without its numbered type; kept whole if nothing else remains."""
    rest = F.trim(F.regexp_replace(column, r"(?i)[:-]?\s*type\s*\d+", ""))
    return F.when(rest == "", column).otherwise(rest)


def null_token_to_null(column: Column) -> Column:
    """Null for text that only spells a missing value."""
    return F.when(F.upper(F.trim(column)).isin(*NULL_TOKENS), F.lit(None)).otherwise(column)


def model_from_file_name(name: Column, run_id: Column) -> Column:
    """Model part of ``<model>_<run>_predictions``, else the text before the first ``_``."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    suffix = F.concat(F.lit("_"), run_id, F.lit("_predictions"))
    return F.when(
        stem.endswith(suffix), F.left(stem, F.length(stem) - F.length(suffix))
    ).otherwise(F.split(stem, "_", 2)[0])


def run_id(prefix: str, at: Column) -> Column:
    """Sortable run id: prefix and the time to the second."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(at, "yyyyMMdd_HHmmss"))
