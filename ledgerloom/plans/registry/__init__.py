"""Every operator as a query over the test tables, with its SQL counterpart."""

from __future__ import annotations

from ledgerloom.plans.registry import (  # noqa: F401
    features,
    incremental,
    learning,
    lookups,
    metadata,
    monitoring,
    normalization,
    profiles,
    quality,
    scans,
    warehouse,
)
from ledgerloom.plans.registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
