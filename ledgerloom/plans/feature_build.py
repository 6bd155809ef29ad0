"""Feature table from the report tables of a folder."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.features import feature_table
from ledgerloom.plans.config import settings
from ledgerloom.sources.staging import stage
from ledgerloom.sources.tables import scan_table


def build_features(
    spark: SparkSession,
    root: str,
    config: Mapping[str, Any] | None = None,
    limit: int | None = None,
    entity_ids: DataFrame | None = None,
) -> DataFrame:
    """One row per entity; with ids or a limit every child scan is reduced to them first.

    The ids of a limited run are staged, so that all scans see the same entities.
    """
    conf = config or settings()
    key = conf["entity_key"]
    base = scan_table(spark, root, conf["base_table"], None, entity_ids, key, limit, [key])
    ids = entity_ids
    if ids is None and limit is not None:
        ids = stage(base.select(key).distinct(), "entity-ids")
    children: dict[str, dict[str, Any]] = {}
    for prefix, spec in conf["feature_tables"].items():
        child: dict[str, Any] = {**spec, "table": scan_table(spark, root, spec["table"])}
        if "bridge" in spec:
            child["bridge"] = scan_table(spark, root, spec["bridge"])
        children[prefix] = child
    return feature_table(base, key, children, ids)
