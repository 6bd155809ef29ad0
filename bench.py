"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HEADLINE = (
    "feature_table",
    "feature_table_scoped",
    "aggregate_by_key",
    "bridge_aggregate",
    "report_table",
    "warehouse_build",
    "dim_extract",
    "table_fingerprint",
    "column_mismatch_counts",
    "column_profile",
    "correlation_matrix",
    "describe_numeric",
    "pr_auc",
    "preprocess_matrix",
    "predictions_idempotent",
    "prediction_distribution",
    "holdout_next_batch",
    "refresh_scope",
)
#: Rows that a stored bundle scores in one measured job; training is measured apart.
SCORED = (1_000, 5_000, 10_000)


def scoring(spark, sf_dir: str) -> dict[str, float]:
    """Seconds to train and store a random forest, and to load it and score the first n entities."""
    from ledgerloom.operators.models import Bundle
    from ledgerloom.plans.registry.learning import KEY, stored_bundle

    started = time.perf_counter()
    path, features = stored_bundle(spark, sf_dir)
    seconds = {"train_random_forest": round(time.perf_counter() - started, 3)}
    for rows in SCORED:
        started = time.perf_counter()
        scored = Bundle.load(spark, path).score(features.orderBy(KEY).limit(rows), KEY)
        scored.write.format("noop").mode("overwrite").save()
        seconds[f"batch_score_{rows}"] = round(time.perf_counter() - started, 3)
    return seconds


def main() -> None:
    from ledgerloom.plans.registry import QUERIES
    from ledgerloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # one machine: its own temporary folder is shared by all of Spark here
    shared = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-")
    settings = {"spark.checkpoint.dir": shared, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else None, settings)
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    # one untimed run pays for JVM and code generation start-up
    QUERIES["feature_table"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    if len(sys.argv) == 1:
        seconds |= scoring(spark, sf_dir)
    rates = {f"score_rows_per_second_{n}": round(n / seconds[f"batch_score_{n}"], 1) for n in SCORED if f"batch_score_{n}" in seconds}
    result = {
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), **rates,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
