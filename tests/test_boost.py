"""Boosted trees by histograms, against plain loops over all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerloom.operators import boost
from ledgerloom.operators.boost import BoostModel
from ledgerloom.operators.forest import binned
from ledgerloom.operators.models import Bundle, fit_model, train_model

BINS = 32


def _rows(spark, n=3000):
    side = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(700)) / 70.0 for i in range(3)]
    rows = spark.range(n).repartition(3).select("id", *[s.alias(f"c{i}") for i, s in enumerate(side)])
    label = ((F.floor(F.col("c0") / 3) + F.floor(F.col("c1") / 4)) % 2).cast("double")
    return rows.select("id", label.alias("label"), array_to_vector(F.array("c0", "c1", "c2")).alias("features"))


def _plain(x, y, rounds, depth, rate):
    """Margins by trees that are grown node by node, each split found by trying all of them."""
    share = y.mean()
    margin = np.full(len(y), math.log(share / (1 - share)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h, change = p - y, p * (1 - p), np.zeros(len(y))

        def down(rows, level, g=g, h=h, change=change):
            def worth(at):
                return g[at].sum() ** 2 / (h[at].sum() + 1)

            tries = []
            for f in range(x.shape[1]) if level < depth else ():
                for c in range(BINS - 1):
                    left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                    if h[left].sum() >= 1 and h[right].sum() >= 1:
                        tries.append((round(worth(left) + worth(right) - worth(rows), 7), -f, -c, left, right))
            best = max(tries, key=lambda t: t[:3], default=(0,))
            if best[0] <= 1e-6:
                change[rows] = -rate * g[rows].sum() / (h[rows].sum() + 1)
            else:
                down(best[3], level + 1)
                down(best[4], level + 1)

        down(np.arange(len(y)), 0)
        margin = margin + change
    return margin


@pytest.mark.parametrize("renewed, sums, few", [(50, 1 << 21, 64), (2, 400, 0)])
def test_margins_equal_plain_loops(spark, monkeypatch, renewed, sums, few):
    """However often lineage is cut, nodes are asked for in turns, and sums are added up."""
    monkeypatch.setattr(boost, "RENEWED", renewed)
    monkeypatch.setattr(boost, "MOST_SUMS", sums)
    monkeypatch.setattr(boost, "FEW_TASKS", few)
    monkeypatch.setattr(boost, "BLOCK", 500)
    data = _rows(spark)
    model = fit_model("xgboost", data, {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}, 3)
    assert isinstance(model, BoostModel) and len(model.trees) == 5
    got = data.collect()
    values = np.array([r["features"].toArray() for r in got])
    want = _plain(binned(values, model.edges), np.array([r["label"] for r in got]), 5, 3, 0.3)
    assert np.allclose(model.margins(values), want)
    scored = {r["id"]: r for r in model.transform(data).collect()}
    assert np.allclose([scored[r["id"]]["score"] for r in got], 1 / (1 + np.exp(-want)))
    assert all(r["prediction"] == (r["score"] > 0.5) for r in scored.values())


def test_a_level_is_one_job(spark):
    """Three hundred rounds must not cost some jobs more each."""
    data, context = _rows(spark).persist(), spark.sparkContext
    context.setJobGroup("boosting", "jobs of a fit")
    fit_model("xgboost", data, {"n_estimators": 10, "max_depth": 2}, 3)
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("boosting")) <= 10 * 2 + 8


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_gives_leaves(spark, label):
    data = _rows(spark, 50).withColumn("label", F.lit(label))
    model = fit_model("xgboost", data, {"n_estimators": 2}, 3)
    assert {r["prediction"] for r in model.transform(data).collect()} == {int(label)}
    with pytest.raises(ValueError):
        fit_model("xgboost", data.limit(0), {"n_estimators": 2}, 3)
    with pytest.raises(ValueError):
        fit_model("xgboost", data, {"n_estimators": 2, "max_depth": -1}, 3)


def test_a_saved_bundle_scores_the_same(spark, folder):
    side = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(90)) / 9.0).alias(f"c{i}") for i in range(2)]
    features = spark.range(400).select("id", *side).withColumn("y", (F.col("c0") > 4).cast("int"))
    bundle = train_model(features, "id", "y", "xgboost", {"n_estimators": 4, "learning_rate": 0.5})
    assert bundle.metrics["test_roc_auc"] > 0.95
    bundle.save(spark, folder)
    want = {r["id"]: r["score"] for r in bundle.score(features, "id").collect()}
    assert {r["id"]: r["score"] for r in Bundle.load(spark, folder).score(features, "id").collect()} == want
