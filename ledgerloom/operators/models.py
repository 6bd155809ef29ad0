"""Training, tuning and scoring with Spark ML."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import min_max_scaled
from ledgerloom.operators.boost import BoostModel
from ledgerloom.operators.forest import FEW_LEVELS, ForestModel
from ledgerloom.operators.metrics import classification_metrics
from ledgerloom.operators.mlprep import Preprocessor, split_features_target, stratified_split
from ledgerloom.operators.net import NetModel
from ledgerloom.operators.ordering import exact_quantiles
from ledgerloom.operators.profile import throughput
from ledgerloom.sources.staging import stage, wide_rows

# Model settings and search ranges (low, high, logarithmic).
DEFAULTS: dict[str, dict[str, Any]] = {
    "random_forest": {"n_estimators": 200, "max_depth": 30, "class_weight": "balanced"},
    "xgboost": {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.05},
    "local_neural_net": {"hidden_units": [256, 128], "epochs": 20, "batch_size": 512, "learning_rate": 0.001},
    "pyod_autoencoder": {"contamination": 0.081, "components": 16},
}
SEARCH_RANGES: dict[str, dict[str, tuple[float, float, bool]]] = {
    "random_forest": {"n_estimators": (50, 400, False), "max_depth": (3, 20, False)},
    "xgboost": {
        "n_estimators": (50, 500, False), "max_depth": (2, 10, False), "learning_rate": (0.01, 0.2, True),
    },
    "local_neural_net": {"epochs": (5, 50, False), "learning_rate": (0.0001, 0.01, True)},
}


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add ``n / (2 * n_class)`` per row."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (2.0 * n))).otherwise(weight)
    return df.withColumn(name, weight)


# ---------------------------------------------------------------- anomaly model


@dataclass
class AnomalyModel:
    """Reconstruction error of principal components fitted on normal rows."""

    pca: PCAModel
    mean: list[float]
    low: float
    high: float
    threshold: float

    @classmethod
    def fit(cls, df: DataFrame, components: int, contamination: float) -> AnomalyModel:
        """Fit on the rows with label 0; their score range and quantile set scale and cut."""
        normal = df.where(F.col("label") == 0)
        if normal.isEmpty():
            raise ValueError("the anomaly model needs at least one row with label 0")
        mean = [float(v) for v in normal.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"]]
        k = min(components, max(1, len(mean) - 1))
        pca = PCA(k=k, inputCol="features", outputCol="__z").fit(normal)
        model = cls(pca, mean, 0.0, 0.0, 0.0)
        scores = stage(model.errors(normal).select("error"), "errors")
        bounds = scores.agg(F.min("error").alias("a"), F.max("error").alias("b")).first()
        cut = exact_quantiles(scores, ["error"], [1.0 - contamination]).first()["value"]
        return cls(pca, mean, bounds["a"], bounds["b"], cut)

    def errors(self, df: DataFrame) -> DataFrame:
        """Add ``error``: squared distance to the component subspace through the mean."""
        centre = [float(v) for v in self.pca.pc.toArray().T @ self.mean]
        projected = self.pca.transform(df)

        def squares(vector: str, middle: list[float]):
            gaps = F.zip_with(
                vector_to_array(F.col(vector)), F.array(*[F.lit(v) for v in middle]), lambda a, b: a - b
            )
            return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)

        error = F.greatest(squares("features", self.mean) - squares("__z", centre), F.lit(0.0))
        return projected.withColumn("error", error).drop("__z")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score`` in [0, 1] and ``prediction``."""
        scored = self.errors(df)
        score = min_max_scaled(F.col("error"), F.lit(self.low), F.lit(self.high))
        flag = (F.col("error") > F.lit(self.threshold)).cast("int")
        return scored.withColumns({"score": score, "prediction": flag}).drop("error")


# models that add the score themselves
SCORERS = (AnomalyModel, NetModel, ForestModel, BoostModel)

# ---------------------------------------------------------------- bundle


@dataclass
class Bundle:
    """Fitted preparation and model with the columns and metrics of the training run."""

    model_name: str
    target: str
    feature_columns: list[str]
    preprocessor: Preprocessor
    model: Any
    metrics: dict[str, float] = field(default_factory=dict)

    def score(self, features: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
        """(key, score, prediction, model_name): one lazy plan from features to scores."""
        ready = self.preprocessor.transform(features, [key, *keep])
        out = self.model.transform(ready)
        if not isinstance(self.model, SCORERS):
            score = vector_to_array("probability")[1]
            out = out.withColumn("score", score)
        return out.select(
            key, *keep, "score", F.col("prediction").cast("int").alias("prediction"),
            F.lit(self.model_name).alias("model_name"),
        )

    def evaluate(self, features: DataFrame, key: str, prefix: str = "full_") -> dict[str, float]:
        """Metrics of labelled feature rows."""
        with wide_rows(features.sparkSession):
            return _metrics(self.score(features, key, [self.target]), self.target, prefix)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write all parts below ``path``."""
        meta = {
            "model_name": self.model_name, "target": self.target,
            "feature_columns": self.feature_columns, "metrics": self.metrics,
        }
        if isinstance(self.model, AnomalyModel):
            m = self.model
            meta["anomaly"] = {"mean": m.mean, "low": m.low, "high": m.high, "threshold": m.threshold}
            m.pca.write().overwrite().save(f"{path}/model")
        elif isinstance(self.model, NetModel):
            meta["net"] = self.model.sizes
            self.model.save(spark, f"{path}/model")
        elif isinstance(self.model, ForestModel):
            meta["forest"] = True
            self.model.save(spark, f"{path}/model")
        elif isinstance(self.model, BoostModel):
            meta["boost"] = True
            self.model.save(spark, f"{path}/model")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        self.preprocessor.save(spark, f"{path}/preprocessor")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        """Read back what ``save`` wrote."""
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        anomaly, net, forest, boost = (meta.pop(k, None) for k in ("anomaly", "net", "forest", "boost"))
        if anomaly:
            model: Any = AnomalyModel(PCAModel.load(f"{path}/model"), **anomaly)
        elif net:
            model = NetModel.load(spark, f"{path}/model", net)
        elif forest:
            model = ForestModel.load(spark, f"{path}/model")
        elif boost:
            model = BoostModel.load(spark, f"{path}/model")
        else:
            model = PipelineModel.load(f"{path}/model")
        return cls(preprocessor=Preprocessor.load(spark, f"{path}/preprocessor"), model=model, **meta)


def _metrics(scored: DataFrame, target: str, prefix: str) -> dict[str, float]:
    staged = stage(scored.select(target, "prediction", "score"), "scored")
    return classification_metrics(staged, target, "prediction", "score", prefix).first().asDict()


def prepare_splits(
    features: DataFrame, key: str, target: str, exclude: Sequence[str], min_frequency: int, seed: int,
    test_size: float = 0.2, validation_size: float = 0.2,
) -> tuple[Preprocessor, DataFrame, list[str]]:
    """Preparation fitted on the training rows, and all rows with their split, staged once."""
    with wide_rows(features.sparkSession):
        columns, _ = split_features_target(features, target, [*exclude, key])
        split = stratified_split(features, [key], target, test_size, validation_size, seed)
        staged = stage(split, "features")
        train = staged.where(F.col("split") == "train").select(*columns.columns)
        prepared = Preprocessor.fit(train, min_frequency)
        ready = prepared.transform(staged, [key, target, "split"])
        ready = ready.withColumn("label", F.col(target).cast("double"))
        return prepared, stage(ready, "prepared"), columns.columns


def fit_model(name: str, train: DataFrame, params: Mapping[str, Any], size: int, seed: int = 42):
    """Fit one model on prepared training rows."""
    p = {**DEFAULTS[name], **params}
    if name == "pyod_autoencoder":
        return AnomalyModel.fit(train, p["components"], p["contamination"])
    if name == "local_neural_net":
        return NetModel.fit(train, size, p["hidden_units"], p["epochs"], p["batch_size"], p["learning_rate"], seed)
    weighted = class_weights(train, "label") if p.get("class_weight") == "balanced" else train
    if name == "random_forest":
        weight = "weight" if p.get("class_weight") == "balanced" else None
        return ForestModel.fit(weighted, p["n_estimators"], min(p["max_depth"] or 30, 30), seed, weight)
    if name == "xgboost":
        return BoostModel.fit(train, p["n_estimators"], p["max_depth"], p["learning_rate"])
    raise ValueError(f"unknown model: {name}")


def train_model(
    features: DataFrame, key: str, target: str, model_name: str,
    params: Mapping[str, Any] | None = None, exclude: Sequence[str] = (),
    min_frequency: int = 10, seed: int = 42,
) -> Bundle:
    """Split, prepare, fit, and measure on validation and test rows."""
    started = time.perf_counter()
    prepared, ready, columns = prepare_splits(features, key, target, exclude, min_frequency, seed)
    preprocess_seconds = time.perf_counter() - started
    started = time.perf_counter()
    model = fit_model(model_name, ready.where(F.col("split") == "train"), params or {}, prepared.size(), seed)
    metrics: dict[str, float] = {
        "preprocess_seconds": preprocess_seconds, "train_seconds": time.perf_counter() - started,
    }
    for part in ("validation", "test"):
        started = time.perf_counter()
        rows = ready.where(F.col("split") == part)
        metrics |= _metrics(scored_rows(model, rows, target), target, f"{part}_")
        metrics[f"{part}_predict_seconds"] = time.perf_counter() - started
        counts = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("p")).first()
        metrics |= {f"{part}_rows": float(counts["n"]), f"{part}_positives": counts["p"]}
    return Bundle(model_name, target, columns, prepared, model, metrics)


def scored_rows(model: Any, ready: DataFrame, target: str) -> DataFrame:
    """(target, score, prediction) of prepared rows."""
    out = model.transform(ready)
    if not isinstance(model, SCORERS):
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.select(target, "score", F.col("prediction").cast("int").alias("prediction"))


# ---------------------------------------------------------------- tuning


def parameter_grid(options: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Cartesian product of the options."""
    return [dict(zip(options, values)) for values in product(*options.values())]


def random_parameters(model_name: str, trials: int, seed: int = 42) -> list[dict[str, Any]]:
    """Seeded draws from the model's search ranges."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        one: dict[str, Any] = {}
        for name, (low, high, logarithmic) in SEARCH_RANGES[model_name].items():
            if logarithmic:
                one[name] = low * (high / low) ** rng.random()
            else:
                one[name] = rng.randint(int(low), int(high))
        drawn.append(one)
    return drawn


def search(
    features: DataFrame, key: str, target: str, model_name: str, trials: Sequence[Mapping[str, Any]],
    exclude: Sequence[str] = (), min_frequency: int = 10, seed: int = 42,
    on_trial: Callable[[dict[str, Any]], None] | None = None, parallel: int = 4,
) -> DataFrame:
    """(trial, parameters, status, validation_pr_auc, error) in the order of the trials, failed ones kept.

    Split and preparation are shared by all trials: one staged table. Trials of a random forest share one forest of the most
    trees and levels that any of them asks for: a trial's model is its first trees, cut at its own depth. At most ``parallel`` trials run at a time, each in a
    scheduler pool of its own, so that the jobs of one fill the gaps of another. ``on_trial`` is called in order.
    """
    spark = features.sparkSession
    prepared, ready, _ = prepare_splits(features, key, target, exclude, min_frequency, seed)
    train = ready.where(F.col("split") == "train")
    held_out = ready.where(F.col("split") == "validation")
    shared = _shared_forest(train, held_out, target, trials, seed) if model_name == "random_forest" else {}

    def run(trial: tuple[int, Mapping[str, Any]]) -> dict[str, Any]:
        number, params = trial
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{number % parallel}")
        record = {"trial": number, "parameters": json.dumps(dict(params), sort_keys=True)}
        try:
            scored = shared.get(number)
            if scored is None:
                scored = scored_rows(fit_model(model_name, train, params, prepared.size(), seed), held_out, target)
            metrics = _metrics(scored, target, "validation_")
            return {**record, "status": "COMPLETE", "validation_pr_auc": metrics["validation_pr_auc"], "error": None}
        except Exception as error:  # noqa: BLE001 - a failing trial is a result
            return {**record, "status": "FAIL", "validation_pr_auc": None, "error": str(error)}
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    records = []
    with ThreadPoolExecutor(parallel) as pool:
        for record in pool.map(inheritable_thread_target(spark)(run), enumerate(trials)):
            records.append(record)
            if on_trial:
                on_trial(record)
    schema = "trial int, parameters string, status string, validation_pr_auc double, error string"
    rows = [tuple(r[k] for k in ("trial", "parameters", "status", "validation_pr_auc", "error")) for r in records]
    return spark.createDataFrame(rows, schema)


def _shared_forest(
    train: DataFrame, held_out: DataFrame, target: str, trials: Sequence[Mapping[str, Any]], seed: int
) -> dict[int, DataFrame]:
    """(target, score, prediction) by number of a trial, for the trials whose forests are parts of one.

    Left out: trials of other settings than trees and depth, those that cannot be fitted, and all of them where
    the largest needs only the few levels of Spark's own forest.
    """
    shapes = {}
    for number, trial in enumerate(trials):
        p = {**DEFAULTS["random_forest"], **trial}
        depth = min(p["max_depth"] or 30, 30)
        if set(trial) <= {"n_estimators", "max_depth"} and p["n_estimators"] > 0 and depth > 0:
            shapes[number] = (p["n_estimators"], depth)
    if len(shapes) < 2 or max(depth for _, depth in shapes.values()) <= FEW_LEVELS:
        return {}
    largest = dict(zip(("n_estimators", "max_depth"), map(max, zip(*shapes.values()))))
    try:
        model = fit_model("random_forest", train, largest, 0, seed)
        if not isinstance(model, ForestModel):
            return {}
        scored = stage(model.scores(held_out, list(shapes.values())).select(target, "scores"), "trial-scores")
    except Exception:  # noqa: BLE001 - each trial is then fitted by itself and records its own failure
        return {}
    return {
        number: scored.select(target, F.col("scores")[at].alias("score")).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
        for at, number in enumerate(shapes)
    }


def rank_models(metrics: DataFrame, metric: str = "test_pr_auc") -> DataFrame:
    """Model metric rows, best first."""
    return metrics.orderBy(F.col(metric).desc_nulls_last(), "model_name")


# ---------------------------------------------------------------- scoring runs


def score_models(
    bundles: Mapping[str, Bundle | Exception], features: DataFrame, key: str,
    sink: Callable[[str, DataFrame], int],
) -> list[dict[str, Any]]:
    """Score every model; a failing one is recorded and does not stop the others.

    ``sink`` writes one model's predictions and returns the row count.
    """
    results = []
    for name, bundle in bundles.items():
        started = time.perf_counter()
        try:
            if isinstance(bundle, Exception):
                raise bundle
            scored = bundle.score(features, key).withColumn("model_name", F.lit(name))
            rows = sink(name, scored)
            results.append(
                {"model_name": name, "status": "scored", "rows_scored": rows,
                 "inference_seconds": time.perf_counter() - started, "error": None}
            )
        except Exception as error:  # noqa: BLE001 - isolation of one model is the feature
            results.append(
                {"model_name": name, "status": "failed", "rows_scored": 0,
                 "inference_seconds": None, "error": str(error)}
            )
    return results


def scoring_benchmark(
    bundle: Bundle, features: DataFrame, key: str, sizes: Sequence[int] = (1, 10, 100, 1000)
) -> DataFrame:
    """(rows_requested, rows_scored, seconds) and throughput of scoring the first n entities."""
    rows = []
    for size in sizes:
        started = time.perf_counter()
        with wide_rows(features.sparkSession):
            scored = bundle.score(features.orderBy(key).limit(size), key)
            count = scored.agg(F.count("score").alias("n")).first()["n"]
        rows.append((size, count, time.perf_counter() - started))
    schema = "rows_requested int, rows_scored bigint, seconds double"
    return throughput(features.sparkSession.createDataFrame(rows, schema), "rows_scored", "seconds")
