"""Feed-forward net for two classes, trained by data-parallel mini-batches.

An epoch is one Spark job. Every task starts from the same weights, takes Adam steps over the mini-batches of its own rows,
and hands on the change of its weights in slices; the slices are averaged by the rows behind them, each in a
task of its own, so only one set of weights reaches the driver. A table of few rows is one task's: then an epoch is
the usual sequence of steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.staging import stage

#: Mini-batches that a task should have at least, rows of a slice's array, and Adam's decays.
LEAST_BATCHES, SLICE = 32, 4096
DECAY, DECAY_SQUARES, SMALL = 0.9, 0.999, 1e-8


def _shapes(sizes: Sequence[int]) -> list[tuple[int, ...]]:
    """Shapes of weights and biases, layer by layer."""
    return [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,))]


def _unflat(flat, sizes: Sequence[int]) -> list:
    out, at = [], 0
    for shape in _shapes(sizes):
        n = math.prod(shape)
        out.append(flat[at: at + n].reshape(shape))
        at += n
    return out


def forward(layers: list, x) -> list:
    """Inputs of every layer and, last, the log odds of the positive class."""
    import numpy as np

    values = [x]
    for at in range(0, len(layers), 2):
        z = values[-1] @ layers[at] + layers[at + 1]
        values.append(np.maximum(z, 0) if at + 2 < len(layers) else z)
    return values


def gradients(layers: list, x, y) -> list:
    """Of the mean log loss, in the order of the layers."""
    import numpy as np

    values = forward(layers, x)
    delta = (1 / (1 + np.exp(-np.clip(values[-1], -30, 30))) - y[:, None]) / len(y)
    out: list = []
    for at in range(len(layers) - 2, -1, -2):
        value = values[at // 2]
        out = [value.T @ delta, delta.sum(axis=0), *out]
        if at:
            delta = (delta @ layers[at].T) * (value > 0)
    return out


def steps(flat, sizes: Sequence[int], x, y, batch_size: int, rate: float, seed: int):
    """The weights after one pass over the rows in random order by Adam."""
    import numpy as np

    flat = flat.copy()
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    order = np.random.default_rng(seed).permutation(len(y))
    for step, at in enumerate(range(0, len(y), batch_size), 1):
        rows = order[at: at + batch_size]
        slope = np.concatenate([g.ravel() for g in gradients(_unflat(flat, sizes), x[rows], y[rows])])
        first += (1 - DECAY) * (slope - first)
        second += (1 - DECAY_SQUARES) * (slope * slope - second)
        flat -= rate * (first / (1 - DECAY**step)) / (np.sqrt(second / (1 - DECAY_SQUARES**step)) + SMALL)
    return flat


@dataclass
class NetModel:
    """Sizes of the layers and all weights in one array."""

    sizes: list[int]
    flat: object

    @classmethod
    def fit(cls, df: DataFrame, size: int, hidden: Sequence[int], epochs: int, batch_size: int, rate: float, seed: int = 42) -> NetModel:
        """Fit on rows (features, label of 0 or 1)."""
        import numpy as np

        sizes = [size, *hidden, 1]
        draw = np.random.default_rng(seed)
        flat = np.concatenate([
            draw.normal(0, math.sqrt(2 / s[0]), math.prod(s)) if len(s) == 2 else np.zeros(s) for s in _shapes(sizes)
        ])
        count = df.count()
        if not count:
            raise ValueError("the net needs at least one row")
        tasks = max(1, count // (LEAST_BATCHES * batch_size))
        rows = stage(df.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")).repartition(tasks), "net-rows")
        for epoch in range(epochs):
            flat = flat + cls._epoch(rows, flat, sizes, batch_size, rate, 1000 * seed + epoch, tasks)
        return cls(sizes, flat)

    @staticmethod
    def _epoch(rows: DataFrame, flat, sizes: list[int], batch_size: int, rate: float, seed: int, tasks: int):
        import numpy as np

        shared = rows.sparkSession.sparkContext.broadcast(flat)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            from pyspark import TaskContext

            start, held = shared.value, shared.value
            number, seen, kept = 100 * TaskContext.get().partitionId() + seed, 0, []

            def learn(held, parts):
                x = np.concatenate([p[0] for p in parts])
                return steps(held, sizes, x, np.concatenate([p[1] for p in parts]), batch_size, rate, number)

            waiting = 0
            for batch in batches:
                y = batch.column(0).to_numpy()
                kept.append((batch.column(1).flatten().to_numpy().reshape(len(y), -1), y))
                waiting += len(y)
                seen += len(y)
                if waiting >= 2 * LEAST_BATCHES * batch_size:
                    held, kept, waiting = learn(held, kept), [], 0
            if waiting:
                held = learn(held, kept)
            if seen:
                change = held - start
                cuts = range(0, len(change), SLICE)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(len(cuts)), pa.int32()), pa.array([float(seen)] * len(cuts)),
                    pa.array([change[at: at + SLICE] for at in cuts], pa.list_(pa.float64())),
                ], ["slice", "weight", "change"])

        def mean(group):
            import pyarrow as pa

            weight = group.column("weight").to_numpy()
            values = np.array([np.asarray(v) for v in group.column("change").to_pylist()])
            return pa.table([
                group.column("slice").slice(0, 1), pa.array([(weight @ values / weight.sum()).tolist()], pa.list_(pa.float64()))
            ], ["slice", "change"])

        changes = rows.mapInArrow(run, "slice int, weight double, change array<double>")
        out = changes.groupBy("slice").applyInArrow(mean, "slice int, change array<double>").collect()
        shared.destroy()
        return np.concatenate([np.array(r["change"]) for r in sorted(out, key=lambda r: r["slice"])])

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score`` in [0, 1] and ``prediction``."""
        shared = df.sparkSession.sparkContext.broadcast((self.flat, self.sizes))

        @F.pandas_udf("double")
        def score(x):
            import numpy as np
            import pandas as pd

            flat, sizes = shared.value
            z = forward(_unflat(flat, sizes), np.stack(x.to_numpy()))[-1][:, 0] if len(x) else np.zeros(0)
            return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        scored = df.withColumn("score", score(vector_to_array("features")))
        return scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        """The weights as one row per slice."""
        rows = [(at // SLICE, [float(v) for v in self.flat[at: at + SLICE]]) for at in range(0, len(self.flat), SLICE)]
        spark.createDataFrame(rows, "slice int, flat array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, sizes: Sequence[int]) -> NetModel:
        import numpy as np

        rows = spark.read.parquet(path).orderBy("slice").collect()
        return cls(list(sizes), np.concatenate([np.array(r["flat"]) for r in rows]))
