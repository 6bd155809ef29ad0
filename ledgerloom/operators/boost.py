"""Gradient boosting of trees by histograms.

Spark ML's boosting starts a handful of jobs for each tree and sends a row's features as objects through all of them. Here rows
are blocks of binned features, several to a code; a level of a tree is one job, in which tasks sum the slopes of their rows by (node, feature, bin)
and only these sums reach the driver, for the smaller child of each node alone. The margins of a block travel with it from tree to tree.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.forest import BINS, MOST_CELLS, bin_edges, binned
from ledgerloom.sources.staging import stage

#: Joint bins of features that share one code: a code is summed once for all of them.
MOST_JOINT = 1024
#: Rows of a stored block, sums that a task holds at once, trees after which blocks are read again, tasks whose sums the driver adds up itself.
BLOCK, MOST_SUMS, RENEWED, FEW_TASKS = 4096, 1 << 21, 50, 64
#: As in XGBoost: ridge on the leaves, least curvature of a child, least gain of a split.
RIDGE, LEAST_CURVATURE, LEAST_GAIN = 1.0, 1.0, 1e-6


class Codes:
    """Features by the code that holds them: the joint bin of neighbours in the order of their bins, few bins first."""

    def __init__(self, edges: list[list[float]]) -> None:
        import numpy as np

        bins = [len(e) + 1 for e in edges]
        self.groups: list[list[int]] = []
        joint = MOST_JOINT + 1
        for f in sorted(range(len(bins)), key=lambda f: (bins[f], f)):
            joint *= bins[f]
            if joint > MOST_JOINT:
                self.groups.append([])
                joint = bins[f]
            self.groups[-1].append(f)
        self.shapes = [tuple(bins[f] for f in g) for g in self.groups]
        self.code, self.stride, self.bins = np.zeros(len(bins), np.int64), np.ones(len(bins), np.int64), np.array(bins)
        for number, group in enumerate(self.groups):
            for at, f in enumerate(group):
                self.code[f], self.stride[f] = number, np.prod(self.bins[group[at + 1:]], dtype=np.int64)

    def of(self, cells):
        """Codes, a row each, of the rows of a matrix of bins."""
        import numpy as np

        return np.stack([cells[:, g].astype(np.int64) @ self.stride[g] for g in self.groups]).astype(np.uint16)

    def sums(self, x, gradient, curvature, node, wanted):
        """Sums of both derivatives by (one of two, wanted node, feature, bin)."""
        import numpy as np

        number = np.full(max(int(node.max(initial=0)), *wanted) + 1, -1)
        number[wanted] = np.arange(len(wanted))
        at = number[node]
        rows = np.flatnonzero(at >= 0)
        whole = len(rows) == len(at)
        if not whole:
            at, gradient, curvature = at[rows], gradient[rows], curvature[rows]
        out = np.zeros((2, len(wanted), len(self.bins), BINS))
        for codes, group, shape in zip(x, self.groups, self.shapes, strict=True):
            joint = int(np.prod(shape))
            cell = at * joint + (codes if whole else codes[rows])
            for kind, values in enumerate((gradient, curvature)):
                found = np.bincount(cell, values, len(wanted) * joint).reshape(-1, *shape)
                for axis, f in enumerate(group, 1):
                    out[kind, :, f, : self.bins[f]] = found.sum(axis=tuple(a for a in range(1, found.ndim) if a != axis))
        return out

    def leaves(self, tree: dict, x):
        """The node that every row has come to; ``x`` has a row for each code."""
        import numpy as np

        feature = tree["feature"]
        code, stride, bins = self.code[feature], self.stride[feature], self.bins[feature]
        spot, live = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
        while len(live):
            held = spot[live]
            left = tree["left"][held]
            inner = left > 0
            if not inner.all():
                live, held, left = live[inner], held[inner], left[inner]
            spot[live] = left + (x[code[held], live] // stride[held] % bins[held] > tree["cut"][held])
        return spot


def slopes(y, margin):
    """First and second derivatives of the logistic loss."""
    import numpy as np

    p = 1 / (1 + np.exp(-margin))
    return p - y, p * (1 - p)


def best_splits(found):
    """(gain, feature, bin, first child's sums) of each node's best split, from its sums; of equal gains the first feature and bin."""
    import numpy as np

    total = found[:, :, 0].sum(axis=2)
    left = found.cumsum(axis=3)[..., :-1]
    right = total[:, :, None, None] - left

    def worth(g, h):
        return g**2 / (h + RIDGE)

    gain = worth(*left) + worth(*right) - worth(*total)[:, None, None]
    gain[(left[1] < LEAST_CURVATURE) | (right[1] < LEAST_CURVATURE)] = -1.0
    flat = gain.reshape(len(gain), -1)
    best, every = flat.argmax(axis=1), np.arange(len(gain))
    feature, cut = np.divmod(best, BINS - 1)
    return flat[every, best], feature, cut, left[:, every, feature, cut]


def grow(ask, depth: int, rate: float) -> dict:
    """One tree, level by level; ``ask(tree, nodes)`` gives the sums of these nodes over all rows.

    Children of a node are neighbours, ``left`` is 0 for a leaf, and bins up to ``cut`` go left. Of two children only the one of less
    curvature is asked for: the other's sums are what is left of the parent's.
    """
    import numpy as np

    tree = {"feature": np.zeros(1, np.int64), "cut": np.zeros(1, np.int64), "left": np.zeros(1, np.int64)}
    if depth <= 0:
        raise ValueError("a boosted tree needs at least one level")
    level, held = np.array([0]), ask(tree, [0])
    totals = held[:, 0, 0].sum(axis=1)[:, None]
    for at in range(depth):
        gain, feature, cut, first = best_splits(held)
        kept = gain > LEAST_GAIN
        if not kept.any():
            break
        parents, size = level[kept], len(tree["left"])
        tree["feature"][parents], tree["cut"][parents] = feature[kept], cut[kept]
        tree["left"][parents] = size + 2 * np.arange(len(parents))
        tree = {k: np.concatenate([v, np.zeros(2 * len(parents), np.int64)]) for k, v in tree.items()}
        first, both = first[:, kept], held[:, kept, 0].sum(axis=2)
        totals = np.concatenate([totals, np.stack([first, both - first], axis=2).reshape(2, -1)], axis=1)
        level = np.arange(size, size + 2 * len(parents))
        if at + 1 == depth:
            break
        asked = level[::2] + (totals[1, level[::2]] > totals[1, level[1::2]])
        found, whole = ask(tree, asked.tolist()), held[:, kept]
        held = np.empty((2, len(level), *whole.shape[2:]))
        held[:, asked - size], held[:, (asked - size) ^ 1] = found, whole - found
    return tree | {"value": -rate * totals[0] / (totals[1] + RIDGE)}


@dataclass
class BoostModel:
    """Edges of the bins, margin before the first tree, and the trees as arrays."""

    edges: list[list[float]]
    start: float
    trees: list[dict]

    @classmethod
    def fit(cls, df: DataFrame, rounds: int, depth: int, rate: float) -> BoostModel:
        """Fit on rows (features, label of 0 or 1), each round's tree grown on all of them."""
        import numpy as np

        seen = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("share")).first()
        if not seen["n"]:
            raise ValueError("boosting needs at least one row")
        share = min(max(seen["share"], 1e-6), 1 - 1e-6)
        start, edges = float(np.log(share / (1 - share))), bin_edges(df)
        codes = Codes(edges)
        blocks, context = cls._blocks(df, edges, codes), df.sparkSession.sparkContext
        cells = seen["n"] * len(codes.groups)
        tasks = min(max(context.defaultParallelism, -(-cells // MOST_CELLS)), -(-seen["n"] // BLOCK))
        nodes_at_once = max(1, MOST_SUMS // (2 * len(edges) * BINS))
        model, state = cls(edges, start, []), None

        def ask(tree: dict, nodes: list[int]):
            def summed(held: Iterator) -> Iterator:
                total = 0
                for x, y, margin in held:
                    total = total + codes.sums(x, *slopes(y, margin), codes.leaves(tree, x), wanted)
                if not isinstance(total, int):
                    yield total

            parts = []
            for at in range(0, len(nodes), nodes_at_once):
                wanted = nodes[at: at + nodes_at_once]
                found = state.mapPartitions(summed)
                parts.append(found.treeReduce(np.add) if tasks > FEW_TASKS else sum(found.collect()))
            return np.concatenate(parts, axis=1)

        for number in range(rounds):
            older = state
            if number % RENEWED:
                state = cls._with_trees(older, codes, model.trees[-1:])
            else:
                # lineage ends at the stored blocks; their margins are those of all trees so far
                state = cls._with_trees(cls._joined(blocks.repartition(tasks), len(codes.groups), start), codes, model.trees)
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            model.trees.append(grow(ask, depth, rate))
            if older is not None:
                older.unpersist()
        if state is not None:
            state.unpersist()
        return model

    @staticmethod
    def _blocks(df: DataFrame, edges: list[list[float]], codes: Codes) -> DataFrame:
        """Staged (x, y): codes of a block's rows, one code after the other, and their labels."""
        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                values = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
                for at in range(0, len(y), BLOCK):
                    x = codes.of(binned(values[at: at + BLOCK], edges))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x.tobytes()], pa.binary()), pa.array([y[at: at + BLOCK].tobytes()], pa.binary())
                    ], ["x", "y"])

        given = df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"))
        return stage(given.mapInArrow(run, "x binary, y binary"), "boost-blocks")

    @staticmethod
    def _joined(blocks: DataFrame, width: int, start: float):
        """(x, y, margin) of a task's blocks, joined up to ``MOST_CELLS`` codes."""
        def run(rows: Iterator) -> Iterator:
            import numpy as np

            def out(held):
                x = np.concatenate([np.frombuffer(r[0], np.uint16).reshape(width, -1) for r in held], axis=1)
                y = np.frombuffer(b"".join(bytes(r[1]) for r in held), np.uint8)
                return x, y, np.full(len(y), start)

            held, size = [], 0
            for row in rows:
                held.append(row)
                size += len(row[0]) // 2
                if size >= MOST_CELLS:
                    yield out(held)
                    held, size = [], 0
            if held:
                yield out(held)

        return blocks.rdd.mapPartitions(run)

    @staticmethod
    def _with_trees(state, codes: Codes, trees: list[dict]):
        def run(held):
            x, y, margin = held
            for tree in trees:
                margin = margin + tree["value"][codes.leaves(tree, x)]
            return x, y, margin

        return state.map(run)

    def margins(self, values):
        """Margins of the rows of a matrix of features."""
        import numpy as np

        codes = Codes(self.edges)
        x = codes.of(binned(values, self.edges))
        out = np.full(x.shape[1], self.start)
        for tree in self.trees:
            out += tree["value"][codes.leaves(tree, x)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score`` in [0, 1] and ``prediction``."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(x):
            import numpy as np
            import pandas as pd

            margin = shared.value.margins(np.stack(x.to_numpy())) if len(x) else np.zeros(0)
            return pd.Series(1 / (1 + np.exp(-margin)))

        scored = df.withColumn("score", score(vector_to_array("features")))
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Edges and margin as one JSON row, trees as a table."""
        rows = [(n, json.dumps({k: v.tolist() for k, v in t.items()})) for n, t in enumerate(self.trees)]
        spark.createDataFrame([(json.dumps([self.edges, self.start]),)], "state string").write.mode("overwrite").parquet(f"{path}/state")
        spark.createDataFrame(rows, "tree int, state string").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostModel:
        import numpy as np

        edges, start = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        return cls(edges, start, [{k: np.array(v) for k, v in json.loads(r["state"]).items()} for r in rows])
