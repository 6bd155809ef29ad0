"""Random forest of deep trees.

Spark ML sends a whole histogram of every node from every task, however few rows the node has, so trees grown to their last row
cost more with each level. Here features are binned, a byte each, and rows lie in blocks. Nodes of more rows than a task should hold are split by sums
over all blocks, a job a level; then each task is given some (tree, node), reads all blocks once, draws the rows of its trees (a bootstrap sample),
keeps those of its nodes and grows the levels below, so no row is shuffled. Few trees, or more values than every task should read, go another way:
Spark ML splits the upper nodes, and each row is sent to the task of its (tree, node), for some trees at a time.
Trees stay a table, a row each; scoring joins blocks of rows with trees, so no task and not the driver holds the forest.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.staging import stage, staging_path, wide_cells

#: Values of a binned feature, as in Spark ML.
BINS = 32
#: Rows a node should have when its task takes it, the most rows and binned values that it may have (a task holds a byte for each
#: value, twice), levels left to Spark alone, rows of a block.
NODE_ROWS, MOST_ROWS, MOST_CELLS, FEW_LEVELS, BLOCK = 16_384, 1 << 20, 1 << 26, 5, 32_768
#: Bytes of drawn rows that a task keeps, and that growing one node may take beside them; such tasks for a core; most values that each of them reads.
KEPT_BYTES, GROWN_BYTES, TASKS, MOST_READ = 96 << 20, 80 << 20, 4, 1 << 31
#: Bytes of drawn rows that are worth a task.
LEAST_KEPT = 1 << 20
#: Bytes that a row takes beside its bins while its node is grown; trees whose rows are sent at a time.
ROW_BYTES, TREES_SENT = 72, 32
#: Nodes that are split at once, and rows that are routed at once, so that both stay in a core's cache; levels after which rows in leaves are left out.
NODES, PART, STRIDE = 1024, 8192, 4
#: Bytes of trees that meet a block of rows at once, and of those that a scoring task holds.
BUNDLE, HELD = 1 << 23, 1 << 26
#: Levels that no tree passes.
DEEPEST = 1 << 30
_TREE = "tree int, feature binary, cut binary, left binary, p binary"
_KINDS = {"feature": "int16", "cut": "uint8", "left": "int32", "p": "float32"}


def bin_edges(df: DataFrame, column: str = "features") -> list[list[float]]:
    """Ascending edges per feature, from one mergeable sketch each; a bin holds the values over one edge up to the next."""
    spots = [i / (BINS - 2) for i in range(BINS - 1)]
    cells = df.select(F.posexplode(vector_to_array(column)).alias("at", "value"))
    rows = cells.groupBy("at").agg(F.percentile_approx("value", spots, 1000).alias("q")).collect()
    return [sorted(set(r["q"])) for r in sorted(rows, key=lambda r: r["at"])]


def binned(values, edges: list[list[float]]):
    """Bins of the rows of a matrix."""
    import numpy as np

    out = np.empty(values.shape, np.uint8)
    for at, cuts in enumerate(edges):
        out[:, at] = np.searchsorted(cuts, values[:, at], side="left")
    return out


def grow(x, y, w, depth: int, tried: int, draw) -> dict:
    """One tree on binned rows by Gini gain, all nodes of a level at once; a node tries ``tried`` random features.

    Children of a node are neighbours, ``left`` is 0 for a leaf, and bins up to ``cut`` go left.
    """
    import numpy as np

    return grow_drawn(np.ascontiguousarray(x.T), np.arange(len(y)), y, w, depth, tried, draw)


def grow_drawn(x, rows, y, w, depth: int, tried: int, draw) -> dict:
    """``grow`` on some of the rows of a matrix that has a line for each feature.

    Rows are kept in the order of their nodes, so a node reads only its stretch of the features that it tries.
    """
    import numpy as np

    levels: list[tuple] = []
    kind, first, starts = y.astype(np.int64) * BINS, 0, np.array([0, len(rows)])
    for level in range(depth + 1):
        count, sizes = len(starts) - 1, np.diff(starts)
        weight, group = w[rows], kind[rows]
        total, ones = (np.add.reduceat(v, starts[:-1]) for v in (weight, np.where(group > 0, weight, 0.0)))
        feature, cut, left = np.zeros(count, np.int16), np.zeros(count, np.uint8), np.zeros(count, np.int32)
        levels.append((feature, cut, left, (ones / total).astype(np.float32)))
        mixed = (ones > 0) & (ones < total)
        if level == depth or not mixed.any():
            break
        nodes = np.flatnonzero(mixed)
        kept = np.repeat(mixed, sizes)
        rows, weight, group, sizes, total, ones = rows[kept], weight[kept], group[kept], sizes[nodes], total[nodes], ones[nodes]
        starts = np.concatenate([[0], sizes.cumsum()])
        chosen = draw.random((len(nodes), len(x))).argpartition(tried - 1, axis=1)[:, :tried]
        # the purity of an unsplit node: a split has to be purer
        best = (ones**2 + (total - ones) ** 2) / total * (1 + 1e-9)
        by, where = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        for a in range(0, len(nodes), NODES):
            part, stretch = slice(a, a + NODES), slice(starts[a], starts[min(a + NODES, len(nodes))])
            _split(x, rows[stretch], weight[stretch], group[stretch], sizes[part], total[part], ones[part], chosen[part], best[part], by[part], where[part])
        split = by >= 0
        if not split.any():
            break
        first += count
        count = int(split.sum())
        feature[nodes[split]], cut[nodes[split]], left[nodes[split]] = by[split], where[split], first + 2 * np.arange(count)
        rows, sizes, by, where = rows[np.repeat(split, sizes)], sizes[split], by[split], where[split]
        at, begins = np.repeat(np.arange(count), sizes), sizes.cumsum() - sizes
        right = x.ravel().take((by * x.shape[1])[at] + rows) > where[at]
        # rows that go left keep their order before those that go right
        before = right.cumsum() - right
        before -= before[begins][at]
        lefts = sizes - np.add.reduceat(right.astype(np.int64), begins)
        place = np.where(right, (begins + lefts)[at] + before, np.arange(len(rows)) - before)
        ordered = np.empty_like(rows)
        ordered[place] = rows
        rows, starts = ordered, np.concatenate([[0], np.stack([lefts, sizes - lefts], axis=1).ravel().cumsum()])
    return {k: np.concatenate([v[i] for v in levels]) for i, k in enumerate(_KINDS)}


def _split(x, rows, weight, group, sizes, total, ones, chosen, best, by, where) -> None:
    """Set purity, feature and bin of neighbouring nodes that have a split purer than ``best``; ``group`` is 0 or ``BINS`` by label."""
    import numpy as np

    count, flat = len(sizes), x.ravel()
    every = np.arange(count)
    at = np.repeat(every, sizes)
    cell, starts = at * (2 * BINS) + group, chosen * x.shape[1]
    whole = np.stack([total - ones, ones], axis=1)[:, :, None]
    for j in range(chosen.shape[1]):
        bins = flat.take(starts[:, j][at] + rows) if count > 1 else x[chosen[0, j]].take(rows)
        left = np.bincount(cell + bins, weight, count * 2 * BINS).reshape(-1, 2, BINS).cumsum(axis=2)[:, :, :-1]
        right = whole - left
        lt, rt = left.sum(axis=1), right.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            pure = (left**2).sum(axis=1) / lt + (right**2).sum(axis=1) / rt
        pure[(lt <= 0) | (rt <= 1e-9 * total[:, None])] = -1.0
        spot = pure.argmax(axis=1)
        better = np.flatnonzero(pure[every, spot] > best)
        best[better], by[better], where[better] = pure[better, spot[better]], chosen[better, j], spot[better]


def route(tree: dict, x, stops: tuple[int, ...] = ()):
    """The leaf of every row; with ``stops``, ascending levels, a list of the nodes that the rows have come to at each of them."""
    import numpy as np

    inner, flat = tree["left"] > 0, x.ravel()
    # a leaf is its own child
    child = np.where(inner, tree["left"], np.arange(len(inner))).repeat(2).astype(np.int32)
    child[1::2] += inner
    feature, cut = tree["feature"].astype(np.int32), tree["cut"]
    found = np.zeros((max(1, len(stops)), len(x)), np.int32)
    for a in range(0, len(x), PART):
        base = np.arange(a, min(a + PART, len(x))) * x.shape[1]
        live, spot, out = np.arange(len(base)), np.zeros(len(base), np.int32), np.zeros(len(base), np.int32)
        level = at = 0
        while True:
            if at < len(stops) and level == stops[at]:
                out[live] = spot
                found[at, a : a + PART] = out
                at += 1
                if at == len(stops):
                    break
            if level % STRIDE == 0:
                going = inner.take(spot)
                if not going.all():
                    out[live] = spot
                    live, spot, base = live[going], spot[going], base[going]
                if not len(live):
                    break
            spot = child.take(2 * spot + (flat.take(base + feature.take(spot)) > cut.take(spot)))
            level += 1
        found[at:, a : a + PART] = out
    return list(found) if stops else found[0]


def upper_trees(spark: SparkSession, model) -> tuple[list[dict], float]:
    """Spark's trees as arrays with the level of each node, and the rows of the largest leaf."""
    import numpy as np

    path = staging_path(spark, "upper")
    model.write().save(path)
    found = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    nodes: dict[int, dict[int, object]] = {}
    for r in found:
        nodes.setdefault(r["treeID"], {})[r["id"]] = r
    trees, largest = [], 0.0
    for number in sorted(nodes):
        held, order, level = nodes[number], [0], [0]
        tree = {k: [] for k in _KINDS}
        for at, depth in ((order[i], level[i]) for i in _while(order)):
            r = held[at]
            inner = r["leftChild"] >= 0
            tree["feature"].append(r["split"]["featureIndex"] if inner else 0)
            tree["cut"].append(math.floor(r["split"]["leftCategoriesOrThreshold"][0]) if inner else 0)
            tree["left"].append(len(order) if inner else 0)
            tree["p"].append(r["impurityStats"][1] / max(sum(r["impurityStats"]), 1e-300))
            if inner:
                order += [r["leftChild"], r["rightChild"]]
                level += [depth + 1, depth + 1]
            else:
                largest = max(largest, r["rawCount"])
        trees.append({k: np.array(v, _KINDS[k]) for k, v in tree.items()} | {"level": np.array(level)})
    return trees, largest


def _while(order: list) -> Iterator[int]:
    """Places of a list that grows."""
    at = 0
    while at < len(order):
        yield at
        at += 1


def _blocks(batches: Iterator, columns: int) -> Iterator[list]:
    """Batches joined into blocks of about ``BLOCK`` rows, as numpy columns; lists become matrices."""
    import numpy as np

    def joined(held):
        return [np.concatenate([h[i] for h in held]) for i in range(columns)]

    held, rows = [], 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        held.append([
            c.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if hasattr(c, "flatten") and c.type.num_fields
            else c.to_numpy(zero_copy_only=False) for c in batch.columns
        ])
        rows += n
        if rows >= BLOCK:
            yield joined(held)
            held, rows = [], 0
    if held:
        yield joined(held)


def _cells(batches, columns: int) -> Iterator[tuple]:
    """(block, bins with a line for each feature, labels, weights) of staged blocks."""
    import numpy as np

    for batch in batches:
        for i in range(batch.num_rows):
            x, y, w = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((1, np.uint8), (2, np.uint8), (3, np.float64)))
            yield batch.column(0)[i].as_py(), x.reshape(columns, -1), y, w


def _drawn(seed: int, tree: int, block: int, n: int) -> tuple:
    """Rows of a block that a tree draws, and how often each row."""
    import numpy as np

    # the Poisson distribution of mean 1 by 65,536 equal shares
    ends = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]) * 65536
    table = np.searchsorted(ends, np.arange(65536) + 0.5).astype(np.uint8)
    times = table.take(np.random.default_rng([seed, tree, block]).integers(0, 65536, n, np.uint16))
    return np.flatnonzero(times), times


def _reached(top: dict, x, rows):
    """Nodes of a tree of few levels that the rows come to; ``x`` has a line for each feature."""
    import numpy as np

    spot = np.zeros(len(rows), np.int64)
    for _ in range(int(top["level"].max())):
        side = x.ravel().take(top["feature"].take(spot).astype(np.int64) * x.shape[1] + rows) > top["cut"].take(spot)
        left = top["left"].take(spot)
        spot = np.where(left > 0, left + side, spot)
    return spot


def _best_split(sums, chosen) -> tuple:
    """(feature or -1, bin, share of label 1 in the node and its children, rows of the children) from sums by (feature, label or rows, bin)."""
    zeros, ones = sums[0, :2].sum(axis=1)
    best, found = (ones**2 + zeros**2) / max(ones + zeros, 1e-300) * (1 + 1e-9), (-1, 0, 0.0, 0.0, 0.0, 0.0)
    share = ones / max(ones + zeros, 1e-300)
    if not 0 < share < 1:
        return -1, 0, share, *found[2:]
    for f, (label0, label1, rows) in zip(chosen, sums):
        for cut in range(BINS - 1):
            l0, l1, r0, r1 = label0[: cut + 1].sum(), label1[: cut + 1].sum(), label0[cut + 1 :].sum(), label1[cut + 1 :].sum()
            if l0 + l1 > 0 and r0 + r1 > 1e-9 * (zeros + ones):
                pure = (l0**2 + l1**2) / (l0 + l1) + (r0**2 + r1**2) / (r0 + r1)
                if pure > best:
                    best, found = pure, (int(f), cut, l1 / (l0 + l1), r1 / (r0 + r1), rows[: cut + 1].sum(), rows[cut + 1 :].sum())
    return found[0], found[1], share, *found[2:]


def _joined(grown: DataFrame, tops: list[tuple[int, dict]]) -> DataFrame:
    """Whole trees from upper trees and the trees grown below their leaves; a tree of no such leaf is its upper tree."""
    spark = grown.sparkSession
    upper = [(tree, -1, *[top[k].tobytes() for k in _KINDS]) for tree, top in tops]
    kinds = _TREE.replace("tree int", "tree int, node int")

    def whole(group):
        import numpy as np
        import pyarrow as pa

        parts, lower = None, []
        for at, *cells in zip(group.column("node").to_pylist(), *[group.column(k).to_pylist() for k in _KINDS]):
            tree = {k: np.frombuffer(c, t) for (k, t), c in zip(_KINDS.items(), cells)}
            if at < 0:
                parts = {k: [v.copy()] for k, v in tree.items()}
            else:
                lower.append((at, tree))
        size = len(parts["left"][0])
        for at, tree in sorted(lower, key=lambda v: v[0]):
            # the root takes the place of the upper tree's leaf, the others follow the nodes so far
            tree["left"] = np.where(tree["left"] > 0, tree["left"] + size - 1, 0).astype(np.int32)
            for k, v in tree.items():
                parts[k][0][at] = v[0]
                parts[k].append(v[1:])
            size += len(tree["left"]) - 1
        return pa.table(
            [group.column("tree").slice(0, 1), *[pa.array([np.concatenate(v).tobytes()], pa.binary()) for v in parts.values()]], ["tree", *parts]
        )

    return grown.unionAll(spark.createDataFrame(upper, kinds)).groupBy("tree").applyInArrow(whole, _TREE)


@dataclass
class ForestModel:
    """Edges of the bins, number of trees, and the trees, a row each."""

    edges: list[list[float]]
    count: int
    trees: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, trees: int, depth: int, seed: int = 42, weight: str | None = None):
        """Fit on rows (features, label of 0 or 1). Few levels are Spark's own forest."""
        spark = df.sparkSession
        n, bad = df.agg(F.count(F.lit(1)), F.count_if(~F.coalesce(F.col("label").isin(0, 1), F.lit(False)))).first()
        levels = max(1, math.ceil(math.log2(max(n, 1) / NODE_ROWS)))
        weights = {"weightCol": weight} if weight else {}
        if depth <= max(FEW_LEVELS, levels):
            return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, **weights).fit(df)
        if bad:
            raise ValueError(f"{bad} labels are not 0 or 1")
        edges = bin_edges(df)
        blocks = cls._binned(df, edges, weight)
        tried = max(1, math.ceil(math.sqrt(len(edges))))
        # every task reads all values, and trees are shared out
        if 0 < n * len(edges) <= MOST_READ and 2 * trees >= spark.sparkContext.defaultParallelism:
            tops, units = cls._upper(blocks, n, len(edges), trees, depth, tried, seed)
            return cls(edges, trees, cls._lower(blocks, tops, units, len(edges), depth, tried, seed))
        rows = stage(cls._rows(blocks, len(edges)), "binned-rows")
        vectors = rows.withColumn("features", array_to_vector(F.col("x").cast("array<double>")))
        while True:
            upper = RandomForestClassifier(
                featuresCol="features", labelCol="label", numTrees=trees, maxDepth=levels, seed=seed, maxBins=BINS, **weights
            ).fit(vectors)
            tops, largest = upper_trees(spark, upper)
            if largest <= min(MOST_ROWS, MOST_CELLS // len(edges)) or levels >= depth:
                break
            levels = min(depth, levels + 3)
        return cls(edges, trees, cls._grown(rows, tops, depth, tried, seed))

    @staticmethod
    def _binned(df: DataFrame, edges: list[list[float]], weight: str | None) -> DataFrame:
        """Blocks of rows: bins, a line for each feature, labels and weights."""
        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            for number, (x, y, w) in enumerate(_blocks(batches, 3)):
                cells = (binned(x, edges).T, y.astype(np.uint8), w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | number], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]], ["block", "x", "y", "w"]
                )

        weighted = F.col(weight) if weight else F.lit(1.0)
        given = df.select(vector_to_array("features").alias("x"), F.col("label").cast("double"), weighted.cast("double").alias("weight"))
        return stage(given.mapInArrow(run, "block bigint, x binary, y binary, w binary"), "binned")

    @staticmethod
    def _rows(blocks: DataFrame, columns: int) -> DataFrame:
        """The rows of blocks: (x, label, weight)."""
        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                for _, x, y, w in zip(*(c.to_pylist() for c in batch.columns)):
                    label = np.frombuffer(y, np.uint8)
                    ends = np.arange(len(label) + 1, dtype=np.int32) * columns
                    cells = np.frombuffer(x, np.int8).reshape(columns, -1).T.ravel()
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells))
                    yield pa.RecordBatch.from_arrays([lists, pa.array(label.astype(float)), pa.array(np.frombuffer(w))], ["x", "label", "weight"])

        return blocks.mapInArrow(run, "x array<tinyint>, label double, weight double")

    @staticmethod
    def _upper(blocks: DataFrame, n: int, columns: int, trees: int, depth: int, tried: int, seed: int) -> tuple[list[dict], list[tuple[int, int, int]]]:
        """Trees down to nodes that a task can grow, and these nodes as (tree, node, rows); a level is one job over all blocks."""
        import numpy as np

        spark = blocks.sparkSession
        most = GROWN_BYTES // (2 * columns + ROW_BYTES)
        nodes = [{k: [0] for k in (*_KINDS, "level")} for _ in range(trees)]
        open_, units = [(tree, 0, math.ceil(n * 0.64)) for tree in range(trees)], []
        while True:
            large = [(tree, node) for tree, node, rows in open_ if rows > most and nodes[tree]["level"][node] < depth]
            units += [(tree, node, rows) for tree, node, rows in open_ if rows <= most or nodes[tree]["level"][node] >= depth]
            tops = [{k: np.array(t[k], _KINDS.get(k, "int64")) for k in t} for t in nodes]
            if not large:
                return tops, units
            asked: dict[int, list] = {}
            for tree, node in large:
                chosen = np.random.default_rng([seed, tree, node]).permutation(columns)[:tried]
                asked.setdefault(tree, []).append((node, chosen))
            shared = spark.sparkContext.broadcast((tops, asked))

            def sums(batches: Iterator) -> Iterator:
                import numpy as np
                import pyarrow as pa

                tops, asked = shared.value
                found = {tree: np.zeros((len(wanted), tried, 3, BINS)) for tree, wanted in asked.items()}
                for block, x, y, w in _cells(batches, columns):
                    for tree, wanted in asked.items():
                        drawn, times = _drawn(seed, tree, block, len(y))
                        spot = _reached(tops[tree], x, drawn)
                        for at, (node, chosen) in enumerate(wanted):
                            rows = drawn[spot == node]
                            label, weight = y[rows].astype(np.int64) * BINS, w[rows] * times[rows]
                            for j, f in enumerate(chosen):
                                bins = x[f].take(rows)
                                found[tree][at, j, :2] += np.bincount(label + bins, weight, 2 * BINS).reshape(2, BINS)
                                found[tree][at, j, 2] += np.bincount(bins, minlength=BINS)
                for tree, cells in found.items():
                    yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([cells.tobytes()], pa.binary())], ["tree", "cells"])

            def best(group):
                import numpy as np
                import pyarrow as pa

                tree = group.column("tree")[0].as_py()
                cells = sum(np.frombuffer(c.as_buffer()) for c in group.column("cells")).reshape(-1, tried, 3, BINS)
                out = []
                for (node, chosen), sums in zip(shared.value[1][tree], cells):
                    out.append((tree, node, *_best_split(sums, chosen)))
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 5]
                return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["tree", "node", "feature", "cut", "p", "p0", "p1", "n0", "n1"])

            schema = "tree int, node int, feature int, cut int, p double, p0 double, p1 double, n0 double, n1 double"
            with wide_cells(spark):
                splits = blocks.mapInArrow(sums, "tree int, cells binary").groupBy("tree").applyInArrow(best, schema).collect()
            shared.destroy()
            open_ = []
            for r in sorted(splits, key=lambda r: (r["tree"], r["node"])):
                t, node = nodes[r["tree"]], r["node"]
                t["p"][node] = r["p"]
                if r["feature"] < 0:
                    continue
                left = len(t["left"])
                t["feature"][node], t["cut"][node], t["left"][node] = r["feature"], r["cut"], left
                for p, rows in ((r["p0"], r["n0"]), (r["p1"], r["n1"])):
                    if 0 < p < 1:
                        open_.append((r["tree"], len(t["left"]), int(rows)))
                    for k, v in (("feature", 0), ("cut", 0), ("left", 0), ("p", p), ("level", t["level"][node] + 1)):
                        t[k].append(v)

    @staticmethod
    def _lower(blocks: DataFrame, tops: list[dict], units: list[tuple[int, int, int]], columns: int, depth: int, tried: int, seed: int) -> DataFrame:
        """Whole trees: each task reads all blocks, keeps the rows of its nodes and grows these."""
        spark = blocks.sparkSession
        row = columns + 9
        kept = min(KEPT_BYTES, max(LEAST_KEPT, sum(rows for *_, rows in units) * row // (TASKS * spark.sparkContext.defaultParallelism)))
        tasks: list[dict[int, list[int]]] = []
        filled = math.inf
        for tree, node, rows in units:
            if filled + rows * row > kept:
                tasks.append({})
                filled = 0
            tasks[-1].setdefault(tree, []).append(node)
            filled += rows * row
        shared = spark.sparkContext.broadcast((tops, tasks))

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            tops, tasks = shared.value
            held: dict[tuple[int, int], list] = {}
            task = None
            for batch in batches:
                task = batch.column(4)[0].as_py()
                for block, x, y, w in _cells([batch], columns):
                    for tree, nodes in tasks[task].items():
                        drawn, times = _drawn(seed, tree, block, len(y))
                        spot = _reached(tops[tree], x, drawn)
                        for node in nodes:
                            rows = drawn[spot == node]
                            held.setdefault((tree, node), []).append((x.take(rows, axis=1), y[rows], w[rows] * times[rows]))
            if task is None:
                return
            for tree, nodes in tasks[task].items():
                for node in nodes:
                    x, y, w = (np.concatenate(v, axis=-1) for v in zip(*held.pop((tree, node))))
                    left = depth - int(tops[tree]["level"][node])
                    if len(y):
                        grown = grow_drawn(x, np.arange(len(y)), y, w, left, tried, np.random.default_rng([seed, tree, node, 1]))
                    else:  # a tree that drew no row
                        grown = {k: np.zeros(1, t) for k, t in _KINDS.items()}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree], pa.int32()), pa.array([node], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in grown.values()]],
                        ["tree", "node", *grown],
                    )

        numbers = spark.range(0, len(tasks), 1, max(1, len(tasks))).hint("shuffle_replicate_nl")
        grown = blocks.coalesce(1).crossJoin(numbers).mapInArrow(run, _TREE.replace("tree int", "tree int, node int"))
        with wide_cells(spark):
            trees = stage(_joined(grown, list(enumerate(tops))), "trees")
        shared.destroy()
        return trees

    @staticmethod
    def _grown(rows: DataFrame, tops: list[dict], depth: int, tried: int, seed: int) -> DataFrame:
        spark = rows.sparkSession
        shared = spark.sparkContext.broadcast(tops)

        def sent(batches: Iterator, first: int) -> Iterator:
            import numpy as np
            import pyarrow as pa
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            for block, (x, y, w) in enumerate(_blocks(batches, 3)):
                x, y = x.view(np.uint8), y.astype(np.uint8)
                for number in range(first, min(first + TREES_SENT, len(shared.value))):
                    top = shared.value[number]
                    times = np.random.default_rng([seed, part, block, number]).poisson(1.0, len(y))
                    drawn = np.flatnonzero(times)
                    node = route(top, x[drawn])
                    order = np.argsort(node, kind="stable")
                    drawn, node = drawn[order], node[order]
                    begins = np.flatnonzero(np.diff(node, prepend=-1))
                    cuts = [drawn[a:b] for a, b in zip(begins, [*begins[1:], len(node)])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(cuts), number, np.int32)), pa.array(node[begins].astype(np.int32)),
                        pa.array([x[c].tobytes() for c in cuts], pa.binary()), pa.array([y[c].tobytes() for c in cuts], pa.binary()),
                        pa.array([(w[c] * times[c]).tobytes() for c in cuts], pa.binary()),
                    ], ["tree", "node", "x", "y", "w"])

        def below(group):
            import numpy as np
            import pyarrow as pa

            def whole(name, kind):
                return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)

            number, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
            y = whole("y", np.uint8)
            left = depth - int(shared.value[number]["level"][node])
            tree = grow(whole("x", np.uint8).reshape(len(y), -1), y, whole("w", np.float64), left, tried, np.random.default_rng([seed, number, node]))
            return pa.table(
                [pa.array([number], pa.int32()), pa.array([node], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in tree.values()]],
                ["tree", "node", *tree],
            )

        parts = []
        # a part's rows are removed when its trees are written, so the disk holds those of few trees
        for first in range(0, len(tops), TREES_SENT):
            drawn = rows.mapInArrow(partial(sent, first=first), "tree int, node int, x binary, y binary, w binary")
            lower = drawn.groupBy("tree", "node").applyInArrow(below, _TREE.replace("tree int", "tree int, node int"))
            parts.append(stage(_joined(lower, list(enumerate(tops))[first : first + TREES_SENT]), "trees"))
        shared.destroy()
        return reduce(DataFrame.unionAll, parts)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score``, the mean of the trees' shares of label 1, and ``prediction``."""
        scored = self.scores(df, [(self.count, None)]).withColumn("score", F.col("scores")[0]).drop("scores")
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

    def scores(self, df: DataFrame, shapes: Sequence[tuple[int, int | None]]) -> DataFrame:
        """Add ``scores``, a score for each of ``shapes`` (first trees, levels; None: all levels), by one pass over rows and trees.

        A tree's draws do not depend on the levels below, so its upper levels are the tree that is grown to that depth.
        """
        rows = stage(df.withColumn("__row", F.monotonically_increasing_id()), "forest-rows")
        edges, shapes = self.edges, [(n, DEEPEST if levels is None else levels) for n, levels in shapes]
        stops = tuple(sorted({levels for _, levels in shapes}))
        counts = [n for n, _ in shapes]

        def packed(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for ids, x in _blocks(batches, 2):
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(ids[0])], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([binned(x, edges).tobytes()], pa.binary()),
                ], ["block", "ids", "x"])

        def bundled(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            def out():
                sizes = np.array([len(t[1]) for t in held], np.int32)
                return pa.RecordBatch.from_arrays([
                    pa.array([np.array([t[0] for t in held], np.int32).tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary()),
                    *[pa.array([b"".join(t[1 + j] for t in held)], pa.binary()) for j in range(len(_KINDS))],
                ], ["trees", "sizes", *_KINDS])

            held, taken = [], 0
            for batch in batches:
                for tree in zip(*(c.to_pylist() for c in batch.columns)):
                    held.append(tree)
                    taken += sum(map(len, tree[1:]))
                    if taken >= BUNDLE:
                        yield out()
                        held, taken = [], 0
            if held:
                yield out()

        def votes(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            def out():
                return pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), pa.array([ids], pa.binary()), pa.array([total.tobytes()], pa.binary()),
                ], ["block", "ids", "total"])

            block = ids = x = total = None
            for batch in batches:
                for i in range(batch.num_rows):
                    if batch.column(0)[i].as_py() != block:
                        if block is not None:
                            yield out()
                        block, ids = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                        x = np.frombuffer(batch.column(2)[i].as_py(), np.uint8).reshape(len(ids) // 8, -1)
                        total = np.zeros((len(shapes), len(x)))
                    numbers, sizes = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in (3, 4))
                    nodes = sizes // np.dtype(_KINDS["feature"]).itemsize
                    bundle = {k: np.frombuffer(batch.column(5 + j)[i].as_buffer(), t) for j, (k, t) in enumerate(_KINDS.items())}
                    for number, begin, size in zip(numbers, nodes.cumsum() - nodes, nodes):
                        tree = {k: v[begin : begin + size] for k, v in bundle.items()}
                        shares = {at: tree["p"][spots] for at, spots in zip(stops, route(tree, x, stops))}
                        for at, (n, levels) in enumerate(shapes):
                            if number < n:
                                total[at] += shares[levels]
            if block is not None:
                yield out()

        def means(group):
            import numpy as np
            import pyarrow as pa

            ids = np.frombuffer(group.column("ids")[0].as_py(), np.int64)
            total = sum(np.frombuffer(v, np.float64) for v in group.column("total").to_pylist()).reshape(len(counts), len(ids))
            mean = np.clip(total.T / np.array(counts), 0.0, 1.0)
            ends = np.arange(len(ids) + 1, dtype=np.int32) * len(counts)
            return pa.table([pa.array(ids), pa.ListArray.from_arrays(pa.array(ends), pa.array(mean.ravel()))], ["__row", "scores"])

        given = rows.select("__row", vector_to_array("features").alias("x"))
        blocks = stage(given.mapInArrow(packed, "block bigint, ids binary, x binary"), "forest-blocks")
        # a task holds its trees and meets its blocks one after another: as many parts of the forest as keep the tasks busy and fit into one
        size = self.trees.agg(F.sum(sum(F.length(k) for k in _KINDS))).first()[0] or 0
        parts = max(math.ceil(2 * rows.sparkSession.sparkContext.defaultParallelism / max(1, blocks.rdd.getNumPartitions())), math.ceil(size / HELD))
        kinds = ", ".join(f"{k} binary" for k in ("trees", "sizes", *_KINDS))
        bundles = self.trees.select("tree", *_KINDS).mapInArrow(bundled, kinds).repartition(min(parts, self.count))
        pairs = blocks.crossJoin(bundles.hint("shuffle_replicate_nl"))
        summed = pairs.mapInArrow(votes, "block bigint, ids binary, total binary").groupBy("block")
        with wide_cells(rows.sparkSession):
            found = stage(summed.applyInArrow(means, "__row bigint, scores array<double>"), "forest-scores")
        return rows.join(found, "__row").drop("__row")

    def save(self, spark: SparkSession, path: str) -> None:
        """Edges as one JSON row, trees as a table."""
        spark.createDataFrame([(json.dumps([self.edges, self.count]),)], "state string").write.mode("overwrite").parquet(f"{path}/state")
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        edges, count = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        return cls(edges, count, spark.read.parquet(f"{path}/trees"))
