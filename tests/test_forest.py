"""The random forest of deep trees, against plain loops and on data that needs depth."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerloom.operators import forest
from ledgerloom.operators.forest import ForestModel, binned, grow, route


def _board(spark, n=4000):
    """A board of nine fields beside two columns of noise: no single split tells them apart."""
    side = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(800)) / 100.0 for i in range(4)]
    rows = spark.range(n).select("id", *[s.alias(f"c{i}") for i, s in enumerate(side)])
    label = ((F.floor(F.col("c0") / 2.7) + F.floor(F.col("c1") / 2.7)) % 2).cast("double")
    return rows.select("id", label.alias("label"), array_to_vector(F.array("c0", "c1", "c2", "c3")).alias("features"))


def test_a_tree_fits_rows_that_differ():
    draw = np.random.default_rng(1)
    x = np.unique(draw.integers(0, 32, (500, 3)).astype(np.uint8), axis=0)
    y = (x[:, 0] > x[:, 1]).astype(np.uint8)
    tree = grow(x, y, np.ones(len(x)), 30, 3, draw)
    assert (tree["p"][route(tree, x)] == y).all()
    assert len(np.unique(route(grow(x, y, np.ones(len(x)), 2, 3, draw), x))) <= 4


def test_the_first_split_is_the_purest():
    draw = np.random.default_rng(2)
    x, y = draw.integers(0, 32, (300, 4)).astype(np.uint8), draw.integers(0, 2, 300).astype(np.uint8)
    w = draw.integers(1, 4, 300).astype(float)

    def purity(f, c):
        sides = [x[:, f] <= c, x[:, f] > c]
        return sum(sum(w[s & (y == k)].sum() ** 2 for k in (0, 1)) / w[s].sum() for s in sides if s.any())

    tree = grow(x, y, w, 1, 4, draw)
    best = max(purity(f, c) for f in range(4) for c in range(31))
    assert purity(tree["feature"][0], tree["cut"][0]) == pytest.approx(best)


@pytest.mark.parametrize("node_rows, most_rows", [(16_384, 262_144), (500, 262_144), (4000, 1500)])
def test_deep_trees_learn_whole_at_any_cut_between_spark_and_tasks(spark, folder, monkeypatch, node_rows, most_rows):
    monkeypatch.setattr(forest, "NODE_ROWS", node_rows)
    monkeypatch.setattr(forest, "MOST_ROWS", most_rows)
    data = _board(spark)
    train, held = data.where("id % 4 > 0"), data.where("id % 4 = 0")
    model = ForestModel.fit(train, 12, 20)
    assert isinstance(model, ForestModel) and model.trees.count() == 12
    got = {r["id"]: r for r in model.transform(held).collect()}
    assert len(got) == 1000
    assert sum(r["prediction"] == r["label"] for r in got.values()) > 800
    # every row's score is the mean over all trees, row by row
    kinds = forest._KINDS
    trees = [{k: np.frombuffer(r[k], t) for k, t in kinds.items()} for r in model.trees.collect()]
    x = binned(np.array([r["features"].toArray() for r in got.values()]), model.edges)
    want = np.mean([t["p"][route(t, x)] for t in trees], axis=0)
    assert np.allclose(want, [r["score"] for r in got.values()])
    model.save(spark, f"{folder}/forest")
    again = {r["id"]: r["score"] for r in ForestModel.load(spark, f"{folder}/forest").transform(held).collect()}
    assert again == pytest.approx({k: r["score"] for k, r in got.items()})


def test_first_trees_cut_at_a_depth_are_scored_in_one_pass(spark):
    data = _board(spark)
    model = ForestModel.fit(data.where("id % 4 > 0"), 9, 14)
    shapes = [(9, 14), (4, 6), (9, 3), (1, 30)]
    got = {r["id"]: r for r in model.scores(data.where("id % 4 = 0"), shapes).collect()}
    x = binned(np.array([r["features"].toArray() for r in got.values()]), model.edges)
    trees = {r["tree"]: {k: np.frombuffer(r[k], t) for k, t in forest._KINDS.items()} for r in model.trees.collect()}

    def share(tree, row, levels):
        node = 0
        while levels and tree["left"][node]:
            node = tree["left"][node] + (row[tree["feature"][node]] > tree["cut"][node])
            levels -= 1
        return tree["p"][node]

    for row, r in zip(x, got.values()):
        want = [np.mean([share(trees[t], row, levels) for t in range(n)]) for n, levels in shapes]
        assert np.allclose(want, r["scores"])


def test_a_tree_cut_at_a_depth_is_the_tree_grown_to_it():
    draw = np.random.default_rng(3)
    x, y = draw.integers(0, 32, (600, 5)).astype(np.uint8), draw.integers(0, 2, 600).astype(np.uint8)
    deep, flat = (grow(x, y, np.ones(600), depth, 2, np.random.default_rng(4)) for depth in (25, 4))
    assert (deep["p"][route(deep, x, (4,))[0]] == flat["p"][route(flat, x)]).all()


def test_trials_share_one_forest(spark, monkeypatch):
    """Twelve trials of a search fit once; one that cannot be fitted fails by itself."""
    from ledgerloom.operators import models

    fits = []
    fit = ForestModel.fit.__func__
    monkeypatch.setattr(ForestModel, "fit", classmethod(lambda cls, df, trees, depth, *a, **k: fits.append((trees, depth)) or fit(cls, df, trees, depth, *a, **k)))
    data = _board(spark).selectExpr("id", "cast(label as int) as target", *[f"pmod(xxhash64(id, {i}), 800) / 100.0 as c{i}" for i in range(2)])
    trials = [{"n_estimators": n, "max_depth": d} for n in (3, 5, 8) for d in (2, 6, 9, 12)] + [{"n_estimators": 3, "max_depth": -1}]
    found = models.search(data, "id", "target", "random_forest", trials).collect()
    assert [r["status"] for r in found] == ["COMPLETE"] * 12 + ["FAIL"]
    assert fits == [(8, 12), (3, -1)]
    assert all(0 <= r["validation_pr_auc"] <= 1 for r in found[:12])


@pytest.mark.parametrize("most_cells, again", [(forest.MOST_CELLS, False), (4000, True)])
def test_upper_levels_are_fitted_again_only_for_nodes_over_a_tasks_memory(spark, monkeypatch, most_cells, again):
    """One leaf keeps 270,000 rows: few columns of them fit into a task."""
    monkeypatch.setattr(forest, "MOST_CELLS", most_cells)
    held = []
    upper = forest.upper_trees
    monkeypatch.setattr(forest, "upper_trees", lambda *a: held.append(upper(*a)) or held[-1])
    rows = spark.range(300_000).selectExpr("cast(id % 1000 = 0 as double) as label", "array(cast(id % 1000 as double), cast(id % 7 as double)) as x")
    model = ForestModel.fit(rows.select("label", array_to_vector("x").alias("features")), 2, 7)
    assert isinstance(model, ForestModel) and held[0][1] > 262_144
    assert (len(held) > 1) == again


def _accuracy(model, held):
    got = model.transform(held).collect()
    return sum(r["prediction"] == r["label"] for r in got) / len(got)


def test_many_trees_are_grown_without_sending_rows(spark, monkeypatch):
    """Neither Spark's upper levels nor rows dealt out by (tree, node)."""
    monkeypatch.setattr(forest, "upper_trees", lambda *a: pytest.fail("upper levels by Spark"))
    monkeypatch.setattr(ForestModel, "_grown", lambda *a: pytest.fail("rows sent to nodes"))
    data = _board(spark)
    model = ForestModel.fit(data.where("id % 4 > 0"), 12, 20)
    assert sorted(r["tree"] for r in model.trees.collect()) == list(range(12))
    assert _accuracy(model, data.where("id % 4 = 0")) > 0.85


def test_nodes_over_a_tasks_memory_are_split_by_sums_of_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "GROWN_BYTES", 400 * (2 * 4 + forest.ROW_BYTES))
    monkeypatch.setattr(forest, "KEPT_BYTES", 5000)
    monkeypatch.setattr(forest, "LEAST_KEPT", 5000)
    held = []
    lower = ForestModel._lower
    monkeypatch.setattr(ForestModel, "_lower", staticmethod(lambda *a: held.append(a) or lower(*a)))
    data = _board(spark)
    train = data.where("id % 4 > 0")
    model = ForestModel.fit(train, 9, 20)
    (blocks, tops, units, columns, *_), = held
    assert all(top["level"].max() > 1 for top in tops) and max(rows for *_, rows in units) <= 400
    # each drawn row is in one node, or in a leaf that is whole already
    cells = list(forest._cells([b for b in blocks.toArrow().to_batches()], columns))
    for tree, top in enumerate(tops):
        found = {}
        for block, x, y, _ in cells:
            drawn, _ = forest._drawn(42, tree, block, len(y))
            for node in forest._reached(top, x, drawn):
                found[node] = found.get(node, 0) + 1
        assert {n: r for t, n, r in units if t == tree}.items() <= found.items()
        assert all(top["left"][n] == 0 for n in found)
    assert _accuracy(model, data.where("id % 4 = 0")) > 0.85


def test_the_split_of_sums_is_the_purest():
    draw = np.random.default_rng(5)
    x, y, w = draw.integers(0, 32, (3, 300)), draw.integers(0, 2, 300), draw.integers(1, 4, 300).astype(float)
    chosen = np.array([2, 0])
    sums = np.array([[np.bincount(x[f], w * (y == k), 32) for k in (0, 1)] + [np.bincount(x[f], minlength=32)] for f in chosen])
    feature, cut, share, p0, p1, n0, n1 = forest._best_split(sums, chosen)

    def purity(f, c):
        sides = [x[f] <= c, x[f] > c]
        return sum(sum(w[s & (y == k)].sum() ** 2 for k in (0, 1)) / w[s].sum() for s in sides if s.any())

    assert purity(feature, cut) == pytest.approx(max(purity(f, c) for f in chosen for c in range(31)))
    left = x[feature] <= cut
    assert (n0, n1) == (left.sum(), (~left).sum()) and share == pytest.approx(w @ y / w.sum())
    assert [p0, p1] == pytest.approx([(w * y)[s].sum() / w[s].sum() for s in (left, ~left)])


def test_trees_whose_rows_are_sent_go_some_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(forest, "MOST_READ", 0)
    monkeypatch.setattr(forest, "TREES_SENT", 4)
    monkeypatch.setattr(forest, "NODE_ROWS", 500)
    sent = []
    stage = forest.stage
    monkeypatch.setattr(forest, "stage", lambda df, label: sent.append(label) or stage(df, label))
    data = _board(spark)
    model = ForestModel.fit(data.where("id % 4 > 0"), 9, 20)
    assert sent.count("trees") == 3 and sorted(r["tree"] for r in model.trees.collect()) == list(range(9))
    assert _accuracy(model, data.where("id % 4 = 0")) > 0.8


def test_trees_meet_blocks_in_bundles(spark, monkeypatch):
    monkeypatch.setattr(forest, "BUNDLE", 6000)
    monkeypatch.setattr(forest, "HELD", 20_000)
    data = _board(spark)
    model = ForestModel.fit(data.where("id % 4 > 0"), 10, 14)
    got = model.transform(data.where("id % 4 = 0")).collect()
    x = binned(np.array([r["features"].toArray() for r in got]), model.edges)
    trees = [{k: np.frombuffer(r[k], t) for k, t in forest._KINDS.items()} for r in model.trees.collect()]
    assert np.allclose(np.mean([t["p"][route(t, x)] for t in trees], axis=0), [r["score"] for r in got])


def test_a_label_that_is_missing_is_an_error(spark):
    data = _board(spark, 300).withColumn("label", F.expr("if(id = 7, null, label)"))
    with pytest.raises(ValueError, match="1 labels"):
        ForestModel.fit(data, 12, 20)
