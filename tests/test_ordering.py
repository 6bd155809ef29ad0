"""The distributed paths of ordering operators, forced on small data and checked by brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import (
    dedup_by_key,
    exact_quantiles,
    first_n_per_group,
    page_of,
    rank_within,
    row_ids,
    running_totals,
    sorted_slice,
    total_order,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one row, some groups are null."""
    rng = random.Random(7)
    rows = [("hot", 5)] * 400
    rows += [(rng.choice(["a", "b", None]), rng.choice([None, *range(60)])) for _ in range(800)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, v int").repartition(7)


def _key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def test_row_ids_without_order_are_contiguous(skewed):
    rows, df = skewed
    got = row_ids(df, "id").collect()
    assert sorted(r["id"] for r in got) == list(range(len(rows)))
    assert sorted(((r["g"], r["v"]) for r in got), key=_key) == sorted(rows, key=_key)


def test_row_ids_follow_the_total_order(skewed):
    rows, df = skewed
    got = row_ids(df, "id", total_order(df), start=1).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, len(rows) + 1))
    assert [(r["g"], r["v"]) for r in got] == sorted(rows, key=_key)


def test_copies_of_one_row_use_several_partitions(spark):
    from ledgerloom.operators.ordering import _sorted_partitions

    df = spark.range(4000).select(F.lit(1).alias("x")).repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            r["count"] for r in _sorted_partitions(df, ["x"], False).groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 4000


@pytest.mark.parametrize("small", [0, 10**6])
def test_rank_within_groups(skewed, small):
    rows, df = skewed
    got = rank_within(df, ["g"], [F.col("v").asc_nulls_first()], "r", small_rows=small).collect()
    for group in {g for g, _ in rows}:
        mine = sorted((r["r"], _key((r["v"],))) for r in got if r["g"] == group)
        values = sorted(_key((v,)) for g, v in rows if g == group)
        assert [r for r, _ in mine] == list(range(1, len(values) + 1))
        assert [v for _, v in mine] == values


@pytest.mark.parametrize("small", [0, 10**6])
def test_running_totals(spark, small):
    rng = random.Random(3)
    rows = [(k, rng.randrange(100)) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, n int").repartition(6)
    got = running_totals(df, [F.col("k").desc()], {"cum": "n"}, small_rows=small).collect()
    want, total = {}, 0
    for k, n in sorted(rows, reverse=True):
        total += n
        want[k] = total
    assert {r["k"]: r["cum"] for r in got} == want


@pytest.mark.parametrize("small", [0, 10**6])
@pytest.mark.parametrize("accuracy", [3, 1000])
def test_quantiles_are_exact(spark, small, accuracy):
    rng = np.random.default_rng(5)
    a = rng.normal(size=901)
    b = np.where(rng.random(901) < 0.6, 3.0, rng.integers(0, 50, 901).astype(float))
    rows = [(float(x), None if y == 7 else float(y), None, float("nan")) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double, empty double, nothing double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.919, 1.0]
    got = exact_quantiles(df, ["a", "b", "empty", "nothing"], probabilities, accuracy, small).collect()
    want = {("a", p): np.quantile(a, p) for p in probabilities}
    want |= {("b", p): np.quantile(b[b != 7], p) for p in probabilities}
    assert {(r["column"], r["probability"]) for r in got} == set(want)
    for r in got:
        assert r["value"] == pytest.approx(want[r["column"], r["probability"]], abs=1e-12)


def test_first_n_beyond_the_pruning_bound(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    got = first_n_per_group(df, ["g"], ["id"], 1500).groupBy("g").agg(F.count("id").alias("n"), F.max("id").alias("m"))
    assert {(r["g"], r["n"], r["m"]) for r in got.collect()} == {(0, 1500, 2998), (1, 1500, 2999)}


def test_dedup_keeps_the_first_row_in_total_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "z"), (2, 9, "q"), (None, 1, "n")], "k int, v int, t string")
    assert {tuple(r) for r in dedup_by_key(df, "k").collect()} == {(1, None, "z"), (2, 9, "q"), (None, 1, "n")}


def test_pages_and_slices(spark):
    df = spark.range(25).select(F.col("id").alias("n"), F.lit("x").alias("drop_me")).repartition(4)
    pages = page_of(df.drop("drop_me"), "page", ["n"], 10).groupBy("page").count().collect()
    assert {(r["page"], r["count"]) for r in pages} == {(0, 10), (1, 10), (2, 5)}
    part = sorted_slice(df, ["n"], 5, 8, ["drop_me"])
    assert part.columns == ["n"] and sorted(r["n"] for r in part.collect()) == [5, 6, 7]


def test_a_staged_table_is_numbered_without_a_second_copy(spark, monkeypatch):
    from ledgerloom.operators import ordering

    labels, kept = [], ordering.stage
    monkeypatch.setattr(ordering, "stage", lambda df, label="stage": labels.append(label) or kept(df, label))
    rows = spark.range(600).selectExpr("id % 3 AS g", "id % 7 AS v").repartition(5)
    got = sorted(tuple(r) for r in ordering.rank_within(rows, ["g"], ["v"], "n", small_rows=10).select("g", "n", "v").collect())
    want = []
    for g in range(3):
        want += [(g, n, v) for n, v in enumerate(sorted(i % 7 for i in range(600) if i % 3 == g), 1)]
    assert got == want
    assert "tied" not in labels
