"""Parity checks, guards, profiles and metrics on tiny frames."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.metrics import classification_metrics, ranking_metrics
from ledgerloom.operators.monitor import wide_preview
from ledgerloom.operators.profile import (
    _summed_correlations,
    column_profile,
    correlation_matrix,
    correlations,
    low_variance,
    profile_report,
    throughput,
)
from ledgerloom.operators.quality import (
    cell_diff,
    column_mismatch_counts,
    column_sets,
    diff_report,
    int_width_audit,
    parity_report,
    range_exclusion,
    require_columns,
    require_non_empty,
    require_positive,
    require_unique,
    same_columns,
    table_fingerprint,
)
from ledgerloom.sources.tables import header, normalize_nulls, scan_csv


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, x double, t string")


def test_fingerprint_ignores_order_but_not_copies(spark):
    rows = [(1, 0.1, "a"), (2, float("nan"), None), (2, float("nan"), None)]
    one = table_fingerprint(_frame(spark, rows)).first()
    assert one == table_fingerprint(_frame(spark, rows[::-1]).repartition(3)).first()
    assert one != table_fingerprint(_frame(spark, rows[:2])).first()
    assert one == table_fingerprint(_frame(spark, [(1, 0.10000000001, "a"), *rows[1:]])).first()


def test_mismatches_by_key_and_by_position(spark):
    left = _frame(spark, [(1, 1.0, "a"), (2, None, "b"), (3, 3.0, None)])
    right = _frame(spark, [(1, 1.005, "a"), (2, 2.0, "b"), (3, 3.0, "c")])
    want = {"x": 1, "t": 1}
    by_key = column_mismatch_counts(left, right, ["k"], atol=0.01)
    assert {r["column"]: r["mismatches"] for r in by_key.collect()} == want
    by_position = column_mismatch_counts(left, right, atol=0.01)
    assert {r["column"]: r["mismatches"] for r in by_position.collect()} == {"k": 0, **want}
    # a repeated key never multiplies rows: its rows are matched by their number in the key
    doubled = column_mismatch_counts(left.union(left), right.union(right), ["k"], atol=0.01)
    assert {(r["column"], r["mismatches"], r["total"]) for r in doubled.collect()} == {("x", 2, 6), ("t", 2, 6)}
    # a lost row shifts no other key
    rows = [(k, float(n), "a") for k in range(4) for n in range(3)]
    lost = column_mismatch_counts(_frame(spark, rows), _frame(spark, rows[1:]), ["k"])
    assert {(r["column"], r["mismatches"], r["total"]) for r in lost.collect()} == {("x", 3, 12), ("t", 1, 12)}


def test_cells_and_rows_that_only_look_alike(spark):
    schema = "k int, x double, s string, t string"
    def one(*rows):
        return spark.createDataFrame(list(rows), schema)
    pairs = [
        ((1, 1.0, "a|b", "c"), (1, 1.0, "a", "b|c")), ((1, 1.0, None, "c"), (1, 1.0, "~", "c")), ((1, 1.0, None, "c"), (1, 1.0, "-", "c")),
        ((1, 1e15, "a", "c"), (1, 2e15, "a", "c")), ((1, float("inf"), "a", "c"), (1, float("-inf"), "a", "c")), ((1, 0.0, "a", "c"), (1, None, "a", "c")),
    ]
    for a, b in pairs:
        assert table_fingerprint(one(a)).first() != table_fingerprint(one(b)).first()
        assert cell_diff(one(a), one(b), "k").count() > 0
    nan, null = (1, float("nan"), "a", "c"), (1, None, "a", "c")
    assert table_fingerprint(one(nan)).first() == table_fingerprint(one(null)).first()
    assert cell_diff(one(nan), one(null), "k").count() == 0
    for a, b, want in ((1.0, float("nan"), 1), (float("nan"), 1.0, 1), (float("nan"), None, 0), (float("inf"), 1.0, 1), (1.0, float("inf"), 1), (float("inf"), float("inf"), 0)):
        got = column_mismatch_counts(one((1, a, "a", "c")), one((1, b, "a", "c")), ["k"], atol=0.01, rtol=0.1)
        assert {r["column"]: r["mismatches"] for r in got.collect()}["x"] == want


def test_a_digest_sum_beyond_64_bits(spark):
    printed = table_fingerprint(spark.range(200)).first()
    assert int(printed["digest_sum"]) > 2**63 and printed["rows"] == 200


def test_order_of_columns_is_part_of_parity(spark):
    df = _frame(spark, [(1, 1.0, "a")])
    assert parity_report(df, df.select("t", "x", "k"), ["k"]).first()["check"] == "order"


def test_missing_numbers_in_both_correlation_forms(spark):
    rows = [(float(i), float(i * i), float("nan") if i == 3 else float(-i)) for i in range(9)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    pairs = [("a", "b"), ("a", "c"), ("b", "c")]
    few = {(r["a"], r["b"]): r["correlation"] for r in correlations(df, pairs).collect()}
    many = {(r["a"], r["b"]): r["correlation"] for r in _summed_correlations(df, pairs).collect()}
    assert few == pytest.approx(many) and few[("a", "c")] == pytest.approx(-1.0)
    assert {r["column"]: r["variance"] is None for r in low_variance(df).collect()} == {"a": False, "b": False, "c": False}


def test_missing_rows_count_in_every_column(spark):
    left = _frame(spark, [(1, 1.0, "a"), (2, 2.0, "b")])
    got = column_mismatch_counts(left, left.where("k = 1"), ["k"])
    assert {(r["column"], r["mismatches"], r["total"]) for r in got.collect()} == {("x", 1, 2), ("t", 1, 2)}


def test_parity_gate_stops_before_the_content(spark):
    left = _frame(spark, [(1, 1.0, "a")])
    right = left.select("k", F.col("x").cast("int").alias("x"), F.lit("z").alias("u"))
    got = {(r["check"], r["column"]) for r in parity_report(left, right, ["k"]).collect()}
    assert got == {("missing", "t"), ("extra", "u"), ("type", "x")}
    assert parity_report(left, left, ["k"]).count() == 0
    assert column_sets(left, right) == {"common": ["k", "x"], "missing": ["t"], "extra": ["u"]}
    assert same_columns(left, left) and not same_columns(left, left.select("x", "k", "t"))


def test_cell_diff_needs_a_unique_key(spark):
    left = _frame(spark, [(1, 1.0, "a"), (1, 2.0, "b")])
    with pytest.raises(ValueError, match="repeat: 1"):
        cell_diff(left, left, "k")


def test_diff_report_counts_copies(spark):
    left = _frame(spark, [(1, 1.0, "a")] * 3 + [(2, None, None)])
    right = _frame(spark, [(1, 1.0, "a"), (3, None, "n")])
    got = {tuple(r) for r in diff_report(left, right, ("CSV", "DB")).collect()}
    assert got == {(1, 1.0, "a", "CSV", 2), (2, None, None, "CSV", 1), (3, None, "n", "DB", 1)}


def test_guards(spark):
    df = _frame(spark, [(i % 12, 1.0, "a") for i in range(24)])
    with pytest.raises(ValueError, match="0, 1, 2, 3, 4, 5, 6, 7, 8, 9$"):
        require_unique(df, "k", "ids")
    with pytest.raises(ValueError, match="no column y, z"):
        require_columns(df, ["k", "y", "z"], "frame")
    with pytest.raises(ValueError, match="no rows in"):
        require_non_empty(df.where("k < 0"), "frame")
    with pytest.raises(ValueError, match="at least 1"):
        require_positive(0, "rows")
    with pytest.raises(ValueError, match="missing range column"):
        range_exclusion(df, "nope", 1)


def test_int_width(spark):
    df = spark.createDataFrame([(2**31, 5, -(2**31) - 1), (1, 6, 0)], "a long, b int, c long")
    assert {r["column"]: (r["min_value"], r["max_value"]) for r in int_width_audit(df).collect()} == {
        "a": (1, 2**31), "c": (-(2**31) - 1, 0),
    }


def test_null_tokens_and_csv(spark, folder):
    df = spark.createDataFrame([(" n/a ", float("nan")), ("XNA", 1.0), ("", None), ("null", 2.0)], "t string, x double")
    assert [tuple(r) for r in normalize_nulls(df).collect()] == [(None, None), ("XNA", 1.0), (None, None), (None, 2.0)]
    path = f"{folder}/t.csv"
    with open(path, "w") as file:
        file.write('id,text,amount\n1,"a, ""b""",1.5\n2,NA,oops\n3,XNA,\n')
    got = scan_csv(spark, path, "id int, text string, amount double")
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 'a, "b"', 1.5), (2, None, None), (3, "XNA", None)]
    assert header(spark, path) == ["id", "text", "amount"]


# ---------------------------------------------------------------- profiles


def test_profile_of_an_empty_table(spark):
    got = column_profile(_frame(spark, [])).collect()
    assert [(r["column"], r["null_count"], r["null_pct"], r["distinct_values"]) for r in got] == [
        ("k", 0, 0.0, 0), ("t", 0, 0.0, 0), ("x", 0, 0.0, 0),
    ]


def test_correlation_forms_agree(spark):
    rng = random.Random(1)
    rows = [tuple(None if rng.random() < 0.2 else 1e6 + rng.gauss(0, 1) for _ in range(4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    pairs = list(itertools.combinations("abcd", 2))
    one = {(r["a"], r["b"]): r["correlation"] for r in correlations(df, pairs).collect()}
    two = {(r["a"], r["b"]): r["correlation"] for r in _summed_correlations(df, pairs).collect()}
    assert set(one) == set(two) == set(pairs)
    for pair in pairs:
        assert one[pair] == pytest.approx(two[pair], abs=1e-9)
    assert correlation_matrix(df.select("a")).count() == 0


def test_profile_report_text(spark):
    text = profile_report(_frame(spark, [(1, 2.0, "a"), (2, 4.0, None)]), "t", "k")
    assert "| t | string | 1 | 50.0 | 1 |" in text and "- x: 1.0" in text


def test_throughput(spark):
    df = spark.createDataFrame([(2, 1.25), (0, 1.0), (5, 0.0)], "rows long, seconds double")
    got = [tuple(r)[2:] for r in throughput(df, "rows", "seconds").collect()]
    assert got == [(1.6, 625.0), (0.0, 0.0), (0.0, 0.0)]


# ---------------------------------------------------------------- metrics


def _brute(rows):
    pos = [s for s, t in rows if t]
    neg = [s for s, t in rows if not t]
    roc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, seen, last = 0.0, 0, 0.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(p >= cut for p in pos)
        total = tp + sum(n >= cut for n in neg)
        ap += (tp / len(pos) - last) * tp / total
        last = tp / len(pos)
    return roc, ap


@pytest.mark.parametrize("levels", [3, 10**6])
def test_ranking_metrics_with_ties(spark, levels):
    rng = random.Random(levels)
    rows = [(rng.randrange(levels) / levels, rng.random() < 0.3) for _ in range(300)]
    df = spark.createDataFrame([(s, int(t)) for s, t in rows], "s double, t int").repartition(4)
    got = ranking_metrics(df, "t", "s").first()
    assert tuple(got) == pytest.approx(_brute(rows), abs=1e-12)


def test_metrics_without_a_class(spark):
    df = spark.createDataFrame([(0.5, 1, 1), (0.2, 1, 0)], "s double, t int, p int")
    got = classification_metrics(df, "t", "p", "s", "x_").first().asDict()
    assert got == {"x_precision": 1.0, "x_recall": 0.5, "x_f1": pytest.approx(2 / 3), "x_roc_auc": 0.0, "x_pr_auc": 1.0}
    none = classification_metrics(df.withColumns({"t": F.lit(0), "p": F.lit(0)}), "t", "p", "s").first()
    assert tuple(none) == (0.0, 0.0, 0.0, 0.0, 0.0)


# ---------------------------------------------------------------- preview


def test_wide_preview(spark):
    models = ("xgboost", "tabpfn_mix", "pyod_autoencoder")
    rows = [(k, s, p, m) for m in models for k, s, p in ((102, 0.2, 0), (101, 0.8, 1), (None, 0.1, 0))]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, score double, prediction int, model_name string")
    got = wide_preview(df, "SK_ID_CURR", models).collect()
    assert [tuple(r) for r in got] == [(101, *(0.8, 1) * 3), (102, *(0.2, 0) * 3)]
    only = wide_preview(df.where("model_name = 'xgboost'"), "SK_ID_CURR", models).first()
    assert only["xgboost_score"] == 0.8 and only["tabpfn_mix_score"] is None


def test_preview_is_capped(spark):
    rows = [(k, 0.5, 1, "xgboost") for k in range(200, 99, -1)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, score double, prediction int, model_name string")
    got = [r["SK_ID_CURR"] for r in wide_preview(df, "SK_ID_CURR", ("xgboost",)).collect()]
    assert got == list(range(100, 150))


# ---------------------------------------------------------------- digest trees


@pytest.mark.parametrize("changed", [0, 1, 7, 4000])
def test_narrowed_cells_equal_all_cells(spark, changed):
    from ledgerloom.operators.digests import narrow, narrowed_cell_diff
    from ledgerloom.operators.quality import cell_diff

    left = spark.range(4000).select(F.col("id").cast("int").alias("k"), (F.col("id") % 7).alias("a"), F.concat(F.lit("t"), "id").alias("b"))
    right = left.select(
        F.col("k").cast("long").alias("k"), F.when(F.col("k") < changed, F.lit(None)).otherwise(F.col("a")).alias("a"), "b"
    ).where("k <> 3999").union(spark.createDataFrame([(9999, 1, "new")], "k long, a long, b string"))
    want = sorted(map(str, cell_diff(left, right, "k").collect()))
    assert sorted(map(str, narrowed_cell_diff(left, right, "k").collect())) == want
    # what is compared follows what differs: at most the leaves of the changed, the lost and the new row
    kept = narrow(left, right, ["k"])[0].count()
    assert kept <= min(4000, 3 * 512 * (changed + 2))
    same = narrow(left, left.repartition(5), ["k"])
    assert same[0].count() == same[1].count() == 0


def test_a_tree_is_its_levels_sum(spark):
    from ledgerloom.operators.digests import differing_leaves, digest_tree, level, tree_bits
    from ledgerloom.operators.quality import table_fingerprint

    df = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("v"))
    tree = digest_tree(df, ["id"], 10)
    top = level(tree, 10).drop("leaf").first()
    whole = table_fingerprint(df).first()
    assert (top["rows"], str(top["digest_sum"]), top["digest_xor"]) == tuple(whole)
    other = digest_tree(df.withColumn("v", F.when(F.col("id") == 77, F.lit("x")).otherwise(F.col("v"))), ["id"], 10)
    assert differing_leaves(tree, other, 10).count() == 1 and differing_leaves(tree, tree, 10).count() == 0
    assert [tree_bits(n) for n in (0, 511, 512, 1 << 60)] == [1, 1, 1, 30]


def test_a_value_against_null_is_a_difference(spark):
    from ledgerloom.operators.quality import content_diff_pct

    left = spark.createDataFrame([(1, 1.0, 1.0), (2, float("nan"), 2.0), (3, 5.0, None)], "k int, a double, b double")
    right = spark.createDataFrame([(1, 1.0, 1.0), (2, 7.0, 2.0 + 1e-9), (3, 5.0, None)], "k int, a double, b double")
    assert [tuple(r)[:2] for r in content_diff_pct(left, right, ["k"]).collect()] == [("a", 1)]
    same = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 2.0), (3, 5.0, None)], "k int, a double, b double")
    assert content_diff_pct(left, same, ["k"]).count() == 0


def test_typed_distinct_counts(spark):
    from ledgerloom.operators.profile import column_profile

    df = spark.sql("""SELECT * FROM VALUES (1, 1.0D, DATE'2020-01-01', TIMESTAMP'2020-01-01 00:00:00.000001', true, 'a', 1.50BD),
     (1, -0.0D, DATE'2020-01-02', TIMESTAMP'2020-01-01 00:00:00.000002', false, 'b', 1.5BD), (2, 0.0D, NULL, NULL, NULL, NULL, NULL),
     (NULL, double('NaN'), DATE'2020-01-01', NULL, true, 'a', 2BD) t(i, d, day, at, flag, s, n)""")
    got = {r["column"]: (r["null_count"], r["distinct_values"]) for r in column_profile(df).collect()}
    assert got == {"i": (1, 2), "d": (1, 2), "day": (1, 2), "at": (2, 2), "flag": (1, 2), "s": (1, 2), "n": (1, 2)}


# ---------------------------------------------------------------- profiles that grow with a table


def test_a_profile_reads_only_new_files(spark, folder):
    from ledgerloom.operators.profile_state import file_states, merged, profile_of, refresh_profile
    from ledgerloom.sources.tables import write_table
    from ledgerloom.sources.versions import VersionedTable

    df = spark.range(3000).select(
        "id", (F.col("id") % 10 / 4.0).alias("x"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("s"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("id") * 1.0).alias("y"), F.lit(None).cast("double").alias("z"),
    )
    table, state = f"{folder}/t", f"{folder}/state"
    write_table(df.where("id < 100").coalesce(1), table)
    assert refresh_profile(spark, table, state) == 1 and refresh_profile(spark, table, state) == 0
    write_table(df.where("id >= 100").repartition(3), table, "append")
    assert refresh_profile(spark, table, state) == 3
    assert VersionedTable(spark, state).read().groupBy("file").count().count() == 4
    got = {r["column"]: r.asDict() for r in profile_of(spark, table, state).collect()}
    assert [got[c]["null_count"] for c in ("id", "x", "s", "y", "z")] == [0, 0, 1000, 1500, 3000] and got["id"]["rows"] == 3000
    want = df.select(F.avg("id").alias("a"), F.stddev_samp("id").alias("b"), F.avg("x").alias("c"), F.stddev_samp("x").alias("d")).first()
    assert [got["id"]["mean"], got["id"]["std"], got["x"]["mean"], got["x"]["std"]] == pytest.approx(list(want))
    assert (got["id"]["low"], got["id"]["high"], got["s"]["text_low"], got["s"]["text_high"]) == (0, 2999, "t0", "t4")
    assert got["z"]["mean"] is None and got["z"]["quantiles"] is None and got["z"]["distinct_values"] == 0
    assert abs(got["id"]["distinct_values"] - 3000) < 150 and got["s"]["distinct_values"] == 5
    assert all(abs(q - p * 3000) < 100 for q, p in zip(got["id"]["quantiles"], (0.25, 0.5, 0.75)))
    # files of a versioned table that are no longer current are passed over
    versions, kept = VersionedTable(spark, f"{folder}/v"), f"{folder}/kept"
    versions.replace(df.where("id < 10"))
    refresh_profile(spark, f"{folder}/v", kept)
    versions.replace(df.where("id < 4"))
    refresh_profile(spark, f"{folder}/v", kept)
    assert {r["rows"] for r in profile_of(spark, f"{folder}/v", kept).collect()} == {4}
    assert merged(file_states(spark.read.parquet(table).limit(0))).count() == 0
