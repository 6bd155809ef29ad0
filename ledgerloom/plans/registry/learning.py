"""Preparation, metrics, training and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import min_max_scaled
from ledgerloom.operators.metrics import confusion_metrics, one_row, ranking_metrics
from ledgerloom.operators.mlprep import (
    Preprocessor,
    align_columns,
    category_counts,
    category_indices,
    frequent_categories,
    medians,
    modes,
    scaling,
    split_features_target,
    stratified_split,
)
from ledgerloom.operators.models import (
    DEFAULTS,
    Bundle,
    parameter_grid,
    random_parameters,
    rank_models,
    scoring_benchmark,
    search,
    train_model,
)
from ledgerloom.operators.ordering import exact_quantiles
from ledgerloom.plans.registry.base import APPLICATIONS_SQL, fixed, fixed_sql, query, table
from ledgerloom.plans.registry.features import wide_features
from ledgerloom.plans.registry.incremental import KEY, MODELS, PREDICTIONS_SQL, predictions
from ledgerloom.plans.registry.monitoring import CONFUSION_SQL, ranking_sql
from ledgerloom.sources.staging import staging_path, stage

# Entities with missing numbers and missing text. The nation is text here.
_BASE_SQL = """(SELECT c_custkey AS "SK_ID_CURR", (c_acctbal < 0)::INTEGER AS "TARGET", c_custkey * 10 AS number,
 CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance, CASE WHEN c_nationkey <> 3 THEN c_mktsegment END
 AS segment, 'N' || c_nationkey AS nation FROM customer)"""


def _base(spark, root):
    c = table(spark, root, "customer")
    return c.select(
        F.col("c_custkey").alias(KEY), (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        (F.col("c_custkey") * 10).alias("number"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("segment"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation"),
    )


_SPLIT_SQL = f"""(SELECT *, CASE WHEN r <= t THEN 'test' WHEN r <= t + ceil(round((n - t) * 0.25::DOUBLE, 9)) THEN 'validation'
 ELSE 'train' END AS split FROM (SELECT *, ceil(n * 0.2::DOUBLE) AS t FROM (SELECT *, count(*) OVER (PARTITION BY "TARGET") AS n,
 row_number() OVER (PARTITION BY "TARGET" ORDER BY md5("SK_ID_CURR"::VARCHAR || '|42'), "SK_ID_CURR") AS r FROM {_BASE_SQL})))"""
_COLUMNS = '"SK_ID_CURR", "TARGET", number, balance, segment, nation'


@query("stratified_split", f"SELECT {_COLUMNS}, split FROM {_SPLIT_SQL}")
def _split(spark, root):
    return stratified_split(_base(spark, root), [KEY], "TARGET")


@query("split_features_target", f"""SELECT number, balance, segment, nation FROM {_BASE_SQL}""")
def _features_target(spark, root):
    features, _ = split_features_target(_base(spark, root), "TARGET", ["_DW_ID", KEY])
    return features


# nation is dropped, absent is added as 0, nulls of balance stay
@query("align_columns", f"""SELECT "SK_ID_CURR", balance, 0 AS absent, number FROM {_BASE_SQL}""")
def _align(spark, root):
    return align_columns(_base(spark, root), ["balance", "absent", "number"], [KEY])


_NUMBERS = ("number", "balance")


@query(
    "impute_median",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {fixed_sql(f'quantile_cont({c}, 0.5)', 3)} AS value FROM {_BASE_SQL}""" for c in _NUMBERS
    ),
)
def _median(spark, root):
    base = _base(spark, root).withColumn("empty", F.lit(None).cast("double"))
    return medians(base, [*_NUMBERS, "empty"]).withColumn("value", fixed(F.col("value"), 3))


_COUNTS_SQL = f"""(SELECT 'segment' AS "column", segment AS value, count(*) AS n FROM {_BASE_SQL} WHERE segment IS NOT NULL
 GROUP BY 2 UNION ALL SELECT 'nation', nation, count(*) FROM {_BASE_SQL} GROUP BY 2)"""


@query(
    "impute_mode",
    f"""SELECT "column", value FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r
 FROM {_COUNTS_SQL}) WHERE r = 1""",
)
def _mode(spark, root):
    return modes(category_counts(_base(spark, root), ["segment", "nation"]))


@query(
    "standard_scale",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {fixed_sql(f'avg({e})', 3)} AS mean, {fixed_sql(f'coalesce(nullif(stddev_pop({e}), 0), 1)', 3)}
 AS deviation FROM {_BASE_SQL}"""
        for c, e in (
            ("number", "number"),
            ("balance", f"coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM {_BASE_SQL}))"), ("one", "1"),
        )
    ),
)
def _scale(spark, root):
    base = _base(spark, root).withColumn("one", F.lit(1))
    fills = {r["column"]: r["value"] for r in medians(base, [*_NUMBERS, "one"]).collect()}
    found = [(c, float(m), float(s)) for c, (m, s) in scaling(base, fills).items()]
    rows = spark.createDataFrame(found, "column string, mean double, deviation double")
    return rows.withColumns({c: fixed(F.col(c), 3) for c in ("mean", "deviation")})


# nations with fewer customers than a 25th share one slot
_RARE = f"(SELECT count(*) / 25 FROM {_BASE_SQL})"


def _slots_sql(counts: str, minimum: str) -> str:
    return f"""(SELECT "column", value, category, dense_rank() OVER (PARTITION BY "column" ORDER BY
 category = '__infrequent__', category) - 1 AS slot FROM (SELECT *, CASE WHEN n >= {minimum} THEN value ELSE '__infrequent__' END
 AS category FROM {counts}))"""


@query("one_hot_min_frequency", f"SELECT * FROM {_slots_sql(_COUNTS_SQL, _RARE)}")
def _one_hot(spark, root):
    base = _base(spark, root)
    share = -(-base.count() // 25)
    return category_indices(frequent_categories(category_counts(base, ["segment", "nation"]), share))


_TRAIN = f"(SELECT * FROM {_SPLIT_SQL} WHERE split = 'train')"
_FILLED = f"""(SELECT "SK_ID_CURR", split, number::DOUBLE AS number, coalesce(balance, (SELECT quantile_cont(balance, 0.5)
 FROM {_TRAIN})) AS balance, coalesce(segment, (SELECT segment FROM {_TRAIN} WHERE segment IS NOT NULL GROUP BY 1
 ORDER BY count(*) DESC, segment LIMIT 1)) AS segment, nation FROM {_SPLIT_SQL})"""
_FILLED_COUNTS = f"""(SELECT 'segment' AS "column", segment AS value, count(*) AS n FROM {_FILLED} WHERE split = 'train' GROUP BY 2
 UNION ALL SELECT 'nation', nation, count(*) FROM {_FILLED} WHERE split = 'train' GROUP BY 2)"""
_FILLED_SLOTS = _slots_sql(_FILLED_COUNTS, "30")


@query(
    "preprocess_matrix",
    f"""SELECT "SK_ID_CURR", split, {fixed_sql('(number - s.m1) / s.d1')} AS number, {fixed_sql('(balance - s.m2) / s.d2')} AS balance,
 g.slot AS segment_slot, h.slot AS nation_slot, ((g.slot IS NOT NULL)::INTEGER + (h.slot IS NOT NULL)::INTEGER)::DOUBLE AS ones
 FROM {_FILLED} f LEFT JOIN {_FILLED_SLOTS} g ON g."column" = 'segment' AND g.value = f.segment
 LEFT JOIN {_FILLED_SLOTS} h ON h."column" = 'nation' AND h.value = f.nation,
 (SELECT avg(number) AS m1, stddev_pop(number) AS d1, avg(balance) AS m2, stddev_pop(balance) AS d2 FROM {_FILLED}
 WHERE split = 'train') s""",
)
def _matrix(spark, root):
    """Learned on the training rows, applied to all rows, read back from the feature vector."""
    rows = stage(stratified_split(_base(spark, root), [KEY], "TARGET"), "split")
    train = rows.where(F.col("split") == "train").drop(KEY, "TARGET", "split")
    prepared = Preprocessor.fit(train, min_frequency=30)
    cells = vector_to_array("features")
    hot = F.aggregate(F.slice(cells, 3, prepared.size() - 2), F.lit(0.0), lambda s, v: s + v)
    vectors = prepared.transform(rows, [KEY, "split"]).select(
        KEY, "split", fixed(cells[0]).alias("number"), fixed(cells[1]).alias("balance"), hot.alias("ones")
    )
    slots = prepared.slots(rows).select(
        KEY, F.col("segment__slot").alias("segment_slot"), F.col("nation__slot").alias("nation_slot")
    )
    return vectors.join(slots, KEY)


@query(
    "anomaly_scale",
    """SELECT o_orderkey, least(greatest((o_totalprice - lo) / (hi - lo), 0.0), 1.0)::DOUBLE AS score,
 (o_totalprice > cut)::INTEGER AS prediction FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
 quantile_cont(o_totalprice, 0.919) AS cut FROM orders WHERE o_orderstatus = 'F')""",
)
def _anomaly(spark, root):
    """Scores of all rows on the range and the quantile of the training rows."""
    o = table(spark, root, "orders")
    train = o.where(F.col("o_orderstatus") == "F")
    bounds = train.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")).first()
    cut = exact_quantiles(train, ["o_totalprice"], [1 - 0.081]).first()["value"]
    score = min_max_scaled(F.col("o_totalprice"), F.lit(bounds["lo"]), F.lit(bounds["hi"]))
    return o.select("o_orderkey", score.alias("score"), (F.col("o_totalprice") > cut).cast("int").alias("prediction"))


# ---------------------------------------------------------------- metrics


def _scored_sql(model: str) -> str:
    return f"""(SELECT p.score, p.prediction, l.quality AS t FROM {PREDICTIONS_SQL} p JOIN labels l ON l.doc_id = p."SK_ID_CURR"
 WHERE p.model_name = '{model}')"""


def _scored(spark, root, model):
    labels = table(spark, root, "labels").select(F.col("doc_id").alias(KEY), "quality")
    return predictions(spark, root).where(F.col("model_name") == model).join(labels, KEY)


@query(
    "classification_metrics",
    f"""SELECT {fixed_sql('tp / (tp + fp)::DOUBLE')} AS precision, {fixed_sql('tp / (tp + fn)::DOUBLE')} AS recall,
 {fixed_sql('2 * tp / (2 * tp + fp + fn)::DOUBLE')} AS f1 FROM {CONFUSION_SQL.format(source=_scored_sql('xgboost'))}""",
)
def _confusion(spark, root):
    found = confusion_metrics(_scored(spark, root, "xgboost"), "quality", "prediction")
    return found.select(*[fixed(F.col(c)).alias(c) for c in found.columns])


@query("roc_auc", f"SELECT {fixed_sql('roc_auc', 8)} AS roc_auc FROM {ranking_sql(_scored_sql('tabpfn_mix'))}")
def _roc(spark, root):
    found = ranking_metrics(_scored(spark, root, "tabpfn_mix"), "quality", "score")
    return found.select(fixed(F.col("roc_auc"), 8).alias("roc_auc"))


# every order carries a score and a label: ties among prices are counted together
@query(
    "pr_auc",
    f"""SELECT {fixed_sql('pr_auc', 8)} AS pr_auc FROM {ranking_sql(
        "(SELECT l_quantity AS score, (l_returnflag = 'R')::INTEGER AS t FROM lineitem)")}""",
)
def _pr(spark, root):
    li = table(spark, root, "lineitem")
    found = ranking_metrics(li.withColumn("t", (F.col("l_returnflag") == "R").cast("int")), "t", "l_quantity")
    return found.select(fixed(F.col("pr_auc"), 8).alias("pr_auc"))


@query(
    "single_class_metrics",
    """SELECT 0.0::DOUBLE AS roc_auc, 0.0::DOUBLE AS pr_auc, 0.0::DOUBLE AS precision FROM lineitem HAVING count(*) > 0""",
)
def _single(spark, root):
    li = table(spark, root, "lineitem").select(F.lit(0).alias("t"), F.lit(0).alias("p"), "l_quantity")
    row = one_row(ranking_metrics(li, "t", "l_quantity"), confusion_metrics(li, "t", "p"))
    return row.select("roc_auc", "pr_auc", "precision")


@query(
    "select_best_model",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model_name, {fixed_sql('pr_auc')} AS test_pr_auc FROM {ranking_sql(_scored_sql(m))}" for m, _ in MODELS
    ) + ")",
)
def _best(spark, root):
    frames = [
        ranking_metrics(_scored(spark, root, m), "quality", "score").select(
            F.lit(m).alias("model_name"), fixed(F.col("pr_auc")).alias("test_pr_auc")
        )
        for m, _ in MODELS
    ]
    return rank_models(reduce(DataFrame.unionByName, frames))


# ---------------------------------------------------------------- models

# Fits cannot be said in SQL: what they must report can: the rows and positives of each part that they were measured on
# and that every metric lies in its range.
_MEASURED = ("precision", "recall", "f1", "roc_auc", "pr_auc")


def _features(spark, root):
    """The whole feature table; the balance that defines the target is left out."""
    return stage(wide_features(spark, root).drop("c_acctbal"), "features")


def _in_range(metrics, prefix):
    return all(0.0 <= metrics[f"{prefix}{m}"] <= 1.0 for m in _MEASURED)


def _report(spark, name, metrics):
    rows = [
        (name, part, int(metrics[f"{part}_rows"]), int(metrics[f"{part}_positives"]), _in_range(metrics, f"{part}_"))
        for part in ("validation", "test")
    ]
    return spark.createDataFrame(rows, "model_name string, split string, rows bigint, positives bigint, valid boolean")


def _report_sql(name):
    return f"""SELECT '{name}' AS model_name, split, count(*) AS rows, sum("TARGET")::BIGINT AS positives, true AS valid
 FROM {_SPLIT_SQL} WHERE split <> 'train' GROUP BY split"""


def _trained(name):
    def run(spark, root):
        return _report(spark, name, train_model(_features(spark, root), KEY, "TARGET", name).metrics)

    return run


for _name in DEFAULTS:
    query(f"train_{_name}", _report_sql(_name))(_trained(_name))


def stored_bundle(spark, root, name="random_forest"):
    """Folder of a bundle trained on the feature table, and of the features."""
    features, path = _features(spark, root), staging_path(spark, "bundle")
    train_model(features, KEY, "TARGET", name).save(spark, path)
    return path, features


@query(
    "batch_score",
    f"""SELECT "SK_ID_CURR", true AS valid FROM {APPLICATIONS_SQL}""",
)
def _batch_score(spark, root):
    """A saved bundle is read back and scores every entity, one of its columns missing."""
    path, features = stored_bundle(spark, root)
    scored = Bundle.load(spark, path).score(features.drop("bureau__cents__std"), KEY)
    return scored.select(KEY, (F.col("score").between(0, 1) & F.col("prediction").isin(0, 1)).alias("valid"))


@query(
    "evaluate_bundle",
    f"""SELECT 'local_neural_net' AS model_name, count(*) AS rows, sum("TARGET")::BIGINT AS positives, true AS valid FROM {APPLICATIONS_SQL}""",
)
def _evaluate(spark, root):
    """A bundle is measured on all labelled rows: as many as there are, each scored once."""
    features = _features(spark, root)
    bundle = train_model(features, KEY, "TARGET", "local_neural_net")
    valid = _in_range(bundle.evaluate(features, KEY, "holdout_"), "holdout_")
    return bundle.score(features, KEY, ["TARGET"]).agg(
        F.lit("local_neural_net").alias("model_name"), F.count("score").alias("rows"),
        F.sum("TARGET").cast("bigint").alias("positives"), F.lit(valid).alias("valid"),
    )


@query(
    "param_grid",
    """SELECT n_estimators, max_depth, CASE WHEN max_depth < 0 THEN 'FAIL' ELSE 'COMPLETE' END AS status
 FROM (SELECT unnest([50, 100]) AS n_estimators), (SELECT unnest([3, -1]) AS max_depth) WHERE (SELECT count(*) FROM customer) > 0""",
)
def _grid(spark, root):
    """Four trials of a grid, two of which cannot be fitted and are kept as failed."""
    trials = parameter_grid({"n_estimators": [50, 100], "max_depth": [3, -1]})
    found = search(_features(spark, root), KEY, "TARGET", "random_forest", trials)
    params = F.from_json("parameters", "n_estimators int, max_depth int")
    return found.select(params.alias("p"), "status").select("p.n_estimators", "p.max_depth", "status")


@query("random_search", """SELECT i AS trial, 'COMPLETE' AS status FROM range(20) r(i) WHERE (SELECT count(*) FROM customer) > 0""")
def _random(spark, root):
    """Twenty trials on one prepared table, four at a time."""
    trials = random_parameters("random_forest", 20)
    return search(_features(spark, root), KEY, "TARGET", "random_forest", trials).select(
        F.col("trial").cast("bigint").alias("trial"), "status"
    )


@query("scoring_benchmark")
def _benchmark(spark, root):
    features = _features(spark, root)
    bundle = train_model(features, KEY, "TARGET", "pyod_autoencoder")
    return scoring_benchmark(bundle, features, KEY)


