"""Split, imputation, scaling and encoding learned on training rows only."""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.naming import NUMERIC_TYPES
from ledgerloom.operators.joins import fits_broadcast, lookup_join
from ledgerloom.operators.ordering import exact_quantiles, rank_within
from ledgerloom.sources.staging import stage
from pyspark.sql import types as T

INFREQUENT = "__infrequent__"


def split_features_target(
    df: DataFrame, target: str, exclude: Collection[str] = (), require_target: bool = True
) -> tuple[DataFrame, str | None]:
    """Features without the excluded columns and the target, and the target's name if present."""
    present = target in df.columns
    if require_target and not present:
        raise ValueError(f"target column `{target}` not found")
    return df.drop(*[c for c in {*exclude, target} if c in df.columns]), target if present else None


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``keep`` and ``columns`` in order; absent columns are 0, nulls stay null."""
    return df.select(
        *keep, *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns]
    )


def sample_order(key: Sequence[str], seed: int) -> Column:
    """md5 of key and seed: an order every engine can reproduce."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    target: str | None,
    test_size: float = 0.2,
    validation_size: float = 0.2,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Add ``split`` (train, validation, test), exact per class and independent of row order.

    Rows of a class of size n are ordered by ``md5(key|seed)``: the first
    ``ceil(test_size * n)`` are test, the next ``ceil(f * rest)`` validation with
    ``f = validation_size / (1 - test_size)``. Only (class, key) is ranked; the
    wide rows are compared with the two boundaries of their class and are not shuffled.
    """
    label = F.col(target).cast("string") if target else F.lit("")
    narrow = df.select(label.alias("__c"), *key).withColumn("__h", sample_order(key, seed))
    ranked = rank_within(narrow, ["__c"], ["__h", *key], "__r", unique_order=True)
    ranked = stage(ranked, "split")
    fraction = validation_size / (1.0 - test_size)
    n_test = F.ceil(F.col("n") * F.lit(test_size))
    sizes = ranked.groupBy("__c").agg(F.count(F.lit(1)).alias("n")).withColumn("t", n_test)
    # the product is rounded before ceil so that 0.25 * 40 cannot become 11
    sizes = sizes.withColumn("v", F.ceil(F.round((F.col("n") - F.col("t")) * F.lit(fraction), 9)))
    position = F.struct("__h", *key)
    marks = lookup_join(ranked.where(F.col("__c").isNotNull()), sizes.where(F.col("__c").isNotNull()), "__c", "inner")
    bounds = marks.groupBy("__c").agg(
        F.max(F.when(F.col("__r") <= F.col("t"), position)).alias("__t"),
        F.max(F.when(F.col("__r") <= F.col("t") + F.col("v"), position)).alias("__v"),
    )
    labelled = df.withColumn("__c", label).withColumn("__h", sample_order(key, seed))
    joined = lookup_join(labelled, bounds, "__c", "left")
    part = (
        F.when(position <= F.col("__t"), "test")
        .when(position <= F.col("__v"), "validation")
        .otherwise("train")
    )
    return joined.select(*df.columns, part.alias(name))


# ---------------------------------------------------------------- learned statistics


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): interpolated medians; all-null columns have no row."""
    return exact_quantiles(df, columns, [0.5]).select("column", "value")


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of text columns, nulls left out."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(counts: DataFrame) -> DataFrame:
    """(column, value): most frequent value, ties to the smallest."""
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("value")
    )


def frequent_categories(counts: DataFrame, min_frequency: int) -> DataFrame:
    """(column, value, n, category): rare values share one category per column."""
    kept = F.when(F.col("n") >= min_frequency, F.col("value")).otherwise(F.lit(INFREQUENT))
    return counts.withColumn("category", kept)


def category_indices(categories: DataFrame) -> DataFrame:
    """(column, value, slot): kept categories numbered by value, the rare ones last."""
    distinct = categories.select("column", "category").distinct().withColumn(
        "rare", F.col("category") == INFREQUENT
    )
    slots = rank_within(distinct, ["column"], ["rare", "category"], "slot", unique_order=True)
    slots = slots.select("column", "category", (F.col("slot") - 1).alias("slot"))
    return lookup_join(categories, slots, ["column", "category"], "inner").select(
        "column", "value", "category", "slot"
    )


def scaling(df: DataFrame, fills: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of the imputed columns; a zero deviation becomes 1."""
    names = list(fills)
    if not names:
        return {}
    # one pair of moments over long rows: two for each of many columns are more code than the JVM compiles
    cells = df.select(F.posexplode(F.array(*[_filled(c, fills[c]) for c in names])).alias("at", "value"))
    found = cells.groupBy("at").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()
    moments = {r["at"]: r for r in found}
    return {c: (moments[i]["m"] or 0.0, moments[i]["s"] or 1.0) if i in moments else (0.0, 1.0) for i, c in enumerate(names)}


def _filled(column: str, fill: float) -> Column:
    value = F.col(f"`{column}`").cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(fill))


@dataclass
class Preprocessor:
    """Column-typed preparation: fill and scale numbers, fill and one-hot encode the rest.

    Parameters per column are held here; the category table, whose size follows the
    data, stays a staged DataFrame and is joined, not collected. Vectors are sparse: a row takes a number for each
    numeric column and one for each text column, however many categories there are.
    """

    medians: dict[str, float]
    scales: dict[str, tuple[float, float]]
    modes: dict[str, str]
    widths: dict[str, int]
    categories: DataFrame | None
    few: bool | None = field(default=None, repr=False)

    @classmethod
    def fit(cls, train: DataFrame, min_frequency: int = 10, skip: Collection[str] = ()) -> Preprocessor:
        """Learn everything from the training rows. All-null columns are dropped."""
        fields = [f for f in train.schema if f.name not in skip]
        numeric = [f.name for f in fields if isinstance(f.dataType, (*NUMERIC_TYPES, T.BooleanType))]
        texts = [f.name for f in fields if f.name not in numeric]
        as_numbers = train.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in numeric])
        found = {r["column"]: r["value"] for r in medians(as_numbers, numeric).collect()} if numeric else {}
        fills = {c: found[c] for c in numeric if c in found}
        scales = scaling(as_numbers, fills)
        if not texts:
            return cls(fills, scales, {}, {}, None)
        counts = stage(category_counts(train, texts), "categories")
        top = {r["column"]: r["value"] for r in modes(counts).collect()}
        nulls = train.agg(
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(texts)]
        ).first()
        filled = {c: nulls[f"n{i}"] for i, c in enumerate(texts) if c in top}
        added = F.lit(0)
        for c, n in filled.items():
            is_mode = (F.col("column") == c) & (F.col("value") == top[c])
            added = F.when(is_mode, F.lit(n)).otherwise(added)
        imputed = counts.withColumn("n", F.col("n") + added)
        table = stage(category_indices(frequent_categories(imputed, min_frequency)), "slots")
        widths = {
            r["column"]: r["w"]
            for r in table.groupBy("column").agg((F.max("slot") + 1).alias("w")).collect()
        }
        return cls(fills, scales, top, {c: int(widths[c]) for c in texts if c in widths}, table)

    def numbers(self) -> list[Column]:
        """Imputed and scaled numeric columns under their own names."""
        out = []
        for c, fill in self.medians.items():
            mean, deviation = self.scales[c]
            out.append(((_filled(c, fill) - F.lit(mean)) / F.lit(deviation)).alias(c))
        return out

    def slots(self, df: DataFrame) -> DataFrame:
        """Add ``<column>__slot`` per text column; null for a category not seen in training.

        The category table is measured once. Within the broadcast bounds every column is looked up in the task that
        holds its rows; beyond them all columns' values are joined in one long form and come back by row.
        """
        if not self.widths:
            return df
        if self.few is None:
            self.few = fits_broadcast(self.categories)
        value = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c])) for c in self.widths}
        if self.few:
            for c in self.widths:
                pairs = self.categories.where(F.col("column") == c).select(
                    F.col("value").alias("__value"), F.col("slot").alias(f"{c}__slot")
                )
                df = df.withColumn("__value", value[c]).join(F.broadcast(pairs), "__value", "left").drop("__value")
            return df
        rows = stage(df.withColumn("__row", F.monotonically_increasing_id()), "encoded-rows")
        cells = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in value.items()])
        long = rows.select("__row", F.explode(cells).alias("x")).select("__row", "x.column", "x.value")
        found = lookup_join(long, self.categories.select("column", "value", "slot"), ["column", "value"], "inner", max_rows=0)
        wide = found.groupBy("__row").agg(*[
            F.max(F.when(F.col("column") == c, F.col("slot"))).alias(f"{c}__slot") for c in self.widths
        ])
        return rows.join(wide, "__row", "left").drop("__row")

    def transform(self, df: DataFrame, keep: Sequence[str], output: str = "features") -> DataFrame:
        """``keep`` columns and the feature vector; columns never seen are zeros."""
        names = [*self.medians, *self.widths]
        ready = self.slots(align_columns(df, names, [c for c in keep if c not in names]))
        numbers = array_to_vector(F.array(*self.numbers())) if self.medians else array_to_vector(F.array().cast("array<double>"))
        # a category that was not seen is the one beyond the last, which the encoder leaves out
        slots = {f"__slot{i}": F.coalesce(F.col(f"`{c}__slot`"), F.lit(w)).cast("double") for i, (c, w) in enumerate(self.widths.items())}
        ready = ready.select(*keep, numbers.alias("__numbers"), *[v.alias(n) for n, v in slots.items()])
        if not slots:
            return ready.withColumnRenamed("__numbers", output)
        hot = [f"__hot{i}" for i in range(len(slots))]
        sized = VectorSizeHint(inputCol="__numbers", size=len(self.medians), handleInvalid="optimistic").transform(ready)
        encoded = self._encoder(ready, list(slots), hot).transform(sized)
        return VectorAssembler(inputCols=["__numbers", *hot], outputCol=output).transform(encoded).select(*keep, output)

    def _encoder(self, ready: DataFrame, slots: list[str], hot: list[str]) -> OneHotEncoderModel:
        """Encoder of the known widths, from one row that holds the largest slots."""
        row = ready.sparkSession.createDataFrame([tuple(float(w - 1) for w in self.widths.values())], slots)
        return OneHotEncoder(inputCols=slots, outputCols=hot, handleInvalid="keep", dropLast=True).fit(row)

    def size(self) -> int:
        """Length of the feature vector."""
        return len(self.medians) + sum(self.widths.values())

    def save(self, spark: SparkSession, path: str) -> None:
        """Parameters as one JSON row, categories as a Parquet table."""
        state = {k: v for k, v in self.__dict__.items() if k not in ("categories", "few")}
        spark.createDataFrame([(json.dumps(state),)], "state string").write.parquet(f"{path}/state")
        if self.categories is not None:
            self.categories.write.parquet(f"{path}/categories")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        """Read back what ``save`` wrote."""
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        state["scales"] = {c: tuple(v) for c, v in state["scales"].items()}
        table = spark.read.parquet(f"{path}/categories") if state["widths"] else None
        return cls(**state, categories=table)


