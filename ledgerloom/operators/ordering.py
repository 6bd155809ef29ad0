"""Row numbers, running totals and quantiles over a whole table without a one-task window.

Tables of any size are sorted by range partitioning and written once; each partition's own
numbering is then raised by the (tiny) sizes of the partitions before it. A plain window
is used only over one row per partition, or after a count has shown a table to be small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup_join
from ledgerloom.sources.staging import stage

# A table counted to have at most this many rows may be ordered by one task.
SMALL_ROWS = 100_000
# Rank error of the sketch that narrows quantiles down: one part in this many.
SKETCH_ACCURACY = 1000

# Spark's default bound for pruning rank filters before the shuffle.
MAX_PRUNED = 1000

_MARK = "__mark"
_PART = "__part"
_BEFORE = "__before"
_TIE = "__tie"


def total_order(df: DataFrame, keys: Sequence[str] = ()) -> list[Column]:
    """Keys first, then all other columns, ascending with nulls first."""
    rest = [c for c in df.columns if c not in keys]
    return [F.col(f"`{c}`").asc_nulls_first() for c in [*keys, *rest]]


def _sorted_partitions(df: DataFrame, order: Sequence[Column | str], unique: bool, staged: bool = False) -> DataFrame:
    """Range partitioned and sorted. Equal order keys are told apart by the position of
    the row in a staged copy, so that copies of one row spread over partitions too; ``staged`` says that ``df`` is one."""
    if unique:
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    tied = tied if staged else stage(tied, "tied")
    return (
        tied.repartitionByRange(*order, F.col(_TIE))
        .sortWithinPartitions(*order, F.col(_TIE))
        .drop(_TIE)
    )


def _before(sizes: DataFrame, value: str, alias: str) -> DataFrame:
    """Exclusive prefix sum over partitions: one input row per partition."""
    earlier = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(_PART, F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(alias))


def row_ids(
    df: DataFrame,
    name: str,
    order_by: Sequence[Column | str] | None = None,
    start: int = 0,
    unique_order: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Prepend contiguous ids ``start, start+1, …``; in ``order_by`` order if given.

    Without an order no data is shuffled at all. ``unique_order`` states that no two
    rows share an order key, which saves the extra pass that separates ties; so does ``staged``,
    that ``df`` is a scan of a staged table, whose positions are the same in every job.
    """
    columns = df.columns
    if order_by:
        df = _sorted_partitions(df, order_by, unique_order, staged)
    marked = stage(df.withColumn(_MARK, F.monotonically_increasing_id()), "row-ids")
    # the mark holds the partition in its upper 31 bits and the row position below
    placed = marked.withColumn(_PART, F.shiftright(_MARK, 33))
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the written table: far below any broadcast bound
    numbered = placed.join(F.broadcast(_before(sizes, "n", _BEFORE)), _PART)
    position = F.col(_MARK) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    return numbered.select(
        (F.col(_BEFORE) + position + F.lit(start)).cast("bigint").alias(name), *columns
    )


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[Column | str],
    name: str,
    unique_order: bool = False,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """1-based position inside each group, exact for groups of any size.

    The input is staged and counted. A small one is numbered by a window per group; any
    other by one global numbering in (group, order) minus the number where a group begins.
    """
    staged = stage(df, "ranked")
    if staged.count() <= small_rows:
        window = W.partitionBy(*groups).orderBy(*order_by)
        return staged.select(F.row_number().over(window).cast("bigint").alias(name), *df.columns)
    gid = "__gid"
    leading = [F.col(g).asc_nulls_first() for g in groups]
    numbered = row_ids(staged, gid, [*leading, *order_by], 0, unique_order, staged=True)
    begins = numbered.groupBy(*groups).agg(F.min(gid).alias("__begin"))
    safe = [f"__k{i}" for i in range(len(groups))]
    begins = begins.select(*[_null_key(g).alias(s) for g, s in zip(groups, safe)], "__begin")
    for g, s in zip(groups, safe):
        numbered = numbered.withColumn(s, _null_key(g))
    joined = lookup_join(numbered, begins, safe, "inner")
    return joined.select((F.col(gid) - F.col("__begin") + 1).alias(name), *df.columns)


def _null_key(column: str) -> Column:
    """A struct is never null itself, so null groups join like any other."""
    return F.struct(F.col(f"`{column}`").isNull().alias("n"), F.coalesce(
        F.col(f"`{column}`").cast("string"), F.lit("")).alias("v"))


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column | str],
    sums: dict[str, str],
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Inclusive running sums in a unique order; ``sums`` maps new name to column."""
    staged = stage(df, "totals")
    if staged.count() <= small_rows:
        whole = W.orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
        return staged.select(*df.columns, *[F.sum(c).over(whole).alias(n) for n, c in sums.items()])
    ordered = _sorted_partitions(staged, order_by, unique=True)
    placed = stage(ordered.withColumn(_PART, F.spark_partition_id()), "running")
    sizes = placed.groupBy(_PART).agg(*[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()])
    earlier = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART,
        *[F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in sums],
    )
    inside = W.partitionBy(_PART).orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"__l_{n}") for n, c in sums.items()])
    # one row per partition of the written table: far below any broadcast bound
    joined = local.join(F.broadcast(offsets), _PART)
    return joined.select(
        *df.columns, *[(F.col(f"__l_{n}") + F.col(f"__o_{n}")).alias(n) for n in sums]
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = SKETCH_ACCURACY,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """(column, probability, value): linearly interpolated exact quantiles.

    A mergeable sketch first brackets every quantile by two values. One more aggregate
    counts the rows below and inside each bracket, which proves that it holds the wanted
    ranks; a bracket that does not is widened to the whole column. Only values inside the
    brackets are then counted and ranked, a small part of the table. Per
    column and probability a few numbers reach the driver. Nulls and NaN are left out.
    """
    spark, out = df.sparkSession, "column string, probability double, value double"
    numbers = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    spots = [(i, j, p) for i in range(len(columns)) for j, p in enumerate(probabilities)]
    margin = 2.0 / accuracy
    ends = [q for p in probabilities for q in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = numbers.agg(
        *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.percentile_approx(f"c{i}", ends, accuracy).alias(f"q{i}") for i in range(len(columns))],
    ).first()
    spots = [s for s in spots if sketch[f"n{s[0]}"]]
    if not spots:
        return spark.createDataFrame([], out)
    brackets = {(i, j): tuple(sketch[f"q{i}"][2 * j: 2 * j + 2]) for i, j, _ in spots}
    within = {k: F.col(f"c{k[0]}").between(*map(F.lit, ab)) for k, ab in brackets.items()}
    counted = numbers.agg(
        *[F.count_if(F.col(f"c{i}") < F.lit(brackets[i, j][0])).alias(f"b{i}_{j}") for i, j, _ in spots],
        *[F.count_if(within[i, j]).alias(f"w{i}_{j}") for i, j, _ in spots],
    ).first()
    wanted, rows = [], 0
    for i, j, p in spots:
        position = p * (sketch[f"n{i}"] - 1)
        low, high = math.floor(position), math.ceil(position)
        below, inside = counted[f"b{i}_{j}"], counted[f"w{i}_{j}"]
        if not (below <= low and high < below + inside):
            within[i, j], below, inside = F.col(f"c{i}").isNotNull(), 0, sketch[f"n{i}"]
        wanted.append((f"{i}_{j}", columns[i], float(p), low - below, high - below, position - low))
        rows = max(rows, inside)
    cells = F.array(
        *[F.when(within[i, j], F.struct(F.lit(f"{i}_{j}").alias("spot"), F.col(f"c{i}").alias("v"))) for i, j, _ in spots]
    )
    held = numbers.select(F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("cell"))
    counts = held.groupBy(F.col("cell.spot").alias("spot"), F.col("cell.v").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if rows <= small_rows:
        window = W.partitionBy("spot").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
        ranked = counts.withColumn("last", F.sum("n").over(window) - 1)
    else:
        totals = stage(running_totals(counts, ["spot", "v"], {"cum": "n"}), "cumulated")
        begins = totals.groupBy("spot").agg(F.min(F.col("cum") - F.col("n")).alias("begin"))
        ranked = lookup_join(totals, begins, "spot", "inner").withColumn(
            "last", F.col("cum") - F.col("begin") - 1
        )
    # one row per column and probability: bounded by the request
    asked = spark.createDataFrame(
        wanted, "spot string, column string, probability double, low bigint, high bigint, weight double"
    )
    placed = ranked.join(F.broadcast(asked), "spot")
    first = F.col("last") - F.col("n") + 1
    held_at = {c: F.max(F.when(F.col(c).between(first, F.col("last")), F.col("v"))) for c in ("low", "high")}
    ends_of = placed.groupBy("column", "probability", "weight").agg(
        held_at["low"].alias("a"), held_at["high"].alias("b")
    )
    value = F.col("a") + F.col("weight") * (F.col("b") - F.col("a"))
    return ends_of.select("column", "probability", value.alias("value"))


def _number(df: DataFrame, column: str) -> Column:
    """Column as a double, null instead of NaN."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def first_n_per_group(
    df: DataFrame, groups: Sequence[str], order_by: Sequence[Column | str], n: int
) -> DataFrame:
    """First ``n`` rows of each group.

    Up to 1000 rows Spark prunes each partition to ``n`` rows per group before the
    shuffle, so a hot group sends at most ``n`` rows per task; beyond that rows are ranked
    globally.
    """
    if n > MAX_PRUNED:
        return rank_within(df, groups, order_by, "__rn").where(F.col("__rn") <= n).drop("__rn")
    window = W.partitionBy(*groups).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= n).drop("__rn")


def dedup_by_key(
    df: DataFrame, key: str | Sequence[str], order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key: the first in ``order_by``, made total by all other columns."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [*(order_by or []), *total_order(df, keys)[len(keys):]]
    return first_n_per_group(df, keys, order or [F.lit(1)], 1)


def page_of(df: DataFrame, name: str, order_by: Sequence[Column | str], size: int) -> DataFrame:
    """Add the 0-based page a row falls on when the ordered table is cut into pages."""
    numbered = row_ids(df, "__n", order_by)
    return numbered.select(
        F.floor(F.col("__n") / F.lit(size)).cast("bigint").alias(name), *df.columns
    )


def sorted_slice(
    df: DataFrame,
    order_by: Sequence[Column | str],
    begin: int,
    end: int,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Rows ``begin:end`` (0-based, end excluded) of the ordered table."""
    kept = df.drop(*exclude)
    numbered = row_ids(kept, "__n", order_by)
    return numbered.where((F.col("__n") >= begin) & (F.col("__n") < end)).drop("__n")


#: Rows up to which a plain sort with a limit is used.
FEW_ROWS = 10_000


def first_rows(df: DataFrame, order_by: Sequence[Column | str], n: int, few: int = FEW_ROWS) -> DataFrame:
    """The first ``n`` rows in an order. Few rows pass one task; more are cut by their numbers, in parallel."""
    if n <= few:
        return df.orderBy(*order_by).limit(n)
    return row_ids(df, "__first", order_by).where(F.col("__first") < n).drop("__first")
