"""Mixing sources to target weights by a low-discrepancy schedule.

Slot t of the mix is the point frac(t * golden ratio) mapped through the sources' cumulative shares, so
every stretch of the schedule holds all sources in proportion. Slots are ranked per source; the
documents of a source, in an order shuffled by hash, are one stream cut into blocks of equal numbers of words, and
slot r of a source takes block r, starting anew when the blocks are used up. All ranks and running
sums are by chunk with the chunks' totals added, so no source is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ROW, column_of, numbered, pick, query, table, word_count
from ledgerloom.operators.ordering import row_ids
from ledgerloom.sources.staging import stage

#: Weights of the sources in order, repeating; the mix's size and a source's most use.
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
#: Words of a block at most; a small source has blocks of 1/PARTS of its words.
BLOCK_WORDS, PARTS = 1024, 128
#: Rows of a chunk, about.
CHUNK = 5_000
SLOTS = 65_536
GOLDEN = 0.6180339887498949


def running(df: DataFrame, by: list[str], chunk: str, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group ``by``; ``chunk`` must rise with ``order``."""
    earlier = Window.partitionBy(*by).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*by, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*by, chunk).agg(F.sum(value).alias("__sum")).select(
        *by, chunk, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before")
    )
    return df.withColumn("__in", F.coalesce(F.sum(value).over(inner), F.lit(0))).join(totals, [*by, chunk]).withColumn(
        out, F.col("__in") + F.col("__before")
    ).drop("__in", "__before")


def source_targets(rows: DataFrame) -> DataFrame:
    """Staged (place, source, source_size, n_rows, target) from rows (source, size).

    The excess over a source's most is shared by weight among the others until none is above;
    each round is one aggregate of two numbers.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    placed = stage(
        row_ids(sizes, "place", [F.col("source").asc_nulls_last()], unique_order=True)
        .withColumn("weight", F.element_at(weights, F.pmod("place", F.lit(len(WEIGHTS))).cast("int") + 1))
        .withColumn("most", F.col("source_size") * MOST),
        "sources",
    )
    total = (placed.agg(F.sum("source_size")).first()[0] or 0) * SHARE
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level >= F.col("most")
        held, free = placed.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        now = (total - (held or 0.0)) / free if free else level
        if now is None or now == level:
            break
        level = now
    return placed.withColumn("target", F.least("most", F.col("weight") * F.lit(level or 0.0))).drop("weight", "most")


def _rows(docs: DataFrame, id_col: str, source_col: str, text_col: str, row: Column) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(text_col)).alias("mark"), row.alias("row"),
    )


def _scheduled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows as streams of their sources, and the staged slots (place, rank, number, slot) of the schedule.

    ``start`` is the number of words before a row in its source's stream, ``rank`` counts a source's slots and
    ``number`` is the block that a slot takes.
    """
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / PARTS))).cast("bigint")
    sources = stage(
        source_targets(rows).withColumn("block", block)
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("bigint"))
        .withColumn("wanted", F.col("target") / F.col("block"))
        .withColumn("chunks", F.ceil(F.col("n_rows") / CHUNK).cast("bigint")),
        "mix-sources",
    )
    n_sources, total = sources.agg(F.count(F.lit(1)), F.sum("wanted")).first()
    spread = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(
        "row", "id", "mark", rows["source"], "size", "source_size", "target", "place", "block", "blocks", "chunks",
        F.xxhash64("id", "mark").bitwiseAND(F.lit((1 << 63) - 1)).alias("at"),
    ).withColumn("chunk", F.shiftright(F.shiftright("at", 32) * F.col("chunks"), 31))
    streamed = running(spread, ["place"], "chunk", ["at", "id", "mark", "row"], "size", "start")
    return streamed, stage(_slots(sources, n_sources, total or 0.0), "mix-slots")


def _parts(streamed: DataFrame) -> DataFrame:
    """The rows once for each block that they reach into: ``number``, the first word there (``begin``), and ``shared`` words."""
    first = F.floor(F.col("start") / F.col("block"))
    last = F.floor((F.col("start") + F.col("size") - 1) / F.col("block"))
    parts = streamed.withColumn("number", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    begin = F.greatest(F.col("start"), F.col("number") * F.col("block"))
    return parts.withColumns({
        "begin": begin - F.col("start"),
        "shared": F.least(F.col("start") + F.col("size"), (F.col("number") + 1) * F.col("block")) - begin,
    })


def _taken(streamed: DataFrame, slots: DataFrame) -> DataFrame:
    times = slots.groupBy("place", "number").agg(F.count(F.lit(1)).alias("times"))
    kept = [c for c in streamed.columns if c not in ("at", "chunk", "chunks")]
    return (
        _parts(streamed).join(times, ["place", "number"], "left").groupBy(*kept)
        .agg(F.sum(F.coalesce(F.col("shared") * F.col("times"), F.lit(0))).cast("bigint").alias("taken"))
    )


def plan_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per input row: id, mark (hash of its text), source, size, source_size, target, taken.

    ``taken`` is the number of the row's words in the mix: whole copies, and for at most a row per source and
    pass the words up to a block's end. Null texts have no words; a null source is a source of its own,
    last in order. Equal inputs give equal results; rows equal in id and text may swap theirs. Other columns are ignored;
    an empty table gives an empty result; a text of any length is cut by blocks like any other.
    """
    picked = pick(docs, id=id_col, source=source_col, text=text_col)
    rows = stage(_rows(picked, "id", "source", "text", F.monotonically_increasing_id()), "mix-rows")
    return _taken(*_scheduled(rows)).select("id", "mark", "source", "size", "source_size", "target", "taken")


def schedule(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix slot by slot: (slot, source, block, id, begin, words), in order of slots.

    A slot takes one block of its source; a row of it are ``words`` words of one document from its word ``begin`` on. Any
    stretch of slots holds the sources nearly in proportion to their targets divided by their blocks' sizes.
    """
    picked = pick(docs, id=id_col, source=source_col, text=text_col)
    streamed, slots = _scheduled(stage(_rows(picked, "id", "source", "text", F.monotonically_increasing_id()), "mix-rows"))
    met = _parts(streamed).where("shared > 0").join(slots, ["place", "number"])
    return met.select(
        "slot", "source", F.col("number").alias("block"), "id", "begin", F.col("shared").alias("words"), "start"
    ).orderBy("slot", "start").drop("start")


def _slots(sources: DataFrame, n_sources: int, total: float) -> DataFrame:
    """(place, rank, number, slot): every slot of the schedule, its source, and the block that it takes."""
    spark = sources.sparkSession
    cells = max(1024, n_sources)
    chunked = sources.withColumn("part", F.floor(F.col("place") / CHUNK))
    one = running(chunked.withColumn("all", F.lit(0)), ["all"], "part", ["place"], "wanted", "before")
    low, high = F.col("before") / F.lit(max(total, 1e-300)), (F.col("before") + F.col("wanted")) / F.lit(max(total, 1e-300))
    shares = one.where("wanted > 0").select(
        "place", "blocks", "wanted", low.alias("low"), high.alias("high"),
        F.explode(F.sequence(F.floor(low * cells), F.least(F.floor(high * cells), F.lit(cells - 1).cast("bigint")))).alias("cell"),
    )
    import math

    points = spark.range(math.ceil(total)).select(
        F.col("id").alias("t"), F.pmod(F.col("id") * F.lit(GOLDEN), F.lit(1.0)).alias("u")
    ).withColumn("cell", F.floor(F.col("u") * cells))
    # a cell holds the sources whose interval touches it: the points meet their source by an equi-join
    inside = (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))
    scheduled = points.join(shares, "cell").where(inside).select(
        "place", "blocks", "wanted", "t", F.floor(F.col("t") / SLOTS).alias("chunk"), F.lit(1).alias("one")
    )
    ranked = running(scheduled, ["place"], "chunk", ["t"], "one", "rank")
    return ranked.where(F.col("rank") < F.ceil("wanted")).select(
        "place", "rank", F.pmod("rank", "blocks").alias("number"), F.col("t").alias("slot")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        chars_col: str = "n_chars") -> DataFrame:
    """The mixed corpus in the schedule's order, with the input's columns: each row as often as the mix takes it.

    A copy stands at the slot that takes its first word. Where the mix ends within it, it is cut: a part
    holds the first words that are taken, joined by a space. Rows without words are in no mix. Rows that repeat
    are rows of their own; columns may have any names.
    """
    held, restored = numbered(docs)
    text = F.col(column_of(docs, text_col))
    rows = stage(_rows(held, column_of(docs, id_col), column_of(docs, source_col), column_of(docs, text_col), F.col(ROW)), "mix-rows")
    streamed, slots = _scheduled(rows)
    plan = stage(_taken(streamed, slots).where("taken > 0").select("row", "size", "taken", "place", "start", "block", "blocks"), "mix-plan")
    last = F.floor((F.col("taken") - 1) / F.col("size"))
    copies = plan.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumns({
        "words": F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size")),
        "rank": F.col("copy") * F.col("blocks") + F.floor(F.col("start") / F.col("block")),
    })
    placed = copies.join(slots.select("place", "rank", "slot"), ["place", "rank"]).select(
        F.col("row").alias(ROW), F.col("size").alias("__size"), F.col("words").alias("__words"), F.col("slot").alias("__slot"),
        F.col("start").alias("__start"),
    )
    part = F.array_join(F.slice(
        F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)")), 1, F.col("__words").cast("int")
    ), " ")
    whole = F.col("__words") == F.col("__size")
    changed = held.join(placed, ROW).withColumn(column_of(docs, text_col), F.when(whole, text).otherwise(part))
    if chars_col in docs.columns:
        chars = column_of(docs, chars_col)
        changed = changed.withColumn(chars, F.char_length(text).cast(docs.schema[chars_col].dataType))
    return restored(changed.orderBy("__slot", "__start", ROW))


@query("op9_mixing")
def op9(spark: SparkSession, root: str) -> DataFrame:
    """Every document's size, its source's size and target, and the words that the mix takes of it."""
    return plan_mix(table(spark, root, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )
