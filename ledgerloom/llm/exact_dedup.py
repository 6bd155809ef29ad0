"""Exact duplicates by a split of frequent and other digests, in built-in functions only.

A frequent-items sketch (the Misra-Gries family: mergeable counters whose error is
bounded by the number of counters) over all digests names at most ``CANDIDATES``
digests. An exact count of just these keeps those that do repeat; the winners are at
most ``CANDIDATES`` rows, so their broadcast is bounded whatever the input size. Rows of
such a digest are decided on the map side and are never shuffled by it. What is left
has no digest above a small share of all rows and takes the ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ROW, ascii_lower, column_of, numbered, pick, query, table
from ledgerloom.sources.staging import stage

#: Digests that the sketch may name; the bound of both broadcasts.
CANDIDATES = 1024
#: Counters of the sketch. A digest above about rows / COUNTERS * 4 / 3 cannot be missed.
COUNTERS = 8192


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text after A-Z are lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def grouped(rows: DataFrame) -> DataFrame:
    """Staged rows (id, digest, row) with ``keep``, the (id, row) that stays of their digest, and group_size."""
    frequent = rows.agg(
        F.expr(f"approx_top_k(hex(digest), {CANDIDATES}, {COUNTERS})").alias("top")
    ).select(F.explode("top").alias("t")).select(F.unhex("t.item").alias("digest"))

    def groups(df: DataFrame) -> DataFrame:
        # a struct orders by id, nulls first, then by row, which parts equal ids
        return df.groupBy("digest").agg(
            F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        )

    winners = groups(rows.join(F.broadcast(frequent), "digest", "left_semi")).where("group_size > 1")
    marked = rows.join(F.broadcast(winners), "digest", "left")
    heavy = marked.where("group_size is not null")
    light = marked.where("group_size is null").select("digest", "id", "row")
    return heavy.select("digest", "id", "row", "keep", "group_size").union(
        light.join(groups(light), "digest").select("digest", "id", "row", "keep", "group_size")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept.

    Of equal texts the row with the largest id stays; of rows that share id and text
    exactly one stays; a null id is smaller than any other. Null and empty texts are one group.
    An empty table gives an empty result. Other columns are ignored, whatever their names; texts of any length are hashed whole.
    """
    rows = stage(
        pick(docs, id=id_col, text=text_col).select(
            "id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )
    return grouped(rows).select(
        "id", "digest", F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows without exact copies, all columns kept; see ``exact_groups`` for which one stays.

    Only numbers of dropped rows meet the wide rows, in one join. Columns may have any names, also ones that differ only
    in case.
    """
    held, restored = numbered(docs)
    rows = stage(held.select(
        F.col(column_of(docs, id_col)).alias("id"), digest(F.col(column_of(docs, text_col))).alias("digest"), F.col(ROW).alias("row")
    ), "digests")
    lost = grouped(rows).where(F.col("row") != F.col("keep.row")).select(F.col("row").alias(ROW))
    return restored(held.join(lost, ROW, "left_anti"))


@query("op2_exact_dedup", """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n""")
def op2(spark: SparkSession, root: str) -> DataFrame:
    """Every document with the id that stays of its text, the group's size and the digest."""
    return exact_groups(table(spark, root, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
