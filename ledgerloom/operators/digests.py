"""Digest trees: two copies of a table are narrowed to the ranges in which they differ before any rows meet.

A key's hash places its row in one of 2**bits ranges. The tree's leaves hold, for every range, the number of rows and
the sum and exclusive or of their digests; a level above is the sum of the level below, so the tree is
built in one pass over the table, can be stored, and later compared without reading the table again. Two trees
are compared from the top: only below a range that differs is the next level looked at. Rows outside the
leaves that differ are neither shuffled nor joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.quality import _low_bits, canonical_text, cell_diff, row_digest
from ledgerloom.sources.staging import stage

#: Rows of a leaf, about; levels lie so many bits apart; most bits of a tree.
LEAF_ROWS, STEP, MOST_BITS = 512, 6, 30


def tree_bits(rows: int) -> int:
    """Bits of a tree over so many rows: the same for both copies."""
    return min(MOST_BITS, max(1, (rows // LEAF_ROWS).bit_length()))


def leaf_of(df: DataFrame, key: Sequence[str], bits: int) -> Column:
    """Range of a row: the first bits of the hash of its key's text, so that types may differ between copies."""
    return F.shiftrightunsigned(F.xxhash64(*[canonical_text(df, k) for k in key]), 64 - bits)


def digest_tree(df: DataFrame, key: Sequence[str], bits: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Staged leaves (leaf, rows, digest_sum, digest_xor); one partially aggregated pass over the table."""
    bit = _low_bits(row_digest(df, columns))
    rows = df.select(leaf_of(df, key, bits).alias("leaf"), bit.alias("b"))
    return stage(rows.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("b").cast("decimal(28,0)")).cast("decimal(38,0)").alias("digest_sum"),
        F.bit_xor("b").alias("digest_xor"),
    ), "digests")


def level(tree: DataFrame, up: int) -> DataFrame:
    """The tree's level ``up`` bits above its leaves, with the same columns."""
    if not up:
        return tree
    return tree.groupBy(F.shiftright("leaf", up).alias("leaf")).agg(
        F.sum("rows").alias("rows"), F.sum("digest_sum").cast("decimal(38,0)").alias("digest_sum"), F.bit_xor("digest_xor").alias("digest_xor")
    )


def differing_leaves(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """Staged (leaf) of the leaves in which two trees differ, found from the top."""
    found, at = None, 0
    while at < bits:
        down = min(STEP, bits - at)
        at += down

        def below(tree: DataFrame, found=found, at=at, down=down) -> DataFrame:
            nodes = level(tree, bits - at)
            if found is None:
                return nodes
            return nodes.join(found.select(F.col("leaf").alias("__top")), F.shiftright("leaf", down) == F.col("__top"), "left_semi")

        value = F.struct("rows", "digest_sum", "digest_xor")
        a, b = below(left).select("leaf", value.alias("l")), below(right).select("leaf", value.alias("r"))
        found = stage(a.join(b, "leaf", "full").where(~F.col("l").eqNullSafe(F.col("r"))).select("leaf"), "differing")
        if found.isEmpty():
            break
    return found


def narrowed(df: DataFrame, key: Sequence[str], bits: int, leaves: DataFrame) -> DataFrame:
    """Rows of the given leaves; where those are few Spark broadcasts them and moves no row."""
    marked = df.withColumn("__leaf", leaf_of(df, key, bits))
    return marked.join(leaves.select(F.col("leaf").alias("__leaf")), "__leaf", "left_semi").drop("__leaf")


def narrow(left: DataFrame, right: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of both copies in the leaves that differ in any column that both have."""
    columns = [c for c in left.columns if c in right.columns]
    bits = tree_bits(max(left.count(), right.count()))
    leaves = differing_leaves(digest_tree(left, key, bits, columns), digest_tree(right, key, bits, columns), bits)
    return narrowed(left, key, bits, leaves), narrowed(right, key, bits, leaves)


def narrowed_cell_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The cells of ``cell_diff``, from the differing leaves alone.

    A key that repeats there is an error, as it is to ``cell_diff``; one that repeats alike in both copies, in leaves
    that are equal, is no difference.
    """
    return cell_diff(*narrow(left, right, [key]), key)
