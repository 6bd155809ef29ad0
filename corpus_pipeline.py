"""Corpus pipeline over documents; each stage's output is written as Parquet and read by the next.

Toxic documents go, then exact copies, then near duplicates; what is left is mixed to the sources' target
weights and encoded. Every stage works on all rows that the one before it kept. Columns beside those of
documents pass through to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.llm.exact_dedup import drop_exact_copies
from ledgerloom.llm.lattice import encode, read_pieces
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.simhash import drop_near_copies
from ledgerloom.llm.toxicity import drop_toxic
from ledgerloom.sources.staging import drop_staged, stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the fit uses labelled documents among the input."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the one with the largest id."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints of three-word shingles within three bits stays: the one with the smallest id."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in the order of its schedule: a document as often as its source's target takes it, cut where the mix ends."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row of the mix: doc_id, ids, n_tokens, and whether the ids decode to the text."""
    return encode(docs, read_pieces()).select(F.col("id").alias("doc_id"), "ids", "n_tokens", "exact")


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing", mixing),
    ("SentencePiece", encoding),
]
#: SQL cannot say the fitted and iterative stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, step) in enumerate(STAGES[:-1]):
        older, docs = docs, stage(step(spark, docs, sf_dir), f"pipeline-{at}")
        if at:
            drop_staged(older)
    return STAGES[-1][1](spark, docs, sf_dir)
