"""Helpers shared by the operators: column picking, registration, connected classes."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.staging import drop_staged, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Fixed: the contracts' white space, and its complement.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say it, the statement that must agree with it."""
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the given names, found by exact spelling and first position.

    Whatever else the input carries, also names that differ only in case or clash
    with an operator's own, can then neither shadow nor break anything.
    """
    names = list(df.columns)
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"c{names.index(old)}").alias(new) for new, old in columns.items()])


#: Name of the row number that ``numbered`` adds.
ROW = "row"


def renamed(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with columns c0, c1, ..., so that no name is ambiguous or overwritten, and what gives the names back."""
    names = list(docs.columns)
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), lambda rows: rows.select(
        *[f"c{i}" for i in range(len(names))]
    ).toDF(*names)


def is_scan(df: DataFrame) -> bool:
    """Whether a table is read straight from files, which give the same rows in the same order to every job."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() == "Project":
        node = node.children().apply(0)
    return node.nodeName().startswith("LogicalRelation")


def numbered(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``renamed`` rows with a row number; what is not read straight from files is staged once.

    Rows that repeat whole have numbers of their own, and a task that is run again finds the same rows under the
    same numbers.
    """
    held, restored = renamed(docs)
    number = F.monotonically_increasing_id()
    return (held.withColumn(ROW, number) if is_scan(docs) else stage(held.withColumn(ROW, number), "rows")), restored


def column_of(docs: DataFrame, name: str) -> str:
    """The name that ``renamed`` gives the first column spelled exactly so."""
    return f"c{list(docs.columns).index(name)}"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def spans(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``most`` characters in all, one text at least."""
    start = chars = 0
    for at, text in enumerate(texts):
        if at > start and chars >= most:
            yield start, at
            start, chars = at, 0
        chars += len(text or "")
    if texts:
        yield start, len(texts)


#: A space beside other white space.
_ODD = re.compile(r" (?:(?=\s)|(?<=[^\S ] ))")


def cut_parts(text: str) -> list[str]:
    """Parts of a text, cut at single spaces between other characters; each with a space before it, they join to space + text."""
    found = text.split(" ")
    if not _ODD.search(text) and not text[:1].isspace() and not text[-1:].isspace():
        return found
    out, closed = [[found[0]]], found[0] != "" and not found[0][-1].isspace()
    for part in found[1:]:
        if closed and part and not part[0].isspace():
            out.append([part])
        else:
            out[-1].append(part)
        closed = part != "" and not part[-1].isspace()
    return [" ".join(parts) for parts in out]


def frequent(counts: DataFrame, most: int, n: str = "n") -> tuple[DataFrame, DataFrame]:
    """The rows with the largest counts, at most ``most`` of them, and all other rows.

    The cut lies between bins of the counts' logarithm, so the bound holds whatever the counts are, and
    only the bins' sizes (a few hundred numbers) reach the driver. Counts must be 1 or more.
    """
    bins = counts.withColumn("__bin", F.floor(F.log2(n) * 8).cast("int"))
    held, cut = 0, None
    for row in sorted(bins.groupBy("__bin").agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True):
        held += row["rows"]
        if held > most:
            break
        cut = row["__bin"]
    high = F.lit(False) if cut is None else F.col("__bin") >= cut
    return bins.where(high).drop("__bin"), bins.where(~high).drop("__bin")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every linked node: (node, root), by alternating stars.

    Each round is two aggregations with partial sums and two joins, so a hub is
    one row per task before it is shuffled; the links of a round are staged, and the
    rounds end when a round changes nothing. Rounds grow with the logarithm of the nodes.
    """
    def once(df: DataFrame) -> DataFrame:
        return stage(df.where("u <> v").distinct(), "links")

    def sign(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = once(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    before = sign(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # large star: the larger neighbours of a node go to its smallest one
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        older, edges = edges, once(small.union(least.select("u", F.col("m").alias("v"))))
        drop_staged(older)
        after = sign(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
