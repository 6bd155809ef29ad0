"""Near duplicates by SimHash with pigeonring filtering.

A fingerprint of 64 bits is a ring of ``SEGMENTS`` segments. If two fingerprints differ in at
most t bits, some segment starts a chain along the ring whose first l segments together
differ in at most floor(l * t / SEGMENTS) bits, for every l. The first condition (no
difference) and the next (at most one) are turned into join keys: the exact segments
plus one half of the segments that allow a single difference, so that for t = 3 every
fingerprint has 16 keys of 28 bits. Candidates that share a key must pass the whole chain before
the full Hamming check. No candidate is lost and no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ROW, column_of, components, numbered, pick, query, table
from ledgerloom.sources.staging import stage

SEGMENTS = 8
WIDTH = 8
MAX_DISTANCE = 3
#: Shingle hashes whose bits are counted at a time.
_CHUNK = 1 << 15


def _hashes(words: list[bytes], n: int, seed: int):
    import numpy as np
    import xxhash

    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(text[s:e], seed) for s, e in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1:].tolist(), strict=True)),
        np.uint64, len(words) - n + 1,
    )


def fingerprint(text: str | None, n: int, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased (A-Z) text's n-word shingles, repeats counted.

    A bit is set if it is set in over half of the hashes. Fewer words than n are one
    shingle; no words, empty and null give 0.
    """
    import numpy as np

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    hashes = _hashes(words, n, seed).astype(">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at: at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, fp): one row per input row, whole texts."""
    rows = pick(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), n) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {id_type.simpleString()}, fp bigint")


def _turn(value: Column, start: int) -> Column:
    bits = WIDTH * start
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _top(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, 64 - bits)


def _spans(limit: int) -> tuple[int, int]:
    """Bits at a chain's start that must be equal, and bits after them that may differ once."""
    if not 0 < limit < SEGMENTS:
        raise ValueError(f"a distance from 1 to {SEGMENTS - 1} is needed: {limit}")
    exact = -(-SEGMENTS // limit) - 1
    once = min(SEGMENTS, -(-2 * SEGMENTS // limit) - 1) - exact
    return exact * WIDTH, once * WIDTH


def _keys(fp: Column, limit: int) -> Column:
    exact, once = _spans(limit)
    half = once // 2
    keys = []
    for start in range(SEGMENTS):
        turned = _turn(fp, start)
        front = _top(turned, exact) if exact else F.lit(0).cast("bigint")
        for part, width, end in ((0, half, exact + half), (1, once - half, exact + once)):
            piece = _top(turned, end).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            value = F.shiftleft(front, width).bitwiseOR(piece)
            keys.append(F.xxhash64(F.lit(start * 2 + part), value))
    return F.array(*keys)


def _chained(x: Column, limit: int) -> Column:
    """Whether some start of the ring keeps every prefix of its chain within its share."""
    chains = None
    for start in range(SEGMENTS):
        turned, holds = _turn(x, start), None
        for length in range(1, SEGMENTS):
            within = F.bit_count(_top(turned, length * WIDTH)) <= length * limit // SEGMENTS
            holds = within if holds is None else holds & within
        chains = holds if chains is None else chains | holds
    return chains


def links(values: DataFrame, limit: int = MAX_DISTANCE) -> DataFrame:
    """Pairs a < b of different fingerprints (column fp) that differ in at most ``limit`` bits."""
    keyed = values.select("fp").distinct().select("fp", F.explode(_keys(F.col("fp"), limit)).alias("key"))
    left, right = keyed.select("key", F.col("fp").alias("a")), keyed.select("key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & _chained(x, limit) & (F.bit_count(x) <= limit)
    return left.join(right, (left["key"] == right["key"]) & near).select("a", "b").distinct()


def roots(prints: DataFrame, limit: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root) for the distinct fingerprints of rows (fp): one root for all that links connect."""
    nodes = prints.select("fp").distinct()
    rooted = components(links(nodes, limit))
    return nodes.join(rooted, nodes["fp"] == rooted["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(prints: DataFrame, limit: int = MAX_DISTANCE) -> DataFrame:
    """(id, fp, component_id) for rows (id, fp): the smallest id reachable over links.

    Rows with one fingerprint are one node, so copies are never paired. A null id is never
    the smallest; a class of null ids only has a null component_id.
    """
    nodes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    rooted = nodes.join(roots(nodes, limit), "fp")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@query("op7_simhash")
def op7(spark: SparkSession, root: str) -> DataFrame:
    """Every document with its 3-word fingerprint and the smallest id of its class."""
    prints = stage(fingerprints(table(spark, root, "documents"), "doc_id", "text", 3), "prints")
    return classes(prints).select(
        F.col("id").alias("doc_id"), hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, limit: int = MAX_DISTANCE) -> DataFrame:
    """The input's rows with one row of each class of near duplicates, all columns kept.

    Classes are those of ``classes`` over ``n``-word fingerprints within ``limit`` bits; the row with the smallest id stays, a
    null id being larger than any other, and of rows with that id the first. Null texts and texts without
    words have the fingerprint zero and are one class. Names that differ only in case, or are those that
    this function uses itself, do no harm. An empty table gives an empty result; texts of any length are read whole.
    """
    held, restored = numbered(docs)
    keyed = held.select(F.struct(ROW, F.col(column_of(docs, id_col)).alias("id")).alias("key"), F.col(column_of(docs, text_col)).alias("text"))
    prints = stage(fingerprints(keyed, "key", "text", n).select("id.*", "fp"), "prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", ROW)).alias("first")
    # copies are one row per fingerprint and task before any class is formed
    nodes = prints.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n"))
    kept = nodes.join(roots(nodes, limit), "fp").groupBy("root").agg(F.min("first").alias("first"))
    return restored(held.join(kept.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_semi"))
