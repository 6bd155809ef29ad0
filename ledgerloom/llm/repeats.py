"""Repeated byte strings across documents: maximal repeats from an enhanced suffix array.

A text is cut into pieces by content: every window of ``LENGTH`` bytes belongs to the smallest
hash of its ``GRAM``-byte grams, and a run of windows with one smallest hash is a piece. Equal windows
have equal hashes wherever they stand, so all occurrences of a repeat meet under one key.

1. Blocks of documents send the keys of their pieces (5 bytes each); a bucket of
   keys answers with one bit per key: does another block have it too?
2. Blocks send the bytes around repeated keys once per block. A bucket sorts all their
   suffixes, computes common prefixes of neighbours, and scans the prefix intervals with a stack. An
   interval whose occurrences differ in the byte to their left (or stand at a piece's start) is
   a maximal repeat group with all its occurrences; the others lie inside a longer one.
3. The groups go back to the blocks, which mark every byte of an occurrence in a
   document with a larger id than the smallest one of the group.

The texts are shuffled once; the three steps read the same exchange. Copies of a whole text
are found by digest first and need no pieces. A block is about ``BLOCK`` bytes, a bucket the
pieces of ``BUCKET`` bytes of text, whatever the size of the table, and their numbers follow from
one sum of lengths. Equal pieces of a block travel once, so a passage in very many documents
is a row per block, not per document.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, query, table
from ledgerloom.sources.staging import stage

LENGTH = 50
GRAM = 20
BLOCK = 2_000_000
BUCKET = 16_000_000
#: Windows that share a smallest hash through one gram; longer runs (periodic text) are split.
RUN = LENGTH - GRAM + 1
#: Longest piece in bytes.
PIECE = RUN + LENGTH - 1
#: Suffixes that are sorted at a time.
SUFFIXES = 150_000
LAST = sys.maxsize
_COPY, _BITS, _GROUPS = 0, 1, 2
_SIDE = "block bigint, bucket bigint, kind int, data binary"


def _smallest(text):
    """Smallest gram hash of each window of the text (an array of bytes)."""
    import numpy as np

    one, two = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    grams = len(text) - GRAM + 1
    eight = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    h = eight[:grams] * one
    h ^= h >> np.uint64(32)
    for at in (8, GRAM - 8):
        h += eight[at: at + grams]
        h *= two
        h ^= h >> np.uint64(29)
    width = 1
    while width * 2 <= RUN:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    h = np.minimum(h[: len(text) - LENGTH + 1], h[RUN - width: RUN - width + len(text) - LENGTH + 1])
    # the smallest of many hashes is no even key
    h *= one
    h ^= h >> np.uint64(32)
    return h


class _Block:
    """Documents of a block in a fixed order; the pieces of those that are no copies."""

    def __init__(self, left, right, buckets: int) -> None:
        import numpy as np

        copies = {
            (c, d) for c, k, d in zip(*(right.column(n).to_pylist() for n in ("bucket", "kind", "data")), strict=True) if k == _COPY
        }
        self.id_array = left.column("id").combine_chunks()
        order = left.column("place").to_pylist()
        digest, body = left.column("digest").to_pylist(), left.column("body").to_pylist()
        self.rows = sorted(range(len(body)), key=lambda i: (order[i], digest[i]))
        self.bodies = [body[i] for i in self.rows]
        self.order = np.array([order[i] for i in self.rows], np.int64)
        self.copy = [(order[i], digest[i]) in copies for i in self.rows]
        self.cut = [i for i, x in enumerate(self.bodies) if len(x) >= LENGTH and not self.copy[i]]
        self.raw = b"".join(self.bodies[i] for i in self.cut)
        self.text = np.frombuffer(self.raw, np.uint8)
        lengths = np.array([len(self.bodies[i]) for i in self.cut], np.int64)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        none = np.zeros(0, np.int64)
        self.start = self.count = self.doc = none
        self.code = none.astype(np.uint64)
        if not self.cut:
            return
        key = _smallest(self.text)
        inside = np.ones(len(key) + LENGTH, bool)
        for end in self.ends.tolist():
            inside[end - LENGTH + 1: end] = False
        inside = inside[: len(key)]
        first = ~inside
        first[0] = True
        first[1:] |= (key[1:] != key[:-1]) | ~inside[:-1]
        start = np.flatnonzero(first)
        count = np.diff(np.r_[start, len(key)])
        start, count = start[inside[start]], count[inside[start]]
        parts = -(-count // RUN)
        piece = np.repeat(np.arange(len(start)), parts)
        part = np.arange(len(piece)) - np.repeat(np.cumsum(parts) - parts, parts)
        self.start = start[piece] + part * RUN
        self.count = np.minimum(RUN, count[piece] - part * RUN)
        self.doc = np.searchsorted(self.ends, self.start, "right")
        key = key[self.start]
        low = np.uint64((1 << 40) - 1)
        self.code = ((key >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | (key & low)

    def repeated(self, right):
        """Pieces whose key stands in another document of the block or in another block."""
        import numpy as np

        keys, place = np.unique(self.code, return_inverse=True)
        if not len(keys):
            return np.zeros(0, bool)
        low = np.full(len(keys), LAST)
        high = np.full(len(keys), -1)
        np.minimum.at(low, place, self.doc)
        np.maximum.at(high, place, self.doc)
        there = low < high
        bucket = (keys >> np.uint64(40)).astype(np.int64)
        for b, k, d in zip(*(right.column(n).to_pylist() for n in ("bucket", "kind", "data")), strict=True):
            if k == _BITS:
                at, to = np.searchsorted(bucket, [b, b + 1])
                there[at:to] |= np.unpackbits(np.frombuffer(d, np.uint8), count=to - at).astype(bool)
        return there[place]

    def contexts(self, right):
        """Repeated pieces, for each its context, and the contexts: bytes, code, place in the bucket."""
        import numpy as np
        import pyarrow as pa

        use = np.flatnonzero(self.repeated(right))
        start, stop = self.start[use], self.start[use] + self.count[use] + LENGTH - 1
        raw = self.raw
        # one piece of text has one key, so its bytes alone tell contexts apart
        texts = pa.array([raw[s:e] for s, e in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary()).dictionary_encode()
        which = texts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = np.zeros(len(texts.dictionary), np.uint64)
        code[which] = self.code[use]
        bucket = (code >> np.uint64(40)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(code), np.int64)
        place[order] = np.arange(len(code)) - np.searchsorted(bucket[order], bucket[order])
        return use, which, texts.dictionary.to_pylist(), code, bucket, order, place


def _table(rows: list[tuple], schema: str):
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [pa.field(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], pa.schema(fields))


def _send_keys(buckets: int):
    def run(left, right):
        import numpy as np

        block = left.column("block")[0].as_py()
        keys = np.unique(_Block(left, right, buckets).code)
        bucket = (keys >> np.uint64(40)).astype(np.int64)
        low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(keys) else [0]
        rows = [(block, int(bucket[a]), low[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return _table(rows, "block bigint, bucket bigint, data binary")

    return run


def _find_keys(got):
    """One bit per sent key of a bucket: whether another block sent it too."""
    import numpy as np

    if not got.num_rows:
        return _table([], _SIDE)
    sent = [np.frombuffer(d, np.uint8).reshape(-1, 5) for d in got.column("data").to_pylist()]
    ends = np.cumsum([len(s) for s in sent])
    keys = np.zeros((int(ends[-1]), 8), np.uint8)
    keys[:, :5] = np.concatenate(sent)
    keys = keys.view("<u8").ravel()
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    both = np.zeros(len(keys), bool)
    both[order[1:]] |= same
    both[order[:-1]] |= same
    bucket, rows = got.column("bucket")[0].as_py(), []
    for block, end, part in zip(got.column("block").to_pylist(), ends.tolist(), sent, strict=True):
        mine = both[end - len(part): end]
        if mine.any():
            rows.append((block, bucket, _BITS, np.packbits(mine).tobytes()))
    return _table(rows, _SIDE)


def _send_contexts(buckets: int):
    def run(left, right):
        import numpy as np
        import zstandard

        block = left.column("block")[0].as_py()
        docs = _Block(left, right, buckets)
        use, which, texts, code, bucket, order, _ = docs.contexts(right)
        ids = docs.order[np.array(docs.cut, np.int64)][docs.doc[use]] if len(use) else np.zeros(0, np.int64)
        low, high = np.full(len(texts), LAST), np.full(len(texts), -LAST - 1)
        np.minimum.at(low, which, ids)
        np.maximum.at(high, which, ids)
        lengths = np.array([len(t) for t in texts], np.uint8)
        pack = zstandard.ZstdCompressor(level=1)
        edges = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True]) if len(texts) else [0]
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            mine = order[a:b]
            head = [np.array([b - a], np.int64), low[mine], high[mine], code[mine], lengths[mine]]
            raw = b"".join(x.tobytes() for x in head) + b"".join(texts[i] for i in mine.tolist())
            rows.append((block, int(bucket[order[a]]), pack.compress(raw)))
        return _table(rows, "block bigint, bucket bigint, data binary")

    return run


def prefix_intervals(common, least: int) -> list[tuple[int, int, int]]:
    """Intervals (first, last, length) of neighbours with common prefixes of ``least`` or more.

    ``common[i]`` is the common prefix of the sorted suffixes i and i + 1. A stack holds the open
    intervals; one closes where the common prefix falls below its length, inner ones first.
    """
    import numpy as np

    found: list[tuple[int, int, int]] = []
    long = np.flatnonzero(common >= least)
    if not len(long):
        return found
    cuts = np.flatnonzero(np.diff(long) > 1)
    begins, ends = long[np.r_[0, cuts + 1]].tolist(), long[np.r_[cuts, len(long) - 1]].tolist()
    alone = [b == e for b, e in zip(begins, ends, strict=True)]
    values = common.tolist()
    for begin, end, pair in zip(begins, ends, alone, strict=True):
        if pair:
            found.append((begin, begin + 1, values[begin]))
            continue
        lengths, firsts = [], []
        for at in range(begin, end + 2):
            now = values[at] if at <= end else 0
            first = at
            while lengths and lengths[-1] > now:
                first = firsts.pop()
                found.append((first, at, lengths.pop()))
            if now and (not lengths or lengths[-1] < now):
                lengths.append(now)
                firsts.append(first)
    return found


def repeat_groups(raw: bytes, offsets, lengths, low, high):
    """Maximal repeats among texts that lie in ``raw``: (text, start, length, smallest id) of every occurrence.

    ``low`` and ``high`` are the smallest and largest document id that have the text. Groups whose occurrences
    all belong to one document are left out.
    """
    import numpy as np

    windows = lengths - LENGTH + 1
    text = np.repeat(np.arange(len(lengths)), windows)
    at = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    left_over = lengths[text] - at
    padded = np.frombuffer(raw + bytes(PIECE), np.uint8)
    width = -(-PIECE // 8) * 8
    keys = np.zeros((len(text), width), np.uint8)
    keys[:, :PIECE] = np.lib.stride_tricks.sliding_window_view(padded, PIECE)[offsets[text] + at]
    keys[np.arange(width)[None, :] >= left_over[:, None]] = 0
    words = keys.view(">u8")
    suffixes = np.lexsort([words[:, i].astype(np.uint64) for i in range(words.shape[1] - 1, -1, -1)])
    ordered = keys[suffixes]
    differ = ordered[1:] != ordered[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rest = left_over[suffixes]
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    own, place = text[suffixes], at[suffixes]
    # 256 stands for a piece's start: what is to its left is not known here
    before = np.where(place == 0, 256, padded[np.maximum(offsets[own] + place - 1, 0)].astype(np.int64))
    inner = np.array(prefix_intervals(common, LENGTH), np.int64).reshape(-1, 3)
    # a text of several documents is a repeat by itself
    alone = np.flatnonzero((place == 0) & (low[own] < high[own]))
    first, last = np.r_[inner[:, 0], alone], np.r_[inner[:, 1], alone]
    length = np.r_[inner[:, 2], rest[alone]]
    if not len(first):
        return (np.zeros(0, np.int64),) * 4
    bounds = np.c_[first, last + 1].ravel()

    def over(values, fold):
        return fold.reduceat(np.r_[values, values[-1]], bounds)[::2]

    smallest, largest = over(low[own], np.minimum), over(high[own], np.maximum)
    side, other = over(before, np.minimum), over(before, np.maximum)
    keep = (smallest < largest) & ((other == 256) | (side != other))
    first, last, length, smallest = first[keep], last[keep], length[keep], smallest[keep]
    sizes = last - first + 1
    group = np.repeat(np.arange(len(first)), sizes)
    spot = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[group]
    return own[spot], place[spot], length[group], smallest[group]


def _find_groups(got):
    """Repeat groups of a bucket, told to each block by the place of its context."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    if not got.num_rows:
        return _table([], _SIDE)
    unpack = zstandard.ZstdDecompressor()
    lows, highs, codes, places, blocks, texts = [], [], [], [], [], []
    names = got.column("block").to_pylist()
    for number, data in enumerate(got.column("data").to_pylist()):
        raw = unpack.decompress(data)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        lows.append(np.frombuffer(raw, np.int64, n, 8))
        highs.append(np.frombuffer(raw, np.int64, n, 8 + 8 * n))
        codes.append(np.frombuffer(raw, np.uint64, n, 8 + 16 * n))
        size = np.frombuffer(raw, np.uint8, n, 8 + 24 * n).astype(np.int32)
        starts = np.r_[np.int32(0), np.cumsum(size, dtype=np.int32)].astype(np.int32)
        texts.append(pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(raw[8 + 25 * n:])]))
        places.append(np.arange(n))
        blocks.append(np.full(n, number))
    low, high, code = np.concatenate(lows), np.concatenate(highs), np.concatenate(codes)
    place, block = np.concatenate(places), np.concatenate(blocks)
    known = pa.concat_arrays(texts).dictionary_encode()
    variant = known.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    count = len(known.dictionary)
    v_low, v_high, v_code = np.full(count, LAST), np.full(count, -LAST - 1), np.zeros(count, np.uint64)
    np.minimum.at(v_low, variant, low)
    np.maximum.at(v_high, variant, high)
    v_code[variant] = code
    # texts of one key stay together; so many keys at a time as make a bounded array
    order = np.argsort(v_code, kind="stable")
    values = known.dictionary.to_pylist()
    sizes = np.array([len(values[i]) for i in order.tolist()], np.int64)
    total = np.cumsum(sizes - LENGTH + 1)
    first = np.flatnonzero(np.r_[True, v_code[order][1:] != v_code[order][:-1]])
    found = []
    begin = 0
    while begin < count:
        full = np.searchsorted(total, (total[begin - 1] if begin else 0) + SUFFIXES, "right")
        next_key = first[np.searchsorted(first, max(full, begin + 1), "right") - 1]
        end = next_key if next_key > begin else next(iter(first[first > begin].tolist()), count)
        if full >= count:
            end = count
        mine = order[begin:end]
        length = sizes[begin:end]
        t, x, n, s = repeat_groups(
            b"".join(values[i] for i in mine.tolist()), np.cumsum(length) - length, length, v_low[mine], v_high[mine]
        )
        found.append((mine[t], x, n, s))
        begin = end
    t, x, n, s = (np.concatenate(c) for c in zip(*found, strict=True))
    by = np.argsort(t, kind="stable")
    t, x, n, s = t[by], x[by], n[by], s[by]
    begins, counts = np.searchsorted(t, np.arange(count)), np.bincount(t, minlength=count)
    each = counts[variant]
    source = np.repeat(np.arange(len(variant)), each)
    piece = np.arange(len(source)) - np.repeat(np.cumsum(each) - each, each) + begins[variant][source]
    wanted = high[source] > s[piece]
    source, piece = source[wanted], piece[wanted]
    bucket, rows = got.column("bucket")[0].as_py(), []
    edges = np.searchsorted(block[source], np.arange(len(names) + 1))
    for number, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if a < b:
            part, p = place[source[a:b]].astype(np.int32), piece[a:b]
            data = part.tobytes() + s[p].tobytes() + x[p].astype(np.uint8).tobytes() + n[p].astype(np.uint8).tobytes()
            rows.append((names[number], bucket, _GROUPS, data))
    return _table(rows, _SIDE)


def _cut(buckets: int):
    def run(left, right):
        import numpy as np
        import pyarrow as pa

        docs = _Block(left, right, buckets)
        use, which, texts, _, bucket, order, place = docs.contexts(right)
        edge = np.zeros(len(docs.text) + 1, np.int64)
        sorted_bucket = bucket[order]
        ids = docs.order[np.array(docs.cut, np.int64)][docs.doc[use]] if len(use) else np.zeros(0, np.int64)
        by = np.argsort(which, kind="stable")
        held = np.searchsorted(which[by], np.arange(len(texts) + 1))
        for b, k, data in zip(*(right.column(n).to_pylist() for n in ("bucket", "kind", "data")), strict=True):
            if k != _GROUPS:
                continue
            n = len(data) // 14
            part = np.frombuffer(data, np.int32, n).astype(np.int64)
            least = np.frombuffer(data, np.int64, n, 4 * n)
            at = np.frombuffer(data, np.uint8, n, 12 * n).astype(np.int64)
            length = np.frombuffer(data, np.uint8, n, 13 * n).astype(np.int64)
            context = order[np.searchsorted(sorted_bucket, b) + part]
            each = held[context + 1] - held[context]
            group = np.repeat(np.arange(n), each)
            piece = by[np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each) + held[context][group]]
            later = ids[piece] > least[group]
            piece, group = piece[later], group[later]
            begin = docs.start[use[piece]] + at[group]
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + length[group], -1)
        gone = np.cumsum(edge[:-1]) > 0
        cut_at = {i: n for n, i in enumerate(docs.cut)}
        spans, kept = [], []
        for i, body in enumerate(docs.bodies):
            if docs.copy[i] and len(body) >= LENGTH:
                spans.append([{"start": 0, "end": len(body)}])
                kept.append(b"")
            elif i in cut_at:
                a, b = docs.begins[cut_at[i]], docs.ends[cut_at[i]]
                mine = gone[a:b]
                turn = np.flatnonzero(np.diff(np.r_[False, mine, False].astype(np.int8))).reshape(-1, 2)
                spans.append([{"start": s, "end": e} for s, e in turn.tolist()])
                kept.append(docs.text[a:b][~mine].tobytes() if len(turn) else body)
            else:
                spans.append([])
                kept.append(body)
        return pa.table([
            docs.id_array.take(pa.array(docs.rows, pa.int64())), pa.array([len(x) for x in docs.bodies], pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
        ], ["id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, spans (removed runs, byte offsets), kept (the other bytes).

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id; all strings
    are judged on the input. Null texts are empty; empty and short texts have no spans. A null
    id counts as the largest; rows with equal ids are no smaller than one another. Ids must be integers.
    """
    rows = pick(docs, id=id_col, text=text_col).select(
        "id", F.coalesce(F.col("id").cast("bigint"), F.lit(LAST)).alias("place"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"),
    )
    id_type = rows.schema["id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks, buckets = max(1, -(-total // BLOCK)), max(1, -(-total // BUCKET))
    keyed = rows.withColumn("digest", F.unhex(F.sha2("body", 256))).withColumn(
        "block", F.pmod(F.xxhash64("place", "digest"), F.lit(blocks))
    )
    narrow = stage(keyed.select("block", "place", "digest"), "repeat-digests")
    first = narrow.groupBy("digest").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    copies = stage(
        narrow.join(first, "digest").where("place > first").select(
            "block", F.col("place").alias("bucket"), F.lit(_COPY).alias("kind"), F.col("digest").alias("data")
        ).distinct(), "repeat-copies",
    )
    texts = keyed.select("block", "id", "place", "digest", "body").repartition("block")

    def with_texts(side: DataFrame, function, schema: str) -> DataFrame:
        return texts.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(function, schema)

    sent = "block bigint, bucket bigint, data binary"
    bits = (
        with_texts(copies, _send_keys(buckets), sent).groupBy("bucket").applyInArrow(_find_keys, _SIDE).repartition("block")
    )
    known = copies.union(bits)
    groups = with_texts(known, _send_contexts(buckets), sent).groupBy("bucket").applyInArrow(_find_groups, _SIDE)
    return with_texts(
        known.union(groups), _cut(buckets),
        f"id {id_type}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )


@query("op3_repeats")
def op3(spark: SparkSession, root: str) -> DataFrame:
    """Every document's size, removed bytes and runs, and the digest of what is left."""
    runs = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(table(spark, root, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", runs.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
