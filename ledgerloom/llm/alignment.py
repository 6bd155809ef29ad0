"""Cross-tokenizer alignment by coalescing intervals.

Both tokenizers cut the same bytes into intervals. All intervals of a batch lie one after another on one line;
they are sorted by start (lexsort), and the running maximum of their ends (``maximum.accumulate``) tells where
a start reaches it: there a group ends. Within a group every token of one side links to every token of the other.
No token of either vocabulary reaches over a single space between two other characters, so a text is cut there,
each distinct part of a batch is tokenised and coalesced once, and a document joins the answers of its parts.

How many documents hold a pair of ids linked is counted over all documents. At most ``FREQUENT`` of the commonest
pairs, whose number is bounded whatever the corpus, go to every task; the others meet their counts in a join.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import frequent, pick, query, spans, table
from ledgerloom.sources.staging import stage

#: Public vocabularies; any paths of the same kinds can be given.
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs of ids that every task gets.
FREQUENT = 1 << 18
#: Characters of text in a batch, of its texts whose links are listed at a time, and of the distinct parts that are tokenised as one text.
BATCH, ROWS, JOINED = 2_500_000, 500_000, 50_000
#: Links of a group up to which they are listed singly; beyond it distinct pairs are counted instead.
LISTED = 4096
_MARK = "▁"
_CUT = re.compile(r"(?<=\S)(?= \S)")
_ODD = re.compile(r" \s|[^\S ] ")


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + at): b for at, b in enumerate(hidden)}


class Pair:
    """Two loaded tokenizers and the bytes of each of their ids."""

    def __init__(self, byte_model: str, piece_model: str) -> None:
        import os

        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_model)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # a piece that holds a space after another character would reach over a cut
        self.cuts = not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces)

    def parts(self, text: str) -> list[str]:
        """Parts that, each with a space before it, join to space + text, and that no token reaches over."""
        if not self.cuts:
            return [text]
        if _ODD.search(text) or text[0].isspace() or text[-1].isspace():
            return [p[1:] for p in _CUT.split(" " + text)]
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of each text with a space before it, by both sides, and whether both give its bytes back."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        good = [
            b"".join(map(a_bytes, x)) == (" " + t).encode() == b"".join(map(b_bytes, y)) for x, y, t in zip(a, b, texts, strict=True)
        ]
        return a, b, good

    def encode_parts(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]], list[list[int]], list[int]]:
        """(ids of a, ids of b, numbers of the parts) by texts, and the parts whose bytes are not given back.

        Parts without white space at their ends are tokenised side by side in long texts, for no token
        reaches over a cut; where such a text is not given back, its parts are tokenised one by one.
        """
        texts, numbers, single, chars = [], [], [], JOINED
        for at, part in enumerate(parts):
            if not self.cuts or part[:1].isspace() or part[-1:].isspace() or not part:
                single.append(at)
                continue
            if chars >= JOINED:
                numbers.append([])
                chars = 0
            numbers[-1].append(at)
            chars += len(part)
        texts = [" ".join([parts[at] for at in held]) for held in numbers]
        a, b, good = self.encode(texts)
        single += [at for held, g in zip(numbers, good, strict=True) if not g for at in held]
        a1, b1, good1 = self.encode([parts[at] for at in single])
        bad = [at for at, g in zip(single, good1, strict=True) if not g]
        whole = [(x, y, n) for x, y, n, g in zip(a, b, numbers, good, strict=True) if g]
        whole += [(x, y, [n]) for x, y, n, g in zip(a1, b1, single, good1, strict=True) if g]
        return [w[0] for w in whole], [w[1] for w in whole], [w[2] for w in whole], bad


@lru_cache(maxsize=2)
def load(byte_model: str, piece_model: str) -> Pair:
    return Pair(byte_model, piece_model)


def coalesce(starts, ends):
    """Order of intervals by start, and for each in that order whether a group begins with it."""
    import numpy as np

    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    return order, np.r_[True, starts[order][1:] >= reached[:-1]][: len(order)]


@dataclass
class Parts:
    """Alignments of distinct parts by number: sizes, groups as text, and a run of (pair, links) for each."""

    n_a: object
    n_b: object
    n_groups: object
    n_links: object
    groups: list[str]
    pairs: object
    links: object
    ends: object


def align_parts(a_ids: list, b_ids: list, numbers: list, sizes, a_size, b_size) -> Parts:
    """Groups and linked pairs of every part.

    ``numbers``: the parts of each tokenised text in order; ``sizes``: bytes of all parts, 0 for one that is in no text;
    ``a_size`` and ``b_size``: bytes of the ids. A pair is a's id * 2**32 + b's id.
    """
    import numpy as np

    order = np.array([n for held in numbers for n in held], np.int64)
    stops = np.cumsum(sizes[order])
    sides, tokens = [], []
    for ids, size in ((a_ids, a_size), (b_ids, b_size)):
        flat = np.fromiter((i for x in ids for i in x), np.int64, sum(map(len, ids)))
        ends = np.cumsum(size[flat])
        sides.append((flat, ends - size[flat], ends))
        held = np.zeros(len(sizes), np.int64)
        held[order] = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
        tokens.append(held)
    (a, a_from, a_to), (b, b_from, b_to) = sides
    sort, first = coalesce(np.r_[a_from, b_from], np.r_[a_to, b_to])
    group = np.empty(len(sort), np.int64)
    group[sort] = np.cumsum(first) - 1
    ga, gb, count = group[: len(a)], group[len(a):], int(first.sum())
    in_a, in_b = np.bincount(ga, minlength=count), np.bincount(gb, minlength=count)
    from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    # every part ends with the end of a group
    last = np.searchsorted(a_to[from_a + in_a - 1], stops, "right") if count else np.zeros(0, np.int64)
    n_groups, n_links = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    n_groups[order] = np.diff(last, prepend=0)
    links = in_a * in_b
    n_links[order] = np.diff(np.r_[0, np.cumsum(links)][last], prepend=0)

    # listed links: the token of side a is repeated for each token of side b in its group
    n = np.where(links <= LISTED, links, 0)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(in_b, n)
    pairs = (a[np.repeat(from_a, n) + at // wide] << 32) | b[np.repeat(from_b, n) + at % wide]
    owner = np.repeat(np.repeat(order, n_groups[order]), n)
    weight = np.ones(len(pairs), np.int64)
    for g in np.flatnonzero(links > LISTED):
        ua, ca = np.unique(a[from_a[g]: from_a[g] + in_a[g]], return_counts=True)
        ub, cb = np.unique(b[from_b[g]: from_b[g] + in_b[g]], return_counts=True)
        pairs, weight = np.r_[pairs, ((ua << 32)[:, None] | ub).ravel()], np.r_[weight, (ca[:, None] * cb).ravel()]
        owner = np.r_[owner, np.full(len(ua) * len(ub), order[np.searchsorted(last, g, "right")])]
    by_part = np.argsort(owner, kind="stable")

    words_a, words_b = [f"{i}" for i in a.tolist()], [f"{i}" for i in b.tolist()]
    shown = [
        f"{words_a[i]}|{words_b[j]}" if k == m == 1 else f"{','.join(words_a[i: i + k])}|{','.join(words_b[j: j + m])}"
        for i, k, j, m in zip(from_a.tolist(), in_a.tolist(), from_b.tolist(), in_b.tolist(), strict=True)
    ]
    groups = [""] * len(sizes)
    start = 0
    for part, end in zip(order.tolist(), last.tolist(), strict=True):
        groups[part] = shown[start] if end == start + 1 else ";".join(shown[start:end])
        start = end
    return Parts(
        *tokens, n_groups, n_links, groups, pairs[by_part], weight[by_part], np.cumsum(np.bincount(owner, minlength=len(sizes)))
    )


@dataclass
class Aligned:
    """Distinct parts of some texts, and the texts as runs of their numbers: ``at[stops[i]: stops[i + 1]]`` are those of text i."""

    parts: Parts
    values: object
    rank: object
    at: object
    stops: object

    @classmethod
    def of(cls, pair: Pair, texts: list[str | None]) -> Aligned:
        """Each distinct part is tokenised and aligned once."""
        import numpy as np

        place: dict[str, int] = defaultdict()
        place.default_factory = place.__len__
        held, counts = [], []
        for text in texts:
            found = pair.parts(text) if text else []
            held.append(np.fromiter((place[p] for p in found), np.int32, len(found)))
            counts.append(len(found))
        at = np.concatenate([*held, np.zeros(0, np.int32)])
        del held
        # a dictionary whose factory is its own method is a cycle, which would be held until a full collection
        place.default_factory = None
        distinct = list(place)
        del place
        a, b, numbers, bad = pair.encode_parts(distinct)
        sizes = np.array([len(p.encode()) + 1 for p in distinct], np.int64)
        del distinct
        sizes[bad] = 0
        parts = align_parts(a, b, numbers, sizes, pair.a_size, pair.b_size)
        del a, b, numbers
        stops = np.cumsum([0, *counts])
        # texts with a part that is not given back have no tokens
        lost = np.zeros(len(sizes), np.int64)
        lost[bad] = 1
        kept = np.diff(np.r_[0, np.cumsum(lost[at])][stops]) == 0
        own = np.repeat(np.arange(len(texts)), np.diff(stops))
        at, own = at[kept[own]], own[kept[own]]
        values, rank = np.unique(parts.pairs, return_inverse=True)
        return cls(parts, values, rank, at, np.searchsorted(own, np.arange(len(texts) + 1)))

    def rows(self, start: int, end: int) -> tuple:
        """What ``align_texts`` gives, of the texts ``start`` to ``end``."""
        import numpy as np

        parts, values = self.parts, self.values
        stops = self.stops[start: end + 1] - self.stops[start]
        at = self.at[self.stops[start]: self.stops[end]]
        own = np.repeat(np.arange(end - start), np.diff(stops))
        numbers = np.stack([
            np.diff(np.r_[0, np.cumsum(x[at])][stops]) for x in (parts.n_a, parts.n_b, parts.n_groups, parts.n_links)
        ], axis=1)
        spelled = list(map(parts.groups.__getitem__, at.tolist()))
        shown = [";".join(spelled[i:j]) for i, j in itertools.pairwise(stops.tolist())]

        begins = np.r_[0, parts.ends[:-1]]
        n = (parts.ends - begins)[at]
        where = np.arange(n.sum()) + np.repeat(begins[at] - (np.cumsum(n) - n), n)
        codes = np.repeat(own, n) * max(len(values), 1) + self.rank[where]
        order = np.argsort(codes, kind="stable")
        held, starts = np.unique(codes[order], return_index=True)
        links = np.add.reduceat(parts.links[where][order], starts) if len(held) else np.zeros(0, np.int64)
        ends = np.searchsorted(held, np.arange(1, end - start + 1) * max(len(values), 1))
        return numbers, shown, values[held % len(values)] if len(held) else held, links, ends


def align_texts(pair: Pair, texts: list[str | None]) -> tuple:
    """Of each text n_a, n_b, n_groups, n_links (a matrix) and the groups; the pairs, their links, and where a text's pairs end."""
    return Aligned.of(pair, texts).rows(0, len(texts))


def runs(column, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of an Arrow column that begin in the same ``most`` characters; no text is copied."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // most, prepend=-1)).tolist()
    yield from itertools.pairwise([*starts, *([len(sizes)] if starts else [])])


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL,
          piece_model: str = PIECE_MODEL, keep_groups: bool = True) -> DataFrame:
    """One row per input row: row, id, n_a, n_b, n_groups, n_links, groups, groups_sha256, pairs, links.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (null unless ``keep_groups``), ``pairs`` the distinct linked ids as
    a * 2**32 + b in order, ``links`` how many links each has. Null and empty texts, and texts that
    either vocabulary does not give back byte by byte, have no tokens: zeros, empty lists, ''. Repeated ids and rows stay
    rows of their own; other columns, whatever their names, are ignored. A text of any length is
    tokenised whole; a part without a space is one piece of work, and a group lists its distinct pairs only.
    """
    rows = pick(docs, id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        pair = load(byte_model, piece_model)
        for batch in batches:
            column = batch.column("text")
            for first, last in runs(column, BATCH):
                texts = column.slice(first, last - first).to_pylist()
                aligned = Aligned.of(pair, texts)
                # links of all occurrences are listed for a few texts at a time
                for start, end in spans(texts, ROWS):
                    numbers, shown, pairs, links, ends = aligned.rows(start, end)
                    ends = pa.array(np.r_[0, ends].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("row").slice(first + start, end - start), batch.column("id").slice(first + start, end - start),
                        *(pa.array(numbers[:, at]) for at in range(4)),
                        pa.array([s if keep_groups else None for s in shown], pa.string()),
                        pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown]),
                        *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (pairs, links)),
                    ], ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs", "links"])
                    del numbers, shown, pairs, links, ends
                del aligned, texts
                pa.default_memory_pool().release_unused()

    return rows.mapInArrow(
        run, f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
        "groups_sha256 string, pairs array<bigint>, links array<bigint>"
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best) from rows of ``align``: documents that hold the pair linked, and whether no pair of its a has more.

    The largest count of each a id is a table of at most the vocabulary's size.
    """
    counts = stage(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts"
    )
    a = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), F.shiftright("pair", 32) == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def link_scores(aligned: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The rows of a staged ``align`` with n_best and count_sum beside their numbers.

    ``n_best``: links whose pair no other pair of its a id surpasses in documents; ``count_sum``: sum of the links'
    counts. An empty table gives an empty result.
    """
    import numpy as np

    spark = aligned.sparkSession
    high, low = frequent(pair_counts(aligned), most)
    known = high.orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(tuple(known.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pair, n, best = shared.value
        for batch in batches:
            ends = batch.column("pairs").offsets.to_numpy()
            pairs, links = (batch.column(c).values.to_numpy() for c in ("pairs", "links"))
            at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            held = np.where(hit, links, 0)
            sums = [np.r_[0, np.cumsum(x)] for x in (held * best[at], held * n[at])] if len(pair) else [np.zeros(len(pairs) + 1, np.int64)] * 2
            rest = np.r_[0, np.cumsum(~hit)].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(rest[ends]), pa.array(x[~hit])) for x in (pairs, links)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(np.diff(s[ends]).astype(np.int64)) for s in sums), *lists],
                ["row", "n_best", "count_sum", "pairs", "links"],
            )

    partial = stage(aligned.select("row", "pairs", "links").mapInArrow(
        run, "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, links array<bigint>"
    ), "link-sums")
    rest = partial.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links")
    )
    more = rest.join(low, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("n")).alias("more_sum"),
    )
    sums = partial.select("row", "n_best", "count_sum").join(more, "row", "left").select(
        "row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
    return aligned.drop("pairs", "links").join(sums, "row")


@query("op11_cross_tokenizer")
def op11(spark: SparkSession, root: str) -> DataFrame:
    """Every document's aligned groups of two public tokenizers, and how common its links are in the corpus."""
    aligned = stage(align(table(spark, root, "documents"), keep_groups=False), "aligned")
    return link_scores(aligned).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
