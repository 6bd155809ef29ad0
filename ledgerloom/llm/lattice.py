"""SentencePiece encoding and decoding by a relational lattice.

Every substring of a word up to the longest piece's length is a row; an equi-join with the piece table
turns substrings into edges; the edges of a word are grouped, and a higher-order fold over them in order of
their end keeps the best path to every position (Viterbi). Words repeat across documents, so blocks of
documents send their distinct words, each distinct word of the corpus is encoded once, and its ids go
back to the blocks that have it. Words over ``LONGEST_WORD`` characters would be rows times their own length;
they are folded whole, position by position, with the scores of the last longest piece carried along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut_parts, pick, query, table

#: A public piece model; any path can be given.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A word: an optional space and a run of letters and digits, or of other characters, or one white-space
#: character. Runs of any length are whole. Where a piece reaches over a word's end, the words are one.
_WORD = re.compile(r" ?(?:\w+|[^\w\s]+)|\s")
#: Texts that may not be cut at every space, for Arrow: those with two white spaces of which one is a space, or one at an end.
_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SPACES = rf" {_SPACE}|{_SPACE} |\A{_SPACE}|{_SPACE}\z"
#: For Arrow: some of the letters and digits of ``\w``, and the same with one sign at the end.
_LETTERS = r"\A[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+\z"
_LETTERS_SIGN = _LETTERS[:-2] + r"[!-/:-@\[-\^`{-~]\z"
#: Longest word in characters whose substrings become rows.
LONGEST_WORD = 64
#: Characters of text in a block; buckets of words up to so many, then one for so many blocks.
BLOCK = 32_000_000
BUCKETS = 32
BLOCKS_IN_BUCKET = 16
#: Partitions of words for each bucket, so that a task's edges stay in memory.
PARTITIONS = 16
#: Words of a block that are numbered by how often they occur; words of texts whose ids are put together at a time.
COMMON = 1 << 16
SLICE = 1_000_000
#: What a character without a piece costs beyond the least piece.
UNKNOWN_COST = 10.0
#: Compression of what is shuffled.
LEVEL = 8
_MARK = "▁"


@dataclass(frozen=True)
class Pieces:
    """Scored pieces (the word mark is a space) and the ids of the 256 bytes."""

    rows: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]

    def __post_init__(self) -> None:
        if list(self.byte_ids) != list(range(self.byte_ids[0], self.byte_ids[0] + 256)):
            raise ValueError("the pieces of the 256 bytes must have ids in a row")

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.rows), default=1)

    @property
    def width(self) -> int:
        """Bytes of an id."""
        return 2 if max([i for _, i, _ in self.rows] + list(self.byte_ids), default=0) < 1 << 16 else 4

    @property
    def unknown(self) -> float:
        return min((s for _, _, s in self.rows), default=0.0) - UNKNOWN_COST


def read_pieces(path: str = MODEL) -> Pieces:
    """The piece table of a model file; control, unknown and unused pieces are left out, as are unreachable scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows, codes = [], {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            codes[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e8:
            rows.append((piece.replace(_MARK, " "), i, float(model.get_score(i))))
    return Pieces(tuple(rows), tuple(codes[b] for b in range(256)))


def split_words(text: str | None) -> list[str]:
    """Words of a text after a leading space is added; they join to exactly that. Empty and null texts have none."""
    return _WORD.findall(" " + text) if text else []


class Words:
    """Words of a text that no piece reaches over: those of ``split_words``, joined where a piece spans them."""

    def __init__(self, pieces: Pieces) -> None:
        spanning = [(p, _WORD.findall(p)) for p, _, _ in pieces.rows]
        self.spanning = {p for p, words in spanning if len(words) > 1}
        self.longest = max(map(len, self.spanning), default=0)
        # a piece that holds a space after another character would reach over a cut
        self.cuts = not any(re.search("[^ ] ", p) for p, _, _ in pieces.rows)
        # the two characters at each inner end, and characters of which every spanning piece has one
        self.ends = {p[at - 1: at + 1] for p, words in spanning for at in accumulate(map(len, words[:-1]))}
        self.marks: list[str] = []
        left = set(self.spanning)
        while left:
            counts = Counter(c for p in left for c in set(p))
            self.marks.append(min(counts, key=lambda c: (-counts[c], c)))
            left = {p for p in left if self.marks[-1] not in p}

    def parts(self, text: str | None) -> list[str]:
        """Parts whose words are the words of the text, as no piece reaches over a cut."""
        if not text:
            return []
        return cut_parts(text) if self.cuts else [text]

    def __call__(self, text: str | None) -> list[str]:
        words = split_words(text)
        if not text or not any(m in text for m in self.marks):
            return words
        text, out, end = " " + text, [], 0
        for word in words:
            if out and text[end - 1: end + 1] in self.ends and self._spanned(text, end):
                out[-1].append(word)
            else:
                out.append([word])
            end += len(word)
        return ["".join(w) for w in out]

    def _spanned(self, text: str, end: int) -> bool:
        return any(
            text[start:stop] in self.spanning
            for start in range(max(0, end - self.longest + 1), end) for stop in range(end + 1, min(len(text), start + self.longest) + 1)
        )


def best_path(word: str, known: dict[str, tuple[float, bytes]], pieces: Pieces, longest: int, unknown: float) -> bytes:
    """The code that ``encode_words`` gives a word, by one pass in time and memory that grow with its length."""
    width, scores, back = pieces.width, [0.0], [0]
    for stop in range(1, len(word) + 1):
        best, begin = float("-inf"), stop - 1
        # longest pieces first: of equal scores the first stays
        for start in range(max(0, stop - longest), stop):
            found = known.get(word[start:stop])
            if found is not None:
                score = scores[start - stop] + found[0]
            elif start == stop - 1:
                score = scores[-1] + unknown
            else:
                continue
            if score > best:
                best, begin = score, start
        back.append(begin)
        scores.append(best)
        if len(scores) > longest:
            del scores[0]
    parts, stop = [], len(word)
    while stop:
        part = word[back[stop]:stop]
        found = known.get(part)
        parts.append(found[1] if found is not None else b"".join(
            pieces.byte_ids[b].to_bytes(width, "little") for b in part.encode("utf-8", "replace")
        ))
        stop = back[stop]
    return b"".join(reversed(parts))


def encode_words(words: DataFrame, pieces: Pieces, partitions: int | None = None, *keep: str) -> DataFrame:
    """(word, code) for rows of distinct words: the ids of the best path, ``pieces.width`` bytes each; columns to keep come first.

    A path's score is the sum of its pieces' scores. Of equal scores the path whose last piece is longest
    wins, at every position. A character without a piece of its own is its UTF-8 bytes' pieces at
    ``UNKNOWN_COST`` below the least score, and so is the word mark where the text itself holds it.
    """
    spark = words.sparkSession

    width = pieces.width
    import pyarrow as pa

    # as large as the model file
    vocabulary = F.broadcast(spark.createDataFrame(pa.table({
        "part": pa.array([p for p, _, _ in pieces.rows], pa.string()),
        "code": pa.array([i.to_bytes(width, "little") for _, i, _ in pieces.rows], pa.binary()),
        "score": pa.array([s for _, _, s in pieces.rows], pa.float64()),
    })))
    length = F.char_length("word")
    # no piece is longer than the longest one that begins with the same three characters
    reach: dict[str, int] = {}
    for piece, _, _ in pieces.rows:
        if len(piece) > 2:
            reach[piece[:3]] = max(reach.get(piece[:3], 2), len(piece))
    reaches = F.broadcast(spark.createDataFrame(pa.table({
        "three": pa.array(list(reach), pa.string()), "reach": pa.array(list(reach.values()), pa.int32()),
    })))
    parts = (
        (words.select(*keep, "word").repartition(partitions, "word") if partitions else words.select(*keep, "word").repartition("word"))
        .withColumn("start", F.explode(F.sequence(F.lit(0), length - 1)))
        .withColumn("three", F.substring("word", F.col("start") + 1, F.lit(3))).join(reaches, "three", "left").drop("three")
        .withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.coalesce("reach", F.lit(2)), length - F.col("start"))))).drop("reach")
        .withColumn("part", F.substring("word", F.col("start") + 1, F.col("size")))
    )

    def byte_code(at):
        number = F.conv(F.substring(F.hex("part"), at * 2 + 1, F.lit(2)), 16, 10).cast("int") + pieces.byte_ids[0]
        little = [F.lpad(F.hex(F.shiftright(number, 8 * n).bitwiseAND(F.lit(255))), 2, "0") for n in range(width)]
        return F.concat(*little)

    spelled = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.octet_length("part") - 1), byte_code), ""))
    edges = (
        parts.join(vocabulary, "part", "left").where(F.col("code").isNotNull() | (F.col("size") == 1))
        .select(
            *keep, "word", (F.col("start") + F.col("size")).alias("stop"), "start",
            F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
            F.when(F.col("code").isNotNull(), F.col("code")).otherwise(spelled).alias("code"),
        )
    )
    grouped = edges.groupBy(*keep, "word").agg(F.sort_array(F.collect_list(F.struct("stop", "start", "score", "code"))).alias("edges"))

    def step(state, edge):
        # the best path to every earlier position, and the best one so far to the position at hand
        fresh = edge["stop"] > state["stop"]
        before = F.when(edge["start"] == state["stop"], state["best"]).otherwise(F.element_at(state["done"], edge["start"] + 1))
        path = F.struct(
            (before["score"] + edge["score"]).alias("score"), (-edge["start"]).alias("back"),
            F.concat(before["path"], edge["code"]).alias("path"),
        )
        return F.when(fresh, F.struct(
            F.concat(state["done"], F.array(state["best"])).alias("done"), edge["stop"].alias("stop"), path.alias("best")
        )).otherwise(F.struct(state["done"].alias("done"), state["stop"].alias("stop"), F.greatest(state["best"], path).alias("best")))

    path = "struct<score:double,back:int,path:binary>"
    none = F.struct(
        F.array().cast(f"array<{path}>").alias("done"), F.lit(0).alias("stop"),
        F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"), F.lit(bytearray()).alias("path")).alias("best"),
    ).cast(f"struct<done:array<{path}>,stop:int,best:{path}>")
    return grouped.select(*keep, "word", F.aggregate("edges", none, step)["best"]["path"].alias("code"))


def _batches(batches: Iterator, limit: int) -> Iterator[tuple]:
    """(ids, texts) as arrays of about ``limit`` bytes of text."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def joined(held: list) -> tuple:
        return pa.concat_arrays([b.column(0) for b in held]), pa.concat_arrays([b.column(1).cast(pa.string()) for b in held])

    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64) + 16)
        start, done = 0, 0
        while start < len(ends):
            stop = min(len(ends), int(np.searchsorted(ends, done + limit - size)) + 1)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - done
            start, done = stop, int(ends[stop - 1])
            if size >= limit:
                out, held, size = joined(held), [], 0
                yield out
                del out
    if held:
        yield joined(held)


def _block_of(ids, texts) -> int:
    """A number for a block that its rows decide."""
    import pyarrow.compute as pc
    import xxhash

    state = xxhash.xxh64(repr(ids.to_pylist()).encode())
    state.update(pc.fill_null(pc.binary_length(texts), -1).to_numpy().tobytes())
    state.update(_flat(texts)[0])
    return state.intdigest() - (1 << 63)


def _flat(array):
    """The bytes of an array of strings or binaries, and the size of each; nulls have none."""
    import numpy as np

    offsets = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, array.offset * 4)
    return np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]], np.diff(offsets).astype(np.int64)


def _packed(array) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays(array, [str(i) for i in range(len(array))])
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> list:
    import pyarrow as pa

    return [c.combine_chunks() for c in pa.ipc.open_stream(data).read_all().columns]


def _planes(numbers) -> bytes:
    """Numbers below 2 ** 32, byte by byte: first the lowest bytes of all, last the highest."""
    import numpy as np
    import pyarrow as pa

    return _packed([pa.array(np.ascontiguousarray(np.asarray(numbers).astype("<u4").view(np.uint8).reshape(-1, 4).T).reshape(-1))])


def _numbers(data: bytes):
    import numpy as np

    return np.ascontiguousarray(_unpacked(data)[0].to_numpy().reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


def _runs(starts, sizes):
    """The places of runs that begin at ``starts``, one after another."""
    import numpy as np

    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _slices(sizes) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``SLICE`` words in all, one text at least."""
    start = held = 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > SLICE:
            yield start, at
            start, held = at, 0
        held += size
    if len(sizes):
        yield start, len(sizes)


def _numbered_parts(texts, words_of: Words):
    """(order of the texts, parts of each of them, the parts' numbers, distinct parts)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # a text that is cut at every space is split by Arrow, any other by cut_parts; both give the same parts
    even = pc.and_(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False), words_of.cuts)
    even = pc.and_(even, pc.invert(pc.fill_null(pc.match_substring_regex(texts, _SPACES), True))).to_numpy(zero_copy_only=False)
    order = np.concatenate([np.flatnonzero(even), np.flatnonzero(~even)])
    split = pc.split_pattern(texts.filter(pa.array(even)), " ")
    rest = pa.array([words_of.parts(text) for text in texts.filter(pa.array(~even)).to_pylist()], pa.list_(pa.string()))
    sizes = np.concatenate([pc.list_value_length(a).to_numpy(zero_copy_only=False) for a in (split, rest)]).astype(np.int64)
    parts = pa.concat_arrays([split.flatten(), rest.flatten()]).dictionary_encode()
    return order, sizes, parts.indices.to_numpy(), parts.dictionary


def _numbered_words(parts, words_of: Words):
    """(words of each part, the words' numbers, distinct words, parts whose words do not join to them)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # letters and digits are one word; with a sign at the end they are two, unless a piece reaches over that place
    alone = pc.match_substring_regex(parts, _LETTERS).to_numpy(zero_copy_only=False)
    ends = pa.array(sorted(words_of.ends), pa.string())
    tailed = pc.and_(
        pc.match_substring_regex(parts, _LETTERS_SIGN), pc.invert(pc.is_in(pc.utf8_slice_codeunits(parts, -2), value_set=ends))
    ).to_numpy(zero_copy_only=False)
    one, two, other = np.flatnonzero(alone), np.flatnonzero(tailed), np.flatnonzero(~(alone | tailed))
    texts = parts.take(pa.array(other)).to_pylist()
    split = [words_of(part) for part in texts]
    both = parts.take(pa.array(two))

    def spaced(strings):
        return pc.binary_join_element_wise(pa.scalar(""), strings, " ")

    words = pa.concat_arrays([
        spaced(parts.take(pa.array(one))), spaced(pc.utf8_slice_codeunits(both, 0, -1)), pc.utf8_slice_codeunits(both, -1),
        pa.array([w for words in split for w in words], pa.string()),
    ]).dictionary_encode()
    numbers = words.indices.to_numpy().astype(np.int64)
    a, b, c = len(one), len(one) + len(two), len(one) + 2 * len(two)
    numbers = np.concatenate([numbers[:a], np.stack([numbers[a:b], numbers[b:c]], axis=1).reshape(-1), numbers[c:]])
    sizes = np.concatenate([np.ones(len(one), np.int64), np.full(len(two), 2), np.fromiter(map(len, split), np.int64, len(split))])
    order = np.concatenate([one, two, other])
    starts, of = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    starts[order], of[order] = np.cumsum(sizes) - sizes, sizes
    lost = other[[bool(text) and "".join(words) != " " + text for text, words in zip(texts, split, strict=True)]]
    return of, numbers[_runs(starts, of)], words.dictionary, lost


def _cut(texts, words_of: Words, buckets: int):
    """(order of the texts, their message, words of each bucket in order).

    The message numbers a block's words: the commonest by how often they occur, then all as they stand in the buckets, so that most
    numbers are small. It holds the places of the commonest, which texts have all their characters in words, words of each
    text, and the texts in slices.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    order, n_parts, text_parts, parts = _numbered_parts(texts, words_of)
    n_words, part_words, words, lost = _numbered_words(parts, words_of)
    bucket = np.fromiter((xxhash.xxh64_intdigest(w.encode()) % buckets for w in words.to_pylist()), np.int64, len(words))
    listed = pc.sort_indices(words).to_numpy().astype(np.int64)
    listed = listed[np.argsort(bucket[listed], kind="stable")]
    place = np.empty(len(words), np.int64)
    place[listed] = np.arange(len(words))
    often = np.repeat(np.bincount(text_parts, minlength=len(parts)), n_words)
    common = np.argsort(-np.bincount(part_words, weights=often, minlength=len(words)), kind="stable")[:COMMON]
    named = place + len(common)
    named[common] = np.arange(len(common))
    part_words = named[part_words]
    whole = np.ones(len(order), np.int64)
    if len(lost):
        whole[np.repeat(np.arange(len(order)), n_parts)[np.isin(text_parts, lost)]] = 0
    stops = np.cumsum(n_parts)
    ends = np.concatenate([[0], np.cumsum(n_words[text_parts])])[stops]
    per_text = np.diff(ends, prepend=0)
    message = [_planes(place[common]), _planes(whole), _planes(per_text)]
    starts, done = np.cumsum(n_words) - n_words, 0
    for _, end in _slices(per_text):
        part = text_parts[done: stops[end - 1]]
        done = stops[end - 1]
        message.append(_planes(part_words[_runs(starts[part], n_words[part])]))
    sizes = np.bincount(bucket, minlength=buckets)
    words = words.take(pa.array(listed))
    return order, message, [words[end - size: end] for end, size in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)]


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, n_tokens, exact) of every input row: piece ids, and whether decoding them gives the text.

    Null and empty texts have no ids. The whole text is encoded, white space included, whatever its length; repeated ids and
    rows stay rows of their own, and other columns are ignored. Texts are cut once: a block sends its distinct words to
    their buckets and its texts, as numbers of those words, to itself. Where Spark does not keep that shuffle for its three
    readers, the table must give its rows in the same order each time, as files and staged tables do.
    """
    rows = pick(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    buckets = min(blocks, max(BUCKETS, -(-blocks // BLOCKS_IN_BUCKET)))
    words_of = Words(pieces)
    width = pieces.width
    kind_of = "<u2" if width == 2 else "<u4"

    def cut(batches: Iterator) -> Iterator:
        """Rows of kind 0: words of a block, for a bucket; rows of kind 1: the texts of a block, as numbers of its words."""
        import pyarrow as pa

        for ids, texts in _batches(batches, BLOCK):
            block = _block_of(ids, texts)
            order, message, shares = _cut(texts, words_of, buckets)
            ids = ids.cast(id_arrow).take(pa.array(order))
            yield pa.RecordBatch.from_arrays([
                pa.array([1], pa.int32()), pa.array([block], pa.int64()), pa.array([block], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([message], pa.list_(pa.binary())),
            ], names)
            for n, words in enumerate(shares):
                if len(words):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([0], pa.int32()), pa.array([n], pa.int64()), pa.array([block], pa.int64()),
                        pa.nulls(1, pa.list_(id_arrow)), pa.array([[_packed([words])]], pa.list_(pa.binary())),
                    ], names)
            del ids, texts, message, shares
            pa.default_memory_pool().release_unused()

    def distinct_words(got):
        import pyarrow as pa
        import pyarrow.compute as pc

        if got.column("kind")[0].as_py():
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.string())], ["key", "word"])
        words = pa.concat_arrays([_unpacked(data[0])[0] for data in got.column("data").to_pylist()]).unique()
        # longer words are folded whole by answers()
        words = words.filter(pc.less_equal(pc.utf8_length(words), LONGEST_WORD))
        return pa.table([pa.repeat(got.column("key")[0], len(words)), words], ["key", "word"])

    spelled = {i: p.encode() for p, i, _ in pieces.rows} | {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}

    def decoded(words, codes):
        """Which words their codes decode to."""
        import numpy as np
        import pyarrow as pa

        known = np.array(sorted(spelled))
        data, sizes = _flat(codes)
        texts, lengths = _flat(words)
        ids = data.view(kind_of)
        spelling = pa.array([spelled[i] for i in known.tolist()], pa.binary()).take(pa.array(np.searchsorted(known, ids)))
        out, each = _flat(spelling)
        ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(sizes // width)]
        if np.array_equal(ends, np.cumsum(lengths)) and np.array_equal(out, texts):
            return np.ones(len(words), bool)
        return np.array([
            b"".join(map(spelled.__getitem__, np.frombuffer(c, kind_of).tolist())) == w.encode("utf-8", "replace")
            for w, c in zip(words.to_pylist(), codes.to_pylist(), strict=True)
        ], bool)

    def answers(left, right):
        """Rows of kind 1, for a block: a bucket, the sizes and ids of the block's words there, and the places of those not decoded."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        asked = [
            (block, data[0]) for n, block, data in zip(*(left.column(c).to_pylist() for c in ("kind", "block", "data")), strict=True) if n == 0
        ]
        out = []
        if asked:
            words, codes = right.column("word").cast(pa.string()).combine_chunks(), right.column("code").cast(pa.binary()).combine_chunks()
            lists = [(block, _unpacked(data)[0]) for block, data in asked]
            long = pa.concat_arrays([w.filter(pc.greater(pc.utf8_length(w), LONGEST_WORD)) for _, w in lists]).unique().to_pylist()
            if long:
                known = {p: (s, i.to_bytes(width, "little")) for p, i, s in pieces.rows}
                folded = [best_path(w, known, pieces, pieces.longest, pieces.unknown) for w in long]
                words = pa.concat_arrays([words, pa.array(long, pa.string())])
                codes = pa.concat_arrays([codes, pa.array(folded, pa.binary())])
            right_ones = decoded(words, codes)
            for block, own in lists:
                at = pc.index_in(own, value_set=words)
                if at.null_count:
                    raise ValueError("a word of a block has no code")
                found = codes.take(at)
                ids, sizes = _flat(found)
                wrong = np.flatnonzero(~right_ones[at.to_numpy()])
                out.append((block, left.column("key")[0].as_py(), [_planes(sizes // width), _planes(ids.view(kind_of)), _planes(wrong)]))
        return pa.table([
            pa.array([1] * len(out), pa.int32()), pa.array([o[0] for o in out], pa.int64()),
            pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.binary())),
        ], ["kind", "key", "bucket", "codes"])

    def join(left, right):
        import numpy as np
        import pyarrow as pa

        # several blocks of the same rows have the same number, the same words and the same answers
        told = dict(zip(right.column("bucket").to_pylist(), right.column("codes").to_pylist(), strict=True))
        told = [tuple(map(_numbers, told[n])) for n in sorted(told)]
        sizes = np.concatenate([t[0] for t in told] or [np.empty(0, np.int64)])
        ids = np.concatenate([t[1].astype(np.int32) for t in told] or [np.empty(0, np.int32)])
        right_ones = np.concatenate([~np.isin(np.arange(len(t[0])), t[2]) for t in told] or [np.empty(0, bool)])
        del told
        starts = np.cumsum(sizes) - sizes
        tables = []
        texts = left.column("data") if not len(left) or left.column("kind")[0].as_py() else []
        for own, message in zip(left.column("ids"), texts, strict=False):
            common, whole, n_words, *slices = message.as_py()
            n_words, whole = _numbers(n_words), _numbers(whole)
            places = np.concatenate([_numbers(common), np.arange(len(sizes))])
            for (begin, end), data in zip(_slices(n_words), slices, strict=True):
                part = places[_numbers(data)]
                sized = sizes[part]
                stops = np.cumsum(n_words[begin:end])
                ends = np.concatenate([[0], np.cumsum(sized)])[stops]
                missed = np.concatenate([[0], np.cumsum(~right_ones[part])])[stops]
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                tables.append(pa.table([
                    own.values[begin:end], pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[_runs(starts[part], sized)])),
                    pa.array(np.diff(offsets), pa.int32()), pa.array((whole[begin:end] == 1) & (np.diff(missed, prepend=0) == 0)),
                ], ["id", "ids", "n_tokens", "exact"]))
        if tables:
            return pa.concat_tables(tables)
        return pa.table([
            pa.array([], id_arrow), pa.array([], pa.list_(pa.int32())), pa.array([], pa.int32()), pa.array([], pa.bool_()),
        ], ["id", "ids", "n_tokens", "exact"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(rows.schema["id"].dataType)
    names = ["kind", "key", "block", "ids", "data"]
    # one shuffle with three readers: words for the lattice, words that wait for their codes, texts that wait for the answers
    sent = rows.mapInArrow(cut, f"kind int, key bigint, block bigint, ids array<{kind}>, data array<binary>")
    words = sent.groupBy("kind", "key").applyInArrow(distinct_words, "key bigint, word string")
    codes = encode_words(words, pieces, max(1, PARTITIONS * buckets), "key").select(F.lit(0).alias("kind"), "key", "word", "code")
    told = sent.groupBy("kind", "key").cogroup(codes.groupBy("kind", "key")).applyInArrow(
        answers, "kind int, key bigint, bucket bigint, codes array<binary>"
    )
    return sent.groupBy("kind", "key").cogroup(told.groupBy("kind", "key")).applyInArrow(
        join, f"id {kind}, ids array<int>, n_tokens int, exact boolean"
    )


def decode(encoded: DataFrame, pieces: Pieces, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of piece ids; no ids give an empty text, null ids a null, ids that are no piece nothing."""
    rows = pick(encoded, id=id_col, ids=ids_col)
    spelled = {i: p.encode() for p, i, _ in pieces.rows} | {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [
                None if x is None else b"".join(spelled.get(i, b"") for i in x)[1:].decode("utf-8", "replace")
                for x in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string")


@query("op10_sentencepiece")
def op10(spark: SparkSession, root: str) -> DataFrame:
    """Every document's piece ids, and whether they decode to its text."""
    return encode(table(spark, root, "documents"), read_pieces()).select(
        F.col("id").alias("doc_id"), "ids", "n_tokens", "exact"
    )
