"""Phrase collocations by Toivonen's sampling scheme.

A sample of the documents proposes the phrases that may be frequent. One pass over all documents then counts,
exactly, every word, every proposed phrase and the negative border: the phrases that are not proposed while all
their parts are. A border phrase that turns out to be frequent is a failure of the sample: it joins the
proposal, and a further pass counts what the larger proposal adds. Where failures are rare, as with a good sample, that pass
also counts whatever may be frequent because of them, up to the longest phrases, and is the last. Otherwise passes go on until nothing
frequent is left outside the proposal; after pass k all frequent phrases of k words are known, so four passes are the most.

The proposal is held as a bit filter of at most ``MOST`` bits, whatever the number of phrases: a phrase that it holds
by mistake is counted without need and changes no result. Tasks count in chunks of text with numpy and send one
row for each distinct phrase of a chunk.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, query, table
from ledgerloom.operators.ordering import rank_within
from ledgerloom.sources.staging import stage

#: Contract: words of a phrase, its least number of occurrences, share (per cent) at which a longer one absorbs
#: it, and phrases kept for each language.
LONGEST, LEAST, ABSORBED, KEPT = 4, 30, 80, 2000
#: Share of the documents that proposes, and how often a phrase must stand in it, as a part of LEAST times the share. Above 1
#: a further pass finds more of the phrases near LEAST, but chance proposals, whose border would be counted, are few.
SHARE, EASE = 1 / 8, 1.6
#: Bits of the filter: so many for each phrase known when it is made, a power of two within these bounds.
PER_PHRASE, FEWEST, MOST = 32, 1 << 16, 1 << 27
#: Occurrences of failures, as a part of all words, up to which all that they may make frequent is counted at once: rows as of the first pass.
RARE = 0.25
#: Bytes of text that are counted at a time.
CHUNK = 2_000_000

#: What ends a piece, as one byte that no UTF-8 text holds; the letters A-Z are lower-cased, a tab is a space.
_END = b"\xff"
_CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _END * 10)


def tokens(text: bytes) -> list[bytes]:
    """Words in order, with ``_END`` at every end of a piece."""
    return text.translate(_CLEAN).replace(_END, b" \xff ").split()


def word_hash(lang: bytes, word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang + _END + word)


def longer_hash(front, last):
    """Hashes of phrases from those of their first words and of their last word."""
    import numpy as np

    x = front * np.uint64(0x9E3779B97F4A7C15) + last
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def bits_of(hashes, bits: int):
    """Two bits of the filter for each hash."""
    import numpy as np

    mask = np.uint64(bits - 1)
    return np.concatenate([hashes & mask, (hashes >> np.uint64(32)) & mask]).astype(np.int64)


def holds(words, hashes):
    """Which hashes the filter (an array of 64-bit words) holds."""
    import numpy as np

    at = bits_of(hashes, len(words) * 64)
    found = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
    return (found[: len(hashes)] & found[len(hashes):]).astype(bool)


class Chunk:
    """Counts of the phrases of some texts: those whose parts the new filter holds and the old one does not all hold.

    ``all_at_once``: a phrase that is counted itself is taken for one that the new filter holds.
    """

    def __init__(self, old, new, longest: int, all_at_once: bool = False) -> None:
        self.old, self.new, self.longest, self.all_at_once = old, new, longest, all_at_once
        self.ids: list[int] = []
        self.size = 0
        number = count(1)
        # one dictionary for each language, all with numbers of one series; 0 ends a piece. A factory that held the chunk
        # would be a cycle, and every chunk would stay until a full collection
        self.known: dict[bytes, dict[bytes, int]] = defaultdict(lambda: Chunk._words(number))

    @staticmethod
    def _words(number: count) -> dict[bytes, int]:
        words: dict[bytes, int] = defaultdict(number.__next__)
        words[_END] = 0
        return words

    def add(self, lang: bytes, text: bytes) -> None:
        self.ids.extend(map(self.known[lang].__getitem__, tokens(text)))
        self.ids.append(0)
        self.size += len(text)

    def counted(self) -> Iterator[tuple[list[bytes], list[bytes], int, list[int]]]:
        """(languages, phrases, number of words, counts) by number of words; 0 words: all words of a language."""
        import numpy as np

        langs, words = [b""], [b""]
        for lang, known in self.known.items():
            fresh = [w for w in known if w != _END]
            langs += [lang] * len(fresh)
            words += fresh
        # numbers were given in turns between languages
        place = np.array([0] + [known[w] for known in self.known.values() for w in known if w != _END], np.int64)
        turn = np.empty(len(place), np.int64)
        turn[place] = np.arange(len(place))
        ids = turn[np.array(self.ids, np.int64)]
        counts = np.bincount(ids, minlength=len(words))
        first = self.old is None
        if first:
            totals: dict[bytes, int] = defaultdict(int)
            for lang, n in zip(langs[1:], counts[1:].tolist(), strict=True):
                totals[lang] += n
            yield list(totals), [b""] * len(totals), 0, list(totals.values())
            yield langs[1:], words[1:], 1, counts[1:].tolist()
        hashes = np.array([0] + [word_hash(lang, w) for lang, w in zip(langs[1:], words[1:], strict=True)], np.uint64)
        if self.new is None:
            return

        def phrases(begin, which, size: int) -> tuple[list[bytes], list[bytes], int, list[int]]:
            # one place of each phrase spells it
            place = np.empty(int(which.max()) + 1, np.int64)
            place[which] = begin
            spelled = zip(*(map(words.__getitem__, ids[place + k].tolist()) for k in range(size)), strict=True)
            return [langs[i] for i in ids[place].tolist()], list(map(b" ".join, spelled)), size, np.bincount(which).tolist()

        # of each place: whether the filters hold the phrase of so many words that begins there, and its hash
        fresh, stale = holds(self.new, hashes), np.zeros(len(hashes), bool) if first else holds(self.old, hashes)
        fresh[0] = stale[0] = False
        shown, fresh, stale, each = hashes[ids], fresh[ids], stale[ids], hashes[ids]
        which = ids
        for length in range(2, self.longest + 1):
            # both parts are held; the words of a phrase are those of one piece, as no filter holds an end
            begin = np.flatnonzero(fresh[:-1] & fresh[1:])
            if not len(begin):
                return
            was = stale[begin] & stale[begin + 1]
            value = longer_hash(shown[begin], each[begin + length - 1])
            counted = begin[~was]
            if len(counted):
                if first:
                    # all phrases of one word less that begin here have numbers
                    number = self._numbers(which[counted], ids[counted + length - 1], len(words))
                    which = np.zeros(len(ids), np.int64)
                    which[counted] = number
                else:
                    number = ids[counted]
                    for k in range(1, length):
                        number = self._numbers(number, ids[counted + k], len(words))
                yield phrases(counted, number, length)
            if length == self.longest:
                return
            kept = holds(self.new, value)
            if self.all_at_once:
                kept |= ~was
            fresh, held = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
            fresh[begin] = kept
            if not first:
                at = np.flatnonzero(was)
                held[begin[at]] = holds(self.old, value[at])
            stale = held
            shown = np.zeros(len(ids), np.uint64)
            shown[begin] = value

    @staticmethod
    def _numbers(front, last, words: int):
        """Numbers of the pairs, from 0 on."""
        import numpy as np

        return np.unique(front * words + last, return_inverse=True)[1]


def pieces_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text) of all rows with text; a null language is ``und``."""
    rows = pick(docs, text=text_col, lang=lang_col)
    return rows.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text <> ''")


def count_pass(texts: DataFrame, old, new, longest: int, least: int, all_at_once: bool = False) -> DataFrame:
    """Staged frequent (lang, phrase, size, n) that the filter ``new`` adds to ``old``; size 0 has a language's words in all.

    ``old`` None: the first pass, which counts all words; ``new`` None holds nothing.
    """
    shared = texts.sparkSession.sparkContext.broadcast((old, new))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(chunk: Chunk) -> Iterator:
            for langs, phrases, _, counts in chunk.counted():
                yield pa.RecordBatch.from_arrays([
                    pa.array(langs, pa.binary()).cast(pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
                ], ["lang", "phrase", "n"])

        before, now = shared.value
        chunk = Chunk(before, now, longest, all_at_once)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                chunk.add(lang.as_py().encode(), text.as_py().encode())
                if chunk.size >= CHUNK:
                    yield from out(chunk)
                    chunk = Chunk(before, now, longest, all_at_once)
                    pa.default_memory_pool().release_unused()
        yield from out(chunk)

    counted = texts.mapInArrow(run, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    # the number of words is not sent along: words hold no space
    size = F.when(F.col("phrase") == "", 0).otherwise(F.regexp_count("phrase", F.lit(" ")) + 1).cast("int")
    kept = counted.where((F.col("phrase") == "") | (F.col("n") >= least))
    found = stage(kept.select("lang", "phrase", size.alias("size"), "n"), "phrases")
    shared.destroy()
    return found


def widened(found: DataFrame, words, longest: int):
    """The filter with all phrases of less than ``longest`` words in it, and the occurrences of those that it did not hold; None if it holds all.

    A filter keeps the size that it was made with, so a wider one holds all that it held. At most MOST / 64 rows are collected.
    """
    import numpy as np

    rows = found.where((F.col("size") > 0) & (F.col("size") < longest)).select("lang", "phrase", "n")
    if words is None:
        wanted = max(FEWEST, PER_PHRASE * rows.count())
        words = np.zeros(min(MOST, 1 << (wanted - 1).bit_length()) // 64, np.uint64)
    shared = found.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = shared.value
        for batch in batches:
            values = np.zeros(batch.num_rows, np.uint64)
            for at, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                first, *rest = [word_hash(lang.encode(), w) for w in phrase.encode().split(b" ")]
                value = np.array([first], np.uint64)
                for word in rest:
                    value = longer_hash(value, np.array([word], np.uint64))
                values[at] = value[0]
            lacking = ~holds(held, values)
            at = np.unique(bits_of(values[lacking], len(held) * 64))
            slots, starts = np.unique(at >> 6, return_index=True)
            bits = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64))
            merged = np.bitwise_or.reduceat(bits, starts) if len(at) else bits
            n = np.zeros(len(slots), np.int64)
            n[:1] = batch.column(2).to_numpy()[lacking].sum()
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(merged.view(np.int64)), pa.array(n)], ["slot", "word", "n"])

    added = rows.mapInArrow(run, "slot bigint, word bigint, n bigint").groupBy("slot").agg(
        F.bit_or("word").alias("word"), F.sum("n").alias("n")
    ).toArrow()
    shared.destroy()
    if not added.num_rows:
        return None
    out, slots = words.copy(), added.column("slot").to_numpy()
    out[slots] |= added.column("word").to_numpy().view(np.uint64)
    return out, sum(added.column("n").to_pylist())


def frequent_phrases(texts: DataFrame, least: int = LEAST, longest: int = LONGEST, proposed=None) -> tuple[DataFrame, int]:
    """All (lang, phrase, size, n) of up to ``longest`` words with n >= ``least``, counted exactly, and the passes it took.

    ``proposed``: a filter of phrases that are counted in the first pass already; no result depends on it.
    """
    import numpy as np

    found = count_pass(texts, None, proposed, longest, least)
    total = found.where("size = 0").agg(F.sum("n")).first()[0] or 0
    new, old, passes, last = found, proposed, 1, False
    while not last and (wider := widened(new, old, longest)) is not None:
        words, failed = wider
        passes, last = passes + 1, old is not None and failed <= RARE * total
        new = count_pass(texts, np.zeros(len(words), np.uint64) if old is None else old, words, longest, least, last)
        found, old = found.union(new), words
    return found, passes


def propose(texts: DataFrame, least: int = LEAST, longest: int = LONGEST, share: float = SHARE):
    """The filter of phrases that are frequent in a sample of the texts, at a lowered limit; None if there are none."""
    if share <= 0:
        return None
    limit = max(2, int(least * share * EASE))
    found, _ = frequent_phrases(texts.sample(float(share), 7), limit, longest - 1)
    wider = widened(found, None, longest)
    return wider and wider[0]


def collocations(found: DataFrame, kept: int = KEPT, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) from all frequent phrases: each language's first ``kept``.

    A phrase's score is that of its lowest cut in two, floor(2000000 a / (l + r)), ties to the earlier cut. A phrase
    inside a longer one with ``absorbed`` per cent of its occurrences or more is dropped.
    """
    parts = found.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("m"))
    candidates = found.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumns({
        "left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)"),
    })
    measured = (
        cuts.join(parts.withColumnsRenamed({"part": "left", "m": "l"}), ["lang", "left"])
        .join(parts.withColumnsRenamed({"part": "right", "m": "r"}), ["lang", "right"])
        .withColumn("score", F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))"))
    )
    scored = measured.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # every shorter run of a longer phrase's words
    words, size = F.split("phrase", " "), F.col("size")
    runs = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: F.array_join(F.slice(words, at, n), " ")
    )))
    inside = candidates.where("size > 2").select("lang", F.explode(runs).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer")
    )
    hundred, share = (F.lit(x).cast("decimal(3,0)") for x in (100, absorbed))
    lost = F.coalesce(F.col("longer").cast("decimal(20,0)") * hundred >= F.col("a").cast("decimal(20,0)") * share, F.lit(False))
    left = scored.join(inside, ["lang", "phrase"], "left").where(~lost).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )
    ranked = rank_within(left, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], "rank", True).where(F.col("rank") <= kept)
    totals = found.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, kept: int = KEPT,
         share: float = SHARE) -> DataFrame:
    """The first ``kept`` collocations of each language; ``share`` of the documents proposes, all are counted.

    Null and empty texts have no words; a null language is ``und``, together with the language of that name. Repeated
    rows count again. Texts of any length are counted whole, one text being the least that a task
    holds. Other columns, whatever their names, are ignored; an empty table gives an empty result.
    """
    texts = pieces_of(docs, text_col, lang_col)
    found, _ = frequent_phrases(texts, least, proposed=propose(texts, least, share=share))
    return collocations(found, kept)


@query("op12_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM lists, (SELECT unnest([1, 2, 3, 4]) AS size) s WHERE len(w) >= size) p),
f AS (SELECT lang, phrase, size, count(*) AS n FROM grams GROUP BY lang, phrase, size HAVING count(*) >= 30),
c AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(list_slice(w, 1, k), ' ') AS lefts, array_to_string(list_slice(w, k + 1, len(w)), ' ') AS rights
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) x),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, l.n AS l, r.n AS r, (2000000::HUGEINT * a // (l.n + r.n))::BIGINT AS score,
    row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY 2000000::HUGEINT * a // (l.n + r.n), k) AS place
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lefts JOIN f r ON r.lang = cuts.lang AND r.phrase = rights),
inside AS (
  SELECT lang, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT lang, a, w, unnest(range(2, len(w))) AS size FROM c WHERE len(w) > 2) y) z
  GROUP BY 1, 2),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank,
    s.phrase, a, l, r, score
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE place = 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a))
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000""")
def op12(spark: SparkSession, root: str) -> DataFrame:
    """Each language's first 2000 collocations of two to four words."""
    return mine(table(spark, root, "documents"))
