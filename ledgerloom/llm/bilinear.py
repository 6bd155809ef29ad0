"""Language-model scoring by a log-bilinear model, trained with noise-contrastive estimation.

Every token belongs to a class. The most frequent words and the end of a text are classes of their own; all other
words share the class of those with the same ending, and within it each has its share of the corpus counts. The
model predicts the next token's class: the vectors of the previous two classes, each times the matrix of its
place, are summed, and their products with the classes' vectors, plus a bias, are the scores. Training tells tokens from
noise classes that a batch shares, so no normaliser is needed; scoring divides by the whole sum over all
classes, from one matrix product for each block of distinct contexts. Probabilities so add up to 1 over the words
of the corpus and, for each ending, one unknown word.

Counts are of all training texts. The vectors are fitted in rounds over growing shares of them, the last over all: in each
round every task starts from the same vectors and learns from its own texts, and the changes are
averaged by Spark, row by row, by how often each class was seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import frequent, pick, query, spans, table
from ledgerloom.sources.staging import stage

#: Words that are classes of their own; classes of endings; bytes of an ending; width of the vectors.
WORDS, ENDINGS, TAIL, WIDTH = 1023, 1024, 2, 32
#: Words whose counts every task gets; the counts of all others are joined.
KNOWN = 1 << 18
#: Classes of noise that a batch shares, contexts in a batch, step, and the shares of the training texts in the rounds.
NOISE, BATCH, STEP, ROUNDS = 64, 2048, 0.08, (1 / 16, 1 / 4, 1)
#: Characters of text that are counted or encoded at a time; tokens that are learned from or scored at a time.
CHUNK, TOKENS = 4_000_000, 1_000_000
#: The end of a text; no word is empty.
END = b""


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; null and empty texts have none."""
    return text.encode().lower().split() if text else []


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all words of rows (text), the end of each text counted as the empty word."""
    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        for batch in batches:
            rows = batch.column("text").to_pylist()
            for start, end in spans(rows, CHUNK):
                counts: Counter = Counter()
                for text in rows[start:end]:
                    counts.update(words_of(text))
                counts[END] += end - start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
                )

    return texts.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Bounded facts about the training texts: the commonest words and their counts, and the weight of every class.

    ``words`` are in order of falling counts; the first ``own`` and the end are classes of their own, and ``mass`` is, by
    class, the sum of (count + 0.5) of its words, plus 0.5 for an unknown one where words share the class.
    """

    words: list[bytes]
    counts: list[int]
    own: int
    mass: list[float]
    tokens: int
    types: int

    @property
    def end(self) -> int:
        return self.own

    @property
    def classes(self) -> int:
        return len(self.mass)

    def ending(self, word: bytes) -> int:
        import zlib

        return self.own + 1 + zlib.crc32(word[-TAIL:]) % (self.classes - self.own - 1)


def vocabulary(counts: DataFrame, words: int = WORDS, endings: int = ENDINGS, known: int = KNOWN) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of staged (word, n), and the counts that it does not hold. At most ``known`` words are collected."""
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    high, low = frequent(counts.where(F.octet_length("word") > 0), known)
    found = high.orderBy(F.desc("n"), "word").toArrow()
    names, numbers = found.column("word").to_pylist(), found.column("n").to_pylist()
    own = min(words, len(names))
    empty = Vocabulary(names, numbers, own, [0.0] * (own + 1 + endings), int(tokens), int(types))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at = np.array([empty.ending(w) for w in batch.column("word").to_pylist()], np.int64)
            mass = np.bincount(at, batch.column("n").to_numpy() + 0.5, empty.classes)
            held = np.flatnonzero(mass)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(mass[held])], ["class", "mass"])

    mass = [n + 0.5 for n in numbers[:own]] + [ends + 0.5] + [0.5] * endings
    for word, n in zip(names[own:], numbers[own:], strict=True):
        mass[empty.ending(word)] += n + 0.5
    for row in low.mapInArrow(run, "class bigint, mass double").groupBy("class").agg(F.sum("mass").alias("mass")).collect():
        mass[row["class"]] += row["mass"]
    return Vocabulary(names, numbers, own, mass, int(tokens), int(types)), low


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Rows (row, text, ...) as classes: the other columns and n_tokens, n_known, base, inner, classes, cold.

    ``base`` sums log10(count + 0.5) over the tokens whose counts are known here, ``inner`` the same less the class's
    weight over those that share a class; ``cold`` has the words whose counts are to be joined.
    """
    kept = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held = shared.value
        place = {w: i for i, w in enumerate(held.words)}
        place[END] = len(held.words)
        counts = np.array([*held.counts, held.mass[held.end] - 0.5], np.float64)
        by_ending: dict[bytes, int] = {}

        def ending(word: bytes) -> int:
            tail = word[-TAIL:]
            if tail not in by_ending:
                by_ending[tail] = held.ending(tail)
            return by_ending[tail]

        class_of = np.array([*range(held.own), *map(ending, held.words[held.own:]), held.end], np.int16)
        value = np.log10(counts + 0.5)
        weight = np.log10(np.array(held.mass))
        single = np.r_[np.ones(held.own + 1, bool), np.zeros(held.classes - held.own - 1, bool)]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in spans(texts, CHUNK):
                words, ends = [], [0]
                for text in texts[start:end]:
                    words += words_of(text)
                    words.append(END)
                    ends.append(len(words))
                at = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
                cold = np.flatnonzero(at < 0)
                unknown = [words[i] for i in cold.tolist()]
                classes = class_of[at]
                classes[cold] = np.fromiter(map(ending, unknown), np.int16, len(unknown))
                known = np.where(at < 0, 0.0, value[at])
                inner = np.where(single[classes], 0.0, known - weight[classes])
                froms = np.array(ends[:-1])
                rest = np.searchsorted(cold, np.array(ends)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(start, end - start) for c in kept), pa.array(np.diff(ends)),
                    pa.array(np.add.reduceat((at >= 0) & (counts[at] > 0), froms, dtype=np.int64)),
                    pa.array(np.add.reduceat(known, froms)), pa.array(np.add.reduceat(inner, froms)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(classes)),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(unknown, pa.binary())),
                ], [*kept, "n_tokens", "n_known", "base", "inner", "classes", "cold"])

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(
        run, types + ", n_tokens bigint, n_known bigint, base double, inner double, classes array<smallint>, cold array<binary>"
    )


@dataclass
class Vectors:
    """Context vectors, class vectors with the bias as their last column, and the two places' matrices."""

    context: object
    output: object
    places: object

    @classmethod
    def start(cls, vocab: Vocabulary, width: int = WIDTH) -> Vectors:
        """Random contexts and the classes' own frequencies as biases."""
        import numpy as np

        draw = np.random.default_rng(11)
        mass = np.array(vocab.mass)
        output = np.zeros((vocab.classes, width + 1), np.float32)
        output[:, width] = np.log(mass / mass.sum())
        context = draw.normal(0, 0.3, (vocab.classes, width)).astype(np.float32)
        return cls(context, output, np.stack([np.eye(width, dtype=np.float32)] * 2))

    def predicted(self):
        """By class, its contribution to the prediction in each place; a context's is the sum of two rows."""
        return self.context @ self.places[0], self.context @ self.places[1]


def contexts_of(classes, ends, end: int):
    """For each token of a run of texts the class before it and the one before that; ``end`` where there is none."""
    import numpy as np

    before = np.empty((2, len(classes)), np.int64)
    starts = ends[:-1]
    before[0, 1:] = classes[:-1]
    before[0, starts] = end
    before[1, 1:] = before[0, :-1]
    before[1, starts] = end
    return before


def _by_rows(ids, values):
    """Distinct ids and the sums of their rows."""
    import numpy as np

    order = np.argsort(ids, kind="stable")
    held, starts = np.unique(ids[order], return_index=True)
    return held, np.add.reduceat(values[order], starts, axis=0)


def gradients(v: Vectors, one, two, target, noise, weight, noise_score):
    """Of the weighted loss -log P(target is data) - sum of log P(noise is noise): by the vectors of one and two, by those
    of target and noise, and by the matrices. ``noise_score``: log of the expected number of each class in the noise."""
    import numpy as np

    near, far = v.context[one], v.context[two]
    q = near @ v.places[0] + far @ v.places[1]
    q1 = np.c_[q, np.ones(len(q), q.dtype)]
    true, false = v.output[target], v.output[noise]
    # derivative by each score: the probability of being noise, or of being data
    by_true = -weight / (1 + np.exp(np.clip((q1 * true).sum(1) - noise_score[target], -30, 30)))
    by_false = weight[:, None] / (1 + np.exp(np.clip(noise_score[noise] - q1 @ false.T, -30, 30)))
    by_q = (by_true[:, None] * true + by_false @ false)[:, :-1]
    return (
        by_q @ v.places[0].T, by_q @ v.places[1].T, by_true[:, None] * q1, by_false.T @ q1,
        np.stack([near.T @ by_q, far.T @ by_q]),
    )


class Learner:
    """Noise-contrastive steps of one task, with step lengths that shrink by the sum of squared changes (AdaGrad)."""

    def __init__(self, start: Vectors, mass: list[float], seed: int) -> None:
        import numpy as np

        self.v = Vectors(start.context.copy(), start.output.copy(), start.places.copy())
        self.squares = [np.full(x.shape, 1e-4, np.float32) for x in (start.context, start.output, start.places)]
        self.draw = np.random.default_rng(seed)
        share = np.array(mass) / sum(mass)
        self.cumulated = np.cumsum(share)
        self.noise_score = np.log(NOISE * share).astype(np.float32)
        self.seen = np.zeros((2, len(mass)))

    def learn(self, before, target) -> None:
        """Distinct (context, target) of a run of tokens, weighted by their number, in random order."""
        import numpy as np

        size = len(self.cumulated)
        codes, weight = np.unique((before[1] * size + before[0]) * size + target, return_counts=True)
        self.seen[0] += np.bincount(before[0], minlength=size) + np.bincount(before[1], minlength=size)
        self.seen[1] += np.bincount(target, minlength=size)
        order = self.draw.permutation(len(codes))
        codes, weight = codes[order], weight[order].astype(np.float32)
        for at in range(0, len(codes), BATCH):
            code = codes[at: at + BATCH]
            self._step(code // size % size, code // (size * size), code % size, weight[at: at + BATCH])

    def _step(self, one, two, target, weight) -> None:
        import numpy as np

        v = self.v
        noise = np.minimum(np.searchsorted(self.cumulated, self.draw.random(NOISE)), len(self.cumulated) - 1)
        weight = weight / weight.sum()
        g_near, g_far, g_true, g_false, places = gradients(v, one, two, target, noise, weight, self.noise_score)
        ids, change = _by_rows(np.r_[target, noise], np.r_[g_true, g_false])
        self._move(1, v.output, ids, change)
        ids, change = _by_rows(np.r_[one, two], np.r_[g_near, g_far])
        self._move(0, v.context, ids, change)
        self._move(2, v.places, slice(None), places)

    def _move(self, which: int, values, ids, change) -> None:
        import numpy as np

        squares = self.squares[which]
        squares[ids] += change * change
        values[ids] -= STEP * change / np.sqrt(squares[ids])


def fit(encoded: DataFrame, vocab: Vocabulary, width: int = WIDTH, rounds: tuple[float, ...] = ROUNDS) -> Vectors:
    """Vectors learned from all rows (row, classes). Only sums of the vectors' size reach the driver."""
    import numpy as np

    vectors = Vectors.start(vocab, width)
    size, spark = vocab.classes, encoded.sparkSession
    for number, share in enumerate(rounds):
        shared = spark.sparkContext.broadcast((vectors, vocab.mass, vocab.end))

        def run(batches: Iterator, shared=shared, number=number) -> Iterator:
            import pyarrow as pa
            from pyspark import TaskContext

            start, mass, end = shared.value
            learner = Learner(start, mass, 100 * TaskContext.get().partitionId() + number)
            classes, ends, n = [], [np.zeros(1, np.int64)], 0

            def learn() -> None:
                flat, stops = np.concatenate(classes).astype(np.int64), np.concatenate(ends)
                learner.learn(contexts_of(flat, stops, end), flat)

            for batch in batches:
                column = batch.column("classes")
                for at in range(0, len(column), 256):
                    part = column.slice(at, 256)
                    classes.append(part.flatten().to_numpy())
                    ends.append(np.cumsum(part.value_lengths().to_numpy()) + n)
                    n += len(classes[-1])
                    if n >= TOKENS:
                        learn()
                        classes, ends, n = [], [np.zeros(1, np.int64)], 0
            if n:
                learn()
            v = learner.v
            changes = np.zeros((2 * size + 2 * width, width + 1))
            changes[:size, :width] = v.context - start.context
            changes[size: 2 * size] = v.output - start.output
            changes[2 * size:, :width] = (v.places - start.places).reshape(-1, width)
            weight = np.r_[learner.seen[0], learner.seen[1], np.full(2 * width, learner.seen[1].sum())]
            held = np.flatnonzero((weight > 0) | changes.any(axis=1))
            weight = np.maximum(weight, 1)
            ends = pa.array((np.arange(len(held) + 1) * (width + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(held), pa.array(weight[held]), pa.ListArray.from_arrays(ends, pa.array(changes[held].ravel()))
            ], ["at", "weight", "change"])

        parts = 64
        taken = encoded if share >= 1 else encoded.where(F.pmod(F.xxhash64("row"), F.lit(parts)) < math.ceil(share * parts))
        sums = taken.select("classes").mapInArrow(run, "at bigint, weight double, change array<double>").groupBy("at").agg(
            F.sum("weight").alias("weight"), *[F.sum(F.col("weight") * F.col("change")[i]).alias(f"c{i}") for i in range(width + 1)]
        ).toArrow()
        mean = np.zeros((2 * size + 2 * width, width + 1))
        at = sums.column("at").to_numpy()
        for i in range(width + 1):
            mean[at, i] = sums.column(f"c{i}").to_numpy() / sums.column("weight").to_numpy()
        vectors = Vectors(
            (vectors.context + mean[:size, :width]).astype(np.float32), (vectors.output + mean[size: 2 * size]).astype(np.float32),
            (vectors.places + mean[2 * size:, :width].reshape(2, width, width)).astype(np.float32),
        )
    return vectors


def log_sums(q, output):
    """log of the sum of exp(score) over all classes for each prediction: one matrix product a block."""
    import numpy as np

    out = np.empty(len(q), np.float32)
    for at in range(0, len(q), BATCH):
        scores = q[at: at + BATCH] @ output[:, :-1].T + output[:, -1]
        top = scores.max(axis=1)
        scores -= top[:, None]
        out[at: at + BATCH] = top + np.log(np.exp(scores, out=scores).sum(axis=1))
    return out


def class_scores(encoded: DataFrame, vocab: Vocabulary, vectors: Vectors) -> DataFrame:
    """(row, model): the sum over a row's tokens of log10 of the probability of their class."""
    shared = encoded.sparkSession.sparkContext.broadcast((vectors, vocab.end))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, end = shared.value
        size = len(held.output)
        one, two = held.predicted()
        # normalisers of the contexts met so far
        sums = np.full(size * size, np.nan, np.float32)

        def score(classes, ends):
            flat = classes.astype(np.int64)
            before = contexts_of(flat, ends, end)
            code = before[1] * size + before[0]
            new = np.unique(code)
            new = new[np.isnan(sums[new])]
            for at in range(0, len(new), 64 * BATCH):
                part = new[at: at + 64 * BATCH]
                sums[part] = log_sums(one[part % size] + two[part // size], held.output)
            value = np.empty(len(flat))
            for at in range(0, len(flat), 64 * BATCH):
                here = slice(at, at + 64 * BATCH)
                q = one[before[0, here]] + two[before[1, here]]
                rows = held.output[flat[here]]
                value[here] = (q * rows[:, :-1]).sum(axis=1) + rows[:, -1] - sums[code[here]]
            return np.add.reduceat(value, ends[:-1]) / np.log(10)

        for batch in batches:
            column = batch.column("classes")
            lengths = column.value_lengths().to_numpy().astype(np.int64)
            stops = np.searchsorted(np.cumsum(lengths), np.arange(TOKENS, lengths.sum() + TOKENS, TOKENS))
            for start, stop in zip([0, *(stops[:-1] + 1)], np.minimum(stops + 1, len(lengths)), strict=True):
                if stop > start:
                    part = column.slice(start, stop - start)
                    ends = np.r_[0, np.cumsum(lengths[start:stop])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").slice(start, stop - start), pa.array(score(part.flatten().to_numpy(), ends))], ["row", "model"]
                    )

    return encoded.select("row", "classes").mapInArrow(run, "row bigint, model double")


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", known: int = KNOWN,
                rounds: tuple[float, ...] = ROUNDS) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a condition on a column ``id``; a row for which it is null trains. Null and empty texts are the
    end alone. Texts of any length are learned from and scored whole. Repeated ids and rows stay rows of
    their own and count again; other columns, whatever their names, are ignored. An empty table gives an empty
    result. Sums of the fit are made in the order in which tasks end, so scores may differ between runs in the last digits.
    """
    rows = pick(docs, id=id_col, text=text_col).select(
        F.monotonically_increasing_id().alias("row"), "id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"
    )
    counts = stage(word_counts(rows.where(~F.col("held_out"))), "word-counts")
    vocab, low = vocabulary(counts, known=known)
    encoded = stage(encode(rows, vocab), "encoded")
    vectors = fit(encoded.where(~F.col("held_out")), vocab, rounds=rounds)
    by_class = class_scores(encoded, vocab, vectors)

    cold = encoded.select("row", F.explode("cold").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("k"))
    met = cold.join(low, "word", "left")
    value = F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    cold_sums = met.groupBy("row").agg(
        F.sum(F.col("k") * value).alias("cold_value"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("cold_known")
    )
    none = F.lit(0)
    total = math.log10(vocab.tokens + 0.5 * (vocab.types + 1))
    return (
        encoded.drop("classes", "cold").join(by_class, "row").join(cold_sums, "row", "left")
        .select(
            "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("cold_known", none)).alias("n_known"),
            F.lit(vocab.tokens).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("cold_value", none) - F.col("n_tokens") * F.lit(total)).alias("base_score"),
            (F.col("model") + F.col("inner") + F.coalesce("cold_value", none)).alias("score"),
        )
    )


@query("op13_language_model")
def op13(spark: SparkSession, root: str) -> DataFrame:
    """Every document's log10 probability by unigram counts and by the model; a fifth of the documents is held out."""
    remainder = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 5
    return score_texts(table(spark, root, "documents"), remainder == 1).withColumnRenamed("id", "doc_id")
