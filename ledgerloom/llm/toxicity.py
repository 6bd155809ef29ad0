"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes homoglyphs, digit and symbol substitutions, so that the lexicon is matched however it
is spelled. The lexicon is a set of word beginnings with log-odds weights, learned from labelled rows:
a beginning covers a word's inflections. Matched weight per word of text and in total
are calibrated to a probability. Phrases that hold a lexicon entry but are harmless
are exceptions: matches inside them do not count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import column_of, pick, query, renamed, table

#: Most labelled rows that a fit reads; the rows with the smallest id hashes are taken.
TRAIN_ROWS = 20_000
#: Most entries of a learned lexicon.
ENTRIES = 2_000
#: Lengths of word beginnings, rows that must hold one, and least log odds.
SHORTEST, LONGEST, SUPPORT, LEAST_WEIGHT = 4, 12, 5, 2.0
#: Counts that a task holds before it hands them on.
TERMS_HELD = 100_000
#: Fixed: harmless phrases, lower case.
EXCEPTIONS = (
    "clown fish", "clownfish", "trash can", "trash bag", "trash bin", "trash collection", "pond scum",
    "sore loser", "weight loser", "class clown", "circus clown", "rodeo clown", "white trash bag",
)
#: Fixed: look-alikes of Latin letters, and digits and symbols used for letters (i and 1 become l).
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "в": "b",
    "к": "k", "м": "m", "н": "h", "т": "t", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "υ": "u", "ν": "v", "κ": "k", "τ": "t",
    "і": "l", "ι": "l", "ı": "l", "ӏ": "l", "ⅼ": "l", "ⅰ": "l",
    "0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "i": "l", "|": "l",
}
_FULL_WIDTH = {chr(0xFF41 + n): chr(0x61 + n) for n in range(26)}
_HIDDEN = {chr(c): None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
_FOLD = str.maketrans({**_FULL_WIDTH, **LOOK_ALIKES, "ｉ": "l", **_HIDDEN})
_SYMBOL = re.compile(r"(?<=[^\W_])[@$](?=[^\W_])")
_TOKEN = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower case without look-alikes; null is empty."""
    text = (text or "").lower()
    if "@" in text or "$" in text:
        text = _SYMBOL.sub(lambda m: "a" if m.group() == "@" else "s", text)
    return text.translate(_FOLD)


def _beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)]


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(id, text, label): at most ``limit`` labelled rows whose crc32(id) mod 5 is not 0, by the hash of their id."""
    known = (
        labels.where("label is not null and id is not null").where(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)
        .groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(limit)
    )
    # at most ``limit`` narrow rows
    return docs.join(F.broadcast(known), "id").select("id", "text", "label").dropDuplicates(["id"])


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Word beginnings with log-odds weights from rows (text, label).

    Counts are of rows that hold a beginning. Of nested beginnings the one in most toxic rows
    is kept, the longest of equals: a whole word where it is always the same word, a stem where endings vary.
    """
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def counted(found):
            return pa.RecordBatch.from_arrays([
                pa.array(list(found), pa.string()), pa.array([v[1] for v in found.values()], pa.int64()),
                pa.array([v[0] for v in found.values()], pa.int64()),
            ], ["term", "toxic", "clean"])

        found: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                for term in {b for w in set(_TOKEN.findall(fold(text.as_py()))) for b in _beginnings(w)}:
                    found.setdefault(term, [0, 0])[1 if label.as_py() else 0] += 1
                if len(found) >= TERMS_HELD:
                    yield counted(found)
                    found = {}
        yield counted(found)

    sizes = rows.agg(F.sum((F.col("label") > 0).cast("int")), F.sum((F.col("label") <= 0).cast("int"))).first()
    bad, good = sizes[0] or 0, sizes[1] or 0
    counted = rows.select("text", "label").mapInArrow(count, "term string, toxic bigint, clean bigint")
    weight = F.log((F.col("toxic") + 0.5) / (bad + 1.0)) - F.log((F.col("clean") + 0.5) / (good + 1.0))
    best = (
        counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= SUPPORT).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("toxic"), F.desc(F.length("term")), "term").limit(20 * ENTRIES)
    )
    lexicon: dict[str, float] = {}
    covered: set[str] = set()
    for row in best.collect():
        if len(lexicon) == ENTRIES:
            break
        parts = _beginnings(row["term"])
        # nested either way: a chosen entry begins with it, or it begins with a chosen entry
        if row["term"] not in covered and not any(p in lexicon for p in parts):
            lexicon[row["term"]] = float(row["weight"])
            covered.update(parts)
    return lexicon


@lru_cache(maxsize=4)
def _automaton(entries: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
    import ahocorasick

    # a word may be an entry and an exception at once
    weights = dict(entries)
    harmless = {fold(phrase) for phrase in exceptions}
    machine = ahocorasick.Automaton()
    for word in weights.keys() | harmless:
        machine.add_word(word, (len(word), weights.get(word), word in harmless))
    machine.make_automaton()
    return machine


def matched(text: str | None, entries: tuple[tuple[str, float], ...], exceptions: tuple[str, ...] = EXCEPTIONS) -> tuple[float, int]:
    """Total weight of lexicon entries at word starts outside exception phrases, and the number of words.

    An exception is a phrase of whole words: "trash can" covers neither "trash candidate" nor "trash" alone.
    """
    folded = fold(text)
    words = len(folded.split())
    if not entries or not words:
        return 0.0, words
    spans, hits = [], []
    for end, (length, weight, harmless) in _automaton(entries, exceptions).iter(folded):
        start = end + 1 - length
        if start and folded[start - 1].isalnum():
            continue
        if harmless and not folded[end + 1: end + 2].isalnum():
            spans.append((start, end))
        if weight is not None:
            hits.append((start, end, weight))
    if spans and hits:
        # of the spans that begin at or before a hit only the one that reaches furthest matters
        spans.sort()
        hits.sort()
        kept, at, reach = [], 0, -1
        for hit in hits:
            while at < len(spans) and spans[at][0] <= hit[0]:
                reach = max(reach, spans[at][1])
                at += 1
            if hit[1] > reach:
                kept.append(hit)
        hits = kept
    return sum(h[2] for h in hits), words


def features(total: float, words: int) -> tuple[float, float, float]:
    """Intercept, weight per thousand words, and total weight, both on a log scale."""
    import math

    return 1.0, math.log1p(1000.0 * total / max(words, 1)), math.log1p(total)


def fit_logistic(x, y, ridge: float = 0.05, rounds: int = 50):
    """Logistic regression by Newton steps with a small ridge."""
    import numpy as np

    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class ToxicityModel:
    """A lexicon and a calibration; scores tables."""

    def __init__(self, lexicon: dict[str, float], beta: tuple[float, ...], exceptions: tuple[str, ...] = EXCEPTIONS) -> None:
        self.entries = tuple(sorted(lexicon.items()))
        self.beta = tuple(float(b) for b in beta)
        self.exceptions = exceptions

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, score, matched_weight, n_words) of every input row; null and empty texts score as texts without a match.

        Texts of any length are matched whole, in one pass. Repeated ids and rows stay rows of their own; other columns are
        ignored, whatever their names.
        """
        rows = pick(docs, id=id_col, text=text_col)
        entries, beta, exceptions = self.entries, self.beta, self.exceptions

        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                found = [matched(t.as_py(), entries, exceptions) for t in batch.column(1)]
                x = np.array([features(*f) for f in found]).reshape(-1, 3)
                scores = 1 / (1 + np.exp(-np.clip(x @ np.array(beta), -30, 30)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(scores), pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.int64()),
                ], ["id", "score", "matched_weight", "n_words"])

        kind = rows.schema["id"].dataType.simpleString()
        return rows.mapInArrow(run, f"id {kind}, score double, matched_weight double, n_words bigint")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", limit: int = TRAIN_ROWS) -> ToxicityModel:
    """Lexicon and calibration from at most ``limit`` labelled rows outside the held-out fifth.

    Without labelled rows, or with one class only, every text scores 0. Of rows that repeat an id one text is
    learned from, and of labels that repeat one the largest counts.
    """
    import numpy as np

    rows = training_rows(
        pick(docs, id=id_col, text=text_col), pick(labels, id=label_id, label=label_col), limit
    )
    lexicon = learn_lexicon(rows)
    entries = tuple(sorted(lexicon.items()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [features(*matched(t.as_py(), entries)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([
                pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64()),
                batch.column(1).cast(pa.float64()),
            ], ["density", "total", "label"])

    # at most ``limit`` rows of three numbers
    seen = rows.select("text", F.col("label").cast("double").alias("label")).mapInArrow(
        run, "density double, total double, label double"
    ).toPandas()
    y = (seen["label"].to_numpy(dtype=float) > 0).astype(float) if len(seen) else np.zeros(0)
    if not len(y) or y.min() == y.max():
        return ToxicityModel({}, (-30.0, 0.0, 0.0))
    x = np.c_[np.ones(len(seen)), seen["density"], seen["total"]]
    return ToxicityModel(lexicon, tuple(fit_logistic(x, y)))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows that score below ``threshold``, all columns kept, whatever their names."""
    model = fit(docs, labels, id_col, text_col)
    entries, beta, exceptions = model.entries, model.beta, model.exceptions

    @F.pandas_udf("double")
    def score(texts):
        import numpy as np
        import pandas as pd

        x = np.array([features(*matched(t, entries, exceptions)) for t in texts]).reshape(-1, 3)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(beta), -30, 30))))

    held, restored = renamed(docs)
    return restored(held.where(score(F.col(column_of(docs, text_col))) < threshold))


@query("op5_toxicity")
def op5(spark: SparkSession, root: str) -> DataFrame:
    """Every document's toxicity; a fifth of the ids, by checksum, is held out from the fit."""
    docs = table(spark, root, "documents")
    model = fit(docs, table(spark, root, "labels"))
    held_out = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) == 0
    return model.score(docs).select(
        F.col("id").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
