"""The language model: exact counts, whole normalisation, gradients, and what it learns."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import awkward, documents

from ledgerloom.llm import bilinear
from ledgerloom.llm.common import QUERIES


def lower_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    word, out = "", []
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def base(rows, held):
    """By row: (tokens, known tokens, training tokens, base score)."""
    counts = Counter()
    for (i, t, _) in rows:
        if not held(i):
            counts.update([*lower_words(t), None])
    total, types = sum(counts.values()), len(counts)
    out = []
    for (_, t, _) in rows:
        words = [*lower_words(t), None]
        value = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in words)
        out.append((len(words), sum(counts[w] > 0 for w in words), total, round(value, 6)))
    return out


@pytest.mark.parametrize("known", [bilinear.KNOWN, 40, 0])
def test_counts_and_base_scores(spark, known):
    rows = [r for r in awkward() if len(r[1] or "") < 5000]
    got = bilinear.score_texts(documents(spark, rows), F.col("id") % 3 == 1, known=known, rounds=(1,)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(
        base(rows, lambda i: i is not None and i % 3 == 1)
    )
    assert all(r["score"] < 0 for r in got) and sum(r["held_out"] for r in got) == sum(i is not None and i % 3 == 1 for i, _, _ in rows)


def fitted(spark, rows, words=8, endings=5, known=20):
    df = documents(spark, rows).select(F.monotonically_increasing_id().alias("row"), "text")
    counts = bilinear.word_counts(df).cache()
    vocab, low = bilinear.vocabulary(counts, words, endings, known)
    encoded = bilinear.encode(df, vocab).cache()
    return df, counts, vocab, low, encoded, bilinear.fit(encoded, vocab, 6, (1,))


def test_probabilities_are_whole_and_scores_follow_them(spark):
    draw = random.Random(4)
    rows = [(n, " ".join(f"w{min(int(draw.expovariate(0.1)), 60)}" for _ in range(draw.randint(0, 60))), "a") for n in range(60)]
    df, counts, vocab, _, encoded, vectors = fitted(spark, rows)
    known = {bytes(r["word"]): r["n"] for r in counts.collect()}
    assert math.isclose(sum(vocab.mass), sum(n + 0.5 for n in known.values()) + 0.5 * 5)
    cls = {w: i for i, w in enumerate(vocab.words[: vocab.own])} | {bilinear.END: vocab.end}

    def class_of(word):
        return cls.get(word, vocab.ending(word))

    def probability(word, one, two):
        q = vectors.context[one] @ vectors.places[0] + vectors.context[two] @ vectors.places[1]
        scores = (vectors.output[:, :-1] @ q + vectors.output[:, -1]).astype(float)
        at = class_of(word)
        share = 1.0 if word in cls else (known.get(word, 0) + 0.5) / vocab.mass[at]
        return math.exp(scores[at]) / np.exp(scores).sum() * share

    unknown = {vocab.ending(w): w for w in (f"q{n}".encode() for n in range(400))}
    assert len(unknown) == 5
    for one, two in ((0, 1), (vocab.end, 3), (9, 9)):
        total = sum(probability(w, one, two) for w in [*known, *unknown.values()])
        assert abs(total - 1) < 1e-5

    want = {}
    for r in df.collect():
        one = two = vocab.end
        total = 0.0
        for word in [*(r["text"] or "").encode().split(), bilinear.END]:
            total += math.log10(probability(word, one, two))
            one, two = class_of(word), one
        want[r["row"]] = total
    cold = {r["row"]: r["cold"] for r in encoded.select("row", "cold").collect()}
    inner = {r["row"]: r["inner"] for r in encoded.select("row", "inner").collect()}
    for r in bilinear.class_scores(encoded, vocab, vectors).collect():
        more = sum(math.log10(known.get(bytes(w), 0) + 0.5) for w in cold[r["row"]])
        assert abs(r["model"] + inner[r["row"]] + more - want[r["row"]]) < 1e-3


def test_gradients_equal_differences():
    draw = np.random.default_rng(3)
    v = bilinear.Vectors(draw.normal(size=(7, 4)), draw.normal(size=(7, 5)), draw.normal(size=(2, 4, 4)))
    one, two, target, noise = (draw.integers(0, 7, n) for n in (6, 6, 6, 3))
    weight, noise_score = draw.random(6), draw.normal(size=7)

    def loss():
        q = v.context[one] @ v.places[0] + v.context[two] @ v.places[1]
        scores = q @ v.output[:, :-1].T + v.output[:, -1] - noise_score
        true = scores[np.arange(6), target]
        return float((weight * np.log1p(np.exp(-true))).sum() + (weight[:, None] * np.log1p(np.exp(scores[:, noise]))).sum())

    g_near, g_far, g_true, g_false, places = bilinear.gradients(v, one, two, target, noise, weight, noise_score)
    context, output = np.zeros((7, 4)), np.zeros((7, 5))
    for ids, change, out in ((one, g_near, context), (two, g_far, context), (target, g_true, output), (noise, g_false, output)):
        held, sums = bilinear._by_rows(ids, change)
        out[held] += sums
    for values, slope in ((v.context, context), (v.output, output), (v.places, places)):
        for at in np.ndindex(values.shape):
            kept = values[at]
            values[at] = kept + 1e-5
            up = loss()
            values[at] = kept - 1e-5
            down = loss()
            values[at] = kept
            assert abs((up - down) / 2e-5 - slope[at]) < 1e-4


def test_it_learns_order(spark):
    """Words that follow each other by rule: the model beats unigram counts by far on texts it has not seen."""
    draw = random.Random(8)

    def text():
        at, out = draw.randrange(20), []
        for _ in range(80):
            out.append(f"w{at}")
            at = (at * 7 + draw.choice([1, 2])) % 20
        return " ".join(out)

    rows = [(n, text(), "a") for n in range(400)]
    got = bilinear.score_texts(documents(spark, rows).repartition(3), F.col("id") % 5 == 1).where("held_out").agg(
        F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")
    ).first()
    assert got[0] > got[1] + 0.5


def test_empty_and_only_held_out(spark):
    df = documents(spark, [(1, "a b", "x"), (2, None, "x")])
    assert bilinear.score_texts(df.limit(0), F.lit(False)).count() == 0
    rows = bilinear.score_texts(df, F.lit(True)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}


def test_clashing_columns_and_a_long_text(spark):
    df = documents(spark, [(1, "ab " * 200_000, "x"), (2, "z" * 1_000_000, "x")]).selectExpr("*", "1 as `TEXT`", "2 as `DOC_ID`", "3 as model", "4 as word")
    rows = bilinear.score_texts(df, F.col("id") == 2, rounds=(1,)).collect()
    assert {r["n_tokens"] for r in rows} == {200_001, 2}


def test_registered_query(spark):
    rows = QUERIES["op13_language_model"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import zlib

    docs = [(i, t, None) for i, t in texts.items()]
    want = dict(zip(texts, base(docs, lambda i: zlib.crc32(str(i).encode()) % 5 == 1), strict=True))
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        n, known, total, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and abs(r["base_score"] - score) < 1e-4
