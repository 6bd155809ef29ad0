"""Collocations against counts of all phrases by brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import awkward, documents

from ledgerloom.llm import phrases


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def all_counts(rows):
    """(totals by language, counts of (language, words)) of rows (language, text)."""
    totals, counts = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for at in range(len(words) - n + 1):
                    counts[lang or "und", tuple(words[at: at + n])] += 1
    return totals, counts


def brute(rows, least, kept):
    totals, counts = all_counts(rows)
    found = {k: n for k, n in counts.items() if n >= least}
    out = defaultdict(list)
    for (lang, words), a in found.items():
        if len(words) == 1:
            continue
        inside = False
        for (other, more), b in found.items():
            if other == lang and len(more) > len(words) and 100 * b >= 80 * a:
                inside |= any(more[i: i + len(words)] == words for i in range(len(more) - len(words) + 1))
        if inside:
            continue
        score, _, l, r = min(
            (2000000 * a // (found[lang, words[:k]] + found[lang, words[k:]]), k, found[lang, words[:k]], found[lang, words[k:]])
            for k in range(1, len(words))
        )
        out[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -s)
        for lang, rows in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:kept], 1)
    )


def texts(count, seed):
    draw = random.Random(seed)
    words = [f"w{n}" for n in range(12)] + ["é", "Ä", "the", "THE", "x.y"]
    rows = []
    for n in range(count):
        body = [draw.choice(words) for _ in range(draw.randint(0, 25))]
        if draw.random() < 0.3:
            body += "Fixed phrase of four words".split() * draw.randint(1, 3)
        joined = "".join(w + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ; "]) for w in body)
        rows.append((draw.choice(["en", "de", None, "und"]), joined))
    return [*rows, ("en", None), ("en", ""), (None, " \t\n"), ("fr", "."), ("a b", "same same same " * 40), ("en", "z " * 30_000)]


def frame(spark, rows):
    return spark.createDataFrame([(n, t, g) for n, (g, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)


@pytest.mark.parametrize("share", [0, 0.2, 1])
def test_counts_are_exact_whatever_the_sample(spark, share):
    rows = texts(150, 3)
    docs = phrases.pieces_of(frame(spark, rows), "text", "lang")
    found, passes = phrases.frequent_phrases(docs, 5, proposed=phrases.propose(docs, 5, share=share))
    got = Counter()
    for r in found.collect():
        got[r["lang"], tuple(r["phrase"].split(" ")) if r["size"] else ()] += r["n"]
    totals, counts = all_counts(rows)
    assert {k: n for k, n in got.items() if k[1]} == {k: n for k, n in counts.items() if n >= 5}
    assert {k[0]: n for k, n in got.items() if not k[1]} == {k: n for k, n in totals.items() if n}
    # without a proposal each pass adds a word; with one, only failures of the border need another
    assert passes == 4 if not share else passes <= 4


def test_a_good_sample_needs_one_pass(spark):
    docs = phrases.pieces_of(frame(spark, [("en", "a b c d e")] * 400), "text", "lang")
    assert phrases.frequent_phrases(docs, 30, proposed=phrases.propose(docs, 30, share=0.5))[1] == 1


def test_a_border_failure_is_mended(spark):
    """What the filter does not propose is found by further passes."""
    rows = [("en", "p q r s")] * 40 + [("en", "a b")] * 40
    docs = phrases.pieces_of(frame(spark, rows), "text", "lang")
    proposal = phrases.propose(phrases.pieces_of(frame(spark, [("en", "a b")] * 40), "text", "lang"), 30, share=1)
    found, passes = phrases.frequent_phrases(docs, 30, proposed=proposal)
    assert passes == 4
    assert {r["phrase"]: r["n"] for r in found.collect()}["p q r s"] == 40


def test_rare_failures_take_one_more_pass(spark):
    """What a few failures make frequent, of any length, is counted in one pass, together with all that was known before."""
    rows = [("en", "a b c d")] * 4000 + [("en", "p q r s")] * 40 + [("en", "c d p q")] * 35 + [("en", "x a b. b c y")] * 29
    docs = phrases.pieces_of(frame(spark, rows), "text", "lang")
    proposal = phrases.propose(phrases.pieces_of(frame(spark, [("en", "a b c d")] * 60), "text", "lang"), 30, share=1)
    found, passes = phrases.frequent_phrases(docs, 30, proposed=proposal)
    assert passes == 2
    got = Counter()
    for r in found.where("size > 0").collect():
        got[r["lang"], tuple(r["phrase"].split(" "))] += r["n"]
    assert got == {k: n for k, n in all_counts(rows)[1].items() if n >= 30}
    assert ("en", ("p", "q", "r", "s")) in got and ("en", ("c", "d", "p", "q")) in got


@pytest.mark.parametrize("chunk", [phrases.CHUNK, 300])
def test_collocations_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    rows = texts(120, 5)
    got = sorted(tuple(r) for r in phrases.mine(frame(spark, rows), least=4, kept=25).collect())
    assert got == brute(rows, 4, 25)


def test_a_full_filter_changes_no_result(spark, monkeypatch):
    rows = texts(80, 6)
    monkeypatch.setattr(phrases, "FEWEST", 128)
    monkeypatch.setattr(phrases, "MOST", 128)
    got = sorted(tuple(r) for r in phrases.mine(frame(spark, rows), least=4, kept=25).collect())
    assert got == brute(rows, 4, 25)


def test_products_beyond_64_bits(spark):
    big = 3 * 10**14
    found = spark.createDataFrame(
        [("en", "", 0, 9 * big), ("en", "a", 1, 2 * big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)],
        "lang string, phrase string, size int, n long",
    )
    (row,) = phrases.collocations(found).collect()
    assert row["score"] == 2_000_000 * (big - 1) // (3 * big)


def test_awkward_rows(spark):
    df = documents(spark, awkward()).selectExpr("*", "'x' as phrase", "'y' as `TEXT`", "1 as `Lang`")
    assert phrases.mine(df, least=3).where("phrase is null").count() == 0
    assert phrases.mine(df.limit(0)).count() == 0
    assert np.array_equal(phrases.bits_of(np.array([1 << 32], np.uint64), 64), [0, 1])


def test_a_chunk_is_let_go_without_a_collection():
    import gc
    import weakref

    gc.disable()
    try:
        chunk = phrases.Chunk(None, None, 4)
        chunk.add(b"en", b"a b c. a b")
        assert sum(len(held[0]) for held in chunk.counted()) == 4
        held = weakref.ref(chunk)
        del chunk
        assert held() is None
    finally:
        gc.enable()
