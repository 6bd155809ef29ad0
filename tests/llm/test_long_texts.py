"""Personal data, HTML blocks and toxicity against plain rules, on random and on very long texts."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import documents, words

from ledgerloom.llm import html_blocks, html_crf, pii, toxicity

#: The patterns of the contract, as they stand there.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def by_patterns(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [d if n % 2 == 0 else 2 * d - 9 * (d > 4) for n, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_base_spans_equal_the_patterns(seed):
    draw = random.Random(seed)
    pieces = ["a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+49 30 123456", "@", ".", "..", "-", " ", "+", "0", "9", "x_", "%", "é", "(", ")", "\n", "255.1", "a.b@c-d.e.f@g.h"]
    for _ in range(3000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 14)))
        assert pii.base_spans(text) == by_patterns(text), text


def test_spans_apart_from_base_spans():
    draw = random.Random(1)
    for _ in range(500):
        base, at = [], 0
        for _ in range(draw.randint(0, 6)):
            start = at + draw.randint(0, 4)
            at = start + draw.randint(1, 5)
            base.append((draw.choice(pii.KINDS), start, at))
        base.sort(key=lambda x: (pii.KINDS.index(x[0]), x[1]))
        spans = [(draw.choice(pii.KINDS), s, s + draw.randint(1, 6)) for s in (draw.randint(0, 30) for _ in range(8))]
        want = [x for x in spans if not any(x[0] == k and x[1] < e and s < x[2] for k, s, e in base)]
        assert pii.apart(spans, base) == want


LONG = ["1" * 10**6, "a" * 10**6 + "@b", "1." * 500_000, "@" * 10**6, "a@b." * 250_000, "+1" + " " * 10**6, "1 " * 500_000, "f:" * 500_000, "(at)" * 250_000]


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_personal_data_in_a_million_characters(text):
    started = time.perf_counter()
    pii.base_spans(text)
    pii.loose_spans(text)
    assert time.perf_counter() - started < 20


PAGES = [
    '<a "' * 250_000, '<a ="' * 200_000, "<b>" * 150_000 + "</i>" * 150_000, "<b>" * 150_000 + "<hr>" * 150_000, "</script " * 100_000, "<!" * 400_000,
    "<!-- " * 200_000, "<" * 10**6, "<p>" + "<b>" * 100_000 + "<li>x" * 50_000, "<a href='x" * 100_000, "<div>" * 200_000 + "x",
]


@pytest.mark.parametrize("page", PAGES, ids=range(len(PAGES)))
def test_a_page_of_a_million_characters(page):
    started = time.perf_counter()
    html_blocks.blocks(page)
    assert time.perf_counter() - started < 30


@pytest.mark.parametrize(("page", "want"), [
    ('<p title="it>q</p>', ["q"]),
    ('<p title="a>b">q</p>', ["q"]),
    ("<p title=it's>q</p><p>r's</p>", ["q", "r's"]),
    ("<p>before <svg><path></p><p>Lost paragraph.", ["before", "Lost paragraph."]),
    ("<p>sum <math><mi>x</mi>+1</math> of it</p>", ["sum x+1 of it"]),
    ("<p>a <object>b</object> <canvas>c", ["a b c"]),
    ("a<script>if (a < b) '</p>'</script>b<style>p {}</style>c", ["abc"]),
    ("a<script>x", ["a"]),
    ("<p>1 < 2 <3</p>", ["1 < 2 <3"]),
    ("a<!-- <p>b</p> -->c<![CDATA[d<e]]>f<!DOCTYPE x>g<?y?>h", ["acd<efgh"]),
    ("<p>one<p>two<br>three<li>four<td>five", ["one", "two three", "four", "five"]),
    ("<p>cut off <b class", ["cut off"]),
])
def test_blocks(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


def test_a_formula_in_an_article_stays():
    page = (
        "<html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Heading of it</h1>"
        "<p>The first line says that <math><mi>a</mi>=<mi>b</mi></math>, and ends here.</p><p>A second line, with more words in it, follows.</p>"
        "</article><footer>&copy; x &middot; All rights.</footer>"
    )
    assert "that a=b, and ends" in html_crf.main_text(page, html_crf.default_field())


# ---------------------------------------------------------------- toxicity


def naive_matched(text, entries, exceptions):
    """Every place of the folded text against every entry and every exception."""
    folded = toxicity.fold(text)

    def starts(at):
        return at == 0 or not folded[at - 1].isalnum()

    spans = []
    for phrase in map(toxicity.fold, exceptions):
        for at in range(len(folded)):
            end = at + len(phrase)
            if folded.startswith(phrase, at) and starts(at) and not folded[end: end + 1].isalnum():
                spans.append((at, end))
    total = 0.0
    for term, weight in entries:
        for at in range(len(folded)):
            if folded.startswith(term, at) and starts(at) and not any(s <= at and at + len(term) <= e for s, e in spans):
                total += weight
    return total, len(folded.split())


@pytest.mark.parametrize("seed", range(4))
def test_matches_equal_a_naive_scan(seed):
    draw = random.Random(seed)
    pieces = ["trash", "can", "candidate", "trash can", "tr4sh", "scum", "pond scum", "ponds", "cum", "x", "-", ",", "trashcan", "a trash can t", "pond", "loser"]
    entries = (("scum", 2.0), ("trash", 3.0), ("trash can", 0.5), ("lose", 1.0))
    for _ in range(400):
        text = draw.choice([" ", "  "]).join(draw.choice(pieces) for _ in range(draw.randint(0, 9)))
        folded = tuple((toxicity.fold(t), w) for t, w in entries)
        got = toxicity.matched(text, folded)
        assert got == pytest.approx(naive_matched(text, folded, toxicity.EXCEPTIONS)), text


def test_exceptions_are_whole_phrases():
    entries = (("trash", 3.0),)
    assert toxicity.matched("you are trash candidate", entries)[0] == 3.0
    assert toxicity.matched("the trash can is full", entries)[0] == 0.0
    assert toxicity.matched("my trash can: trash", entries)[0] == 3.0


def test_a_long_text_is_matched_in_one_pass():
    started = time.perf_counter()
    assert toxicity.matched("trash can trash " * 100_000, (("trash", 1.0),))[0] == 100_000
    assert time.perf_counter() - started < 30


def test_lexicon_equals_a_naive_count(spark):
    rows = [(n, (words(12, n) + (" vilewordly" if n % 3 == 0 else "") + (" bad" if n % 5 == 0 else ""), int(n % 3 == 0))) for n in range(120)]
    df = spark.createDataFrame([(t, y) for _, (t, y) in rows], "text string, label int")
    got = toxicity.learn_lexicon(df)
    bad, good = sum(y for _, (_, y) in rows), sum(1 - y for _, (_, y) in rows)
    held: dict[str, list[int]] = {}
    for _, (t, y) in rows:
        for term in {b for w in toxicity._TOKEN.findall(toxicity.fold(t)) for b in toxicity._beginnings(w)}:
            held.setdefault(term, [0, 0])[y] += 1
    weight = {t: np.log((c[1] + 0.5) / (bad + 1)) - np.log((c[0] + 0.5) / (good + 1)) for t, c in held.items()}
    strong = sorted((t for t, c in held.items() if c[1] >= toxicity.SUPPORT and weight[t] >= toxicity.LEAST_WEIGHT), key=lambda t: (-held[t][1], -len(t), t))
    want: dict[str, float] = {}
    for t in strong:
        if not any(x.startswith(t) or t.startswith(x) for x in want):
            want[t] = weight[t]
    assert got.keys() == want.keys() and got == pytest.approx(want) and "vlleword" in " ".join(got)


def test_clashing_columns_of_the_filter(spark):
    rows = [(n, words(30, n) + (" vileword" if n % 4 == 0 else ""), "a") for n in range(200)]
    labels = spark.createDataFrame([(n, 1, int(n % 4 == 0)) for n in range(200)], "doc_id bigint, quality int, toxic int")
    df = documents(spark, rows).selectExpr("*", "'x' AS `TEXT`", "1 AS `DOC_ID`", "2 AS c0")
    out = toxicity.drop_toxic(df, labels)
    assert out.columns == df.columns and out.count() == 150
    repeated = documents(spark, rows + rows)
    assert toxicity.drop_toxic(repeated, labels).count() == 300
    model = toxicity.fit(repeated, labels)
    assert model.score(repeated).where(F.col("score") >= 0.5).count() == 100
