"""Toxicity, personal data, HTML extraction, url verdicts, mixing, encoding and neighbours."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import awkward, documents, words

from ledgerloom.llm import html_blocks, html_crf, html_pages, lattice, mixing, neighbours, pii, toxicity, url_trust


# toxicity


def toxic_tables(spark):
    rows, labels = [], []
    for n in range(300):
        bad = n % 4 == 0
        text = words(40, n) + (" what an vileword you are" if bad else "") + " " + words(20, 1000 + n)
        rows.append((n, text, "a"))
        labels.append((n, 1, int(bad)))
    rows += [(900, None, "a"), (901, "", "a"), (902, "V1LEW0RD all over", "a"), (903, "vіlеword", "a"), (None, "vileword", "a")]
    return documents(spark, rows), spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")


def test_toxicity_finds_folded_words(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.fit(docs, labels)
    assert "vlleword" in dict(model.entries)
    got = {r["id"]: r["score"] for r in model.score(docs).collect()}
    assert len(got) == docs.count()
    assert all((got[n] >= 0.5) == (n % 4 == 0) for n in range(300))
    assert got[902] >= 0.5 and got[903] >= 0.5 and got[None] >= 0.5 and got[900] < 0.5 and got[901] < 0.5
    out = toxicity.drop_toxic(docs, labels)
    assert out.columns == docs.columns and out.count() == 225 + 2


def test_toxicity_without_labels(spark):
    docs, labels = toxic_tables(spark)
    assert toxicity.fit(docs, labels.limit(0)).score(docs).where("score >= 0.5").count() == 0
    assert toxicity.fit(docs.limit(0), labels).score(docs.limit(0)).count() == 0


def test_exception_phrases_and_word_starts():
    entries = (("clown", 5.0),)
    assert toxicity.matched("a clown fish and a clown", entries) == (5.0, 6)
    assert toxicity.matched("uncrownclown", entries)[0] == 0.0
    assert toxicity.fold("CL0WN") == toxicity.fold("clown") and toxicity.fold(None) == ""


# personal data


def test_base_spans_by_rule():
    text = "a.b@mail.example.com, x@y; 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 4111 1111 1111 1111 4111111111111112 +1 (223) 555-0305 +12"
    found = [(k, text[s:e]) for k, s, e in pii.base_spans(text)]
    assert ("email", "a.b@mail.example.com") in found and ("ip", "1.2.3.4") in found and ("ip", "5.6.7.8") in found
    assert ("ip", "999.1.1.1") not in found and ("phone", "+1 (223) 555-0305") in found
    assert not any(k == "phone" and t == "+12" for k, t in found)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert [k for k, _, _ in pii.base_spans(text)] == sorted((k for k, _, _ in pii.base_spans(text)), key=pii.KINDS.index)


def test_personal_data_rows(spark):
    rows = awkward() + [
        (500 + n, f"call me on +1 (223) 555-{n:04d} or n{n}@mail.example.com from 10.0.0.{n} {words(5, n)}", "a") for n in range(40)
    ] + [(600, "phone (223) 555-0305 please", "a"), (601, "write to joe [at] mail [dot] org", "a"), (602, "é +1 (223) 555-0305", "a")]
    got = {r["id"]: [(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]] for r in pii.personal_data(documents(spark, rows)).collect()}
    assert len(got) == len({i for i, _, _ in rows})
    assert got[602] == [("phone", 2, 19, True)] and got[4] == [] and got[5] == []
    assert [k for k, *_ in got[500]] == ["email", "ip", "phone"]
    assert got[600] == [("phone", 6, 20, False)] and got[601][0][0] == "email" and not got[601][0][3]
    assert pii.personal_data(documents(spark, rows).limit(0)).count() == 0


def test_reliability_orders_labelers():
    good, bad = (1, 1, 1, -1, 1, 1), (0, 0, -1, 0, 0, -1)
    model = pii.fit_reliability({("phone", good): 80, ("phone", bad): 20, ("phone", (1, 1, -1, -1, 1, -1)): 10})
    prior, rates = model["phone"]
    assert prior > 0.7 and all(yes[1] > no[1] for yes, no in rates)
    assert pii.posterior(prior, rates, good) > 0.9 > 0.1 > pii.posterior(prior, rates, bad)


# HTML


def test_field_on_held_out_pages():
    field = html_crf.default_field()
    right = total = 0
    for page, labels in html_pages.labelled_pages(120, seed=99):
        got = field.decode(html_blocks.features(html_blocks.blocks(page)))
        if len(got) == len(labels):
            right += sum(a == b for a, b in zip(got, labels, strict=True))
            total += len(labels)
    assert total > 2000 and right / total > 0.98


def test_viterbi_against_all_paths():
    import itertools

    field = html_crf.Field({"a": 1.5, "b": -0.7, "c": 0.2}, ((0.3, -0.4), (-0.6, 0.5)))
    page = [["a"], ["b", "c"], ["b"], ["c"], ["a", "b"]]

    def score(path):
        own = sum(sum(field.weights[f] for f in block) for block, label in zip(page, path, strict=True) if label)
        return own + sum(field.moves[x][y] for x, y in itertools.pairwise(path))

    assert field.decode(page) == list(max(itertools.product((0, 1), repeat=len(page)), key=score))
    assert field.decode([]) == []


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></div>", "<div " * 50, "<script>x", "<!-- open", "plain &amp; text", "<p>" * 3000 + "x"])
def test_broken_pages(page):
    assert isinstance(html_crf.main_text(page, html_crf.default_field()), str)


def test_extraction(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy this now.</div>"
        "<article><h1>Heading of it</h1><p>First &amp; <b>best</b>\n  line, with words.<br>More of it here.<p>Second line &eacute; here, too.</article>"
        "<div class='comments'><div class='comment'><p>I like it, said the reader.</p></div></div><footer>&copy; x &middot; All rights.</footer>"
    )
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", "")], "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = {r["id"]: r["text"] for r in html_crf.extract(df, html_crf.default_field()).collect()}
    assert got == {1: "Heading of it\nFirst & best line, with words. More of it here.\nSecond line é here, too.", 2: "", 3: ""}


# urls


def test_host_and_path(spark):
    urls = [
        (1, "http://A.Example.NET/en/x?y#z"), (2, "no scheme"), (3, None), (4, "https://org?x"), (5, "https://a.org/fr/1"), (6, "x://b.example.com/de/"),
        (7, "http://example.com/en/a"), (8, "http://net/"), (9, "http://notexample.net/en/"), (10, "http://h#f://i/"), (11, ""),
    ]
    df = spark.createDataFrame([(i, u, None) for i, u in urls], "page_id bigint, url string, html string").withColumn("host", F.lit(0))
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_trust.judge(df).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2] == ("", "", None, "allow") == got[3]
    assert got[4][:3] == ("org", "", None) and got[5][2:] == ("org/fr/", "allow") and got[6][2:] == ("example.com/de/", "block")
    assert got[8][2:] == ("net/", "block") and got[9][2:] == ("net/", "block") and got[10][:2] == ("h", "")
    assert url_trust.judge(df.limit(0)).count() == 0


def test_scores_against_a_dense_iteration(spark):
    draw = np.random.default_rng(3)
    n = np.triu(draw.integers(0, 3, (12, 12))) + np.tril(draw.integers(0, 2, (12, 12)))
    n[4, :] = 0
    n[:, 7] = 0
    hosts = [f"h{i}" for i in range(12)]
    links = spark.createDataFrame([(hosts[i], hosts[j], float(n[i, j])) for i in range(12) for j in range(12) if n[i, j]], "source string, target string, n double")
    seeds = spark.createDataFrame([(h, float(i % 3 == 0), float(i % 5 == 1)) for i, h in enumerate(hosts)], "host string, allowed double, blocked double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_trust.host_scores(links, seeds).collect()}

    def walk(matrix, seed):
        rows = matrix.sum(axis=1, keepdims=True)
        share = np.where(rows > 0, matrix / np.maximum(rows, 1), np.eye(len(matrix)))
        p = seed.copy()
        for _ in range(300):
            p = (1 - url_trust.DAMPING) * seed + url_trust.DAMPING * p @ share
        return p

    trust = walk(n.astype(float), np.array([float(i % 3 == 0) for i in range(12)]))
    distrust = walk(n.T.astype(float), np.array([float(i % 5 == 1) for i in range(12)]))
    for i, h in enumerate(hosts):
        assert got[h] == pytest.approx((trust[i], distrust[i]), abs=2e-3)


def test_a_host_that_links_to_a_blocked_one(spark):
    link = "<a href='http://bad.net/x'>x</a>"
    rows = [(1, "http://bad.net/x", ""), (2, "http://farm.com/a", link * 9), (3, "http://fine.com/a", "<a class=q href=/own>x</a>")]
    got = {r["id"]: r["verdict"] for r in url_trust.judge(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}


# mixing


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(order)}
    total, target = mixing.SHARE * sum(sizes.values()), dict.fromkeys(sizes, 0.0)
    full: set = set()
    while True:
        rest = total - sum(2.0 * sizes[s] for s in full)
        free = [s for s in sizes if s not in full]
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in free) for s in sizes}
        over = {s for s in free if target[s] > 2.0 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing(spark):
    rows = awkward() + [(700 + n, words(30 + n % 50, n), f"s{n % 4}") for n in range(300)]
    df = documents(spark, rows)
    got = mixing.plan_mix(df).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(4.0, 0.05 * t)
    again = sorted((r["id"] or -1, r["size"], r["taken"]) for r in mixing.plan_mix(df.repartition(5)).collect())
    assert again == sorted((r["id"] or -1, r["size"], r["taken"]) for r in got)
    assert mixing.plan_mix(df.limit(0)).count() == 0


def brute_mix(spark, rows):
    """The schedule, slot by slot, as (source, block, [(id, begin, words)]), and the words taken of every row, in plain Python."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, sizes, strict=True):
        total[s] += n
    targets = brute_targets(dict(total))
    hashed = spark.createDataFrame([(n, i, t) for n, (i, t, _) in enumerate(rows)], "n int, i bigint, t string").selectExpr(
        "n", "xxhash64(i, xxhash64(t)) & 9223372036854775807 AS at", "xxhash64(t) AS mark"
    ).collect()
    place = {r["n"]: (r["at"], rows[r["n"]][0] is not None, rows[r["n"]][0] or 0, r["mark"], r["n"]) for r in hashed}
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + ([None] if None in total else [])
    block = {s: max(1, min(mixing.BLOCK_WORDS, total[s] // mixing.PARTS)) for s in order}
    wanted = {s: targets[s] / block[s] for s in order}
    edges, ends = 0.0, []
    for s in order:
        edges += wanted[s]
        ends.append(edges)
    stream, at = {s: [] for s in order}, dict.fromkeys(order, 0)
    for n in sorted(range(len(rows)), key=place.get):
        s = rows[n][2]
        stream[s].append((n, at[s], at[s] + sizes[n]))
        at[s] += sizes[n]
    out, used, taken = [], Counter(), Counter()
    for t in range(math.ceil(edges)):
        u = math.fmod(t * mixing.GOLDEN, 1.0)
        s = next(s for s, e in zip(order, ends, strict=True) if u * edges < e or s == order[-1])
        if used[s] >= math.ceil(wanted[s]):
            continue
        number = used[s] % max(1, -(-total[s] // block[s]))
        used[s] += 1
        low, high = number * block[s], (number + 1) * block[s]
        parts = [(n, max(a, low) - a, min(b, high) - max(a, low)) for n, a, b in stream[s] if max(a, low) < min(b, high)]
        for n, _, words in parts:
            taken[n] += words
        out.append((t, s, number, [(rows[n][0], begin, k) for n, begin, k in parts]))
    return out, taken


def test_schedule_equals_brute_force(spark):
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 3000] + [(700 + n, words(5 + n % 50, n), f"s{n % 3}") for n in range(60)]
    rows = [r for n, r in enumerate(rows) if r not in rows[:n]]
    want, taken = brute_mix(spark, rows)
    got = [tuple(r) for r in mixing.schedule(documents(spark, rows)).collect()]
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    assert got == [(t, s, number, i, begin, k) for t, s, number, parts in want for i, begin, k in parts]
    have = Counter()
    for r in mixing.plan_mix(documents(spark, rows)).collect():
        have[r["id"], r["size"]] += r["taken"]
    brute = Counter()
    for n, (i, t, _) in enumerate(rows):
        brute[i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))] += taken[n]
    assert have == brute


def test_every_stretch_of_the_schedule_is_mixed(spark):
    rows = [(n, words(100, n), "abc"[min(n % 10 // 4, 2)]) for n in range(300)]
    slots = sorted({(r["slot"], r["source"]) for r in mixing.schedule(documents(spark, rows)).collect()})
    sources = [s for _, s in slots]
    share = {s: n / len(sources) for s, n in Counter(sources).items()}
    for at in range(0, len(sources), 7):
        held = Counter(sources[at: at + 40])
        assert all(abs(held[s] - share[s] * len(sources[at: at + 40])) <= 4 for s in share)


def test_mixed_rows_hold_the_taken_words_in_order(spark):
    rows = [(n, words(30 + n % 50, n), f"s{n % 4}") for n in range(200)] + awkward()
    df = documents(spark, rows).selectExpr("*", "'x' AS `TEXT`", "'y' AS `DOC_ID`", "1 AS __words", "2 AS __slot", "3 AS c0")
    out = mixing.mix(df)
    assert out.columns == df.columns
    have: dict = {}
    mixed = [tuple(r) for r in out.toDF(*[f"x{n}" for n in range(len(out.columns))]).select("x0", "x1", "x4").collect()]
    for i, text, chars in mixed:
        assert chars == len(text)
        have[i] = have.get(i, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    want: dict = {}
    for r in mixing.plan_mix(df).collect():
        if r["taken"]:
            want[r["id"]] = want.get(r["id"], 0) + r["taken"]
    assert have == want
    # a row stands at the slot that takes its first word
    first = [r["id"] for r in mixing.schedule(df).where("begin = 0").collect()]
    assert Counter(i for i, _, _ in mixed) == Counter(first)
    assert [i for i, _, _ in mixed] == first
    assert mixing.mix(df.limit(0)).count() == 0


# encoding


@pytest.fixture(scope="module")
def pieces():
    return lattice.read_pieces()


@pytest.fixture(scope="module")
def scored(pieces):
    return {p: (s, i) for p, i, s in pieces.rows}, pieces.longest, pieces.unknown


def brute_word(word, pieces, scored):
    scores, longest, unknown = scored
    best = [(0.0, 0, ())]
    for stop in range(1, len(word) + 1):
        paths = []
        for start in range(max(0, stop - longest), stop):
            part = word[start:stop]
            if part in scores:
                paths.append((best[start][0] + scores[part][0], -start, best[start][2] + (scores[part][1],)))
            elif len(part) == 1:
                paths.append((best[start][0] + unknown, -start, best[start][2] + tuple(pieces.byte_ids[b] for b in part.encode())))
        best.append(max(paths, key=lambda p: p[:2]))
    return list(best[-1][2])


def test_encoding_against_brute_force(spark, pieces, scored):
    rows = awkward() + [(800, "Hello  wörld\n\nñandú 漢字 🙂\x00 tab\tend ", "a"), (801, " leading", "a"), (802, "\n", "a"), (803, "a\u2028b\u00a0c", "a")]
    df = documents(spark, rows)
    out = lattice.encode(df, pieces)
    got = out.collect()
    assert len(got) == len(rows) and all(r["exact"] for r in got)
    texts = sorted((i or -1, t or "") for i, t, _ in rows)
    known: dict = {}
    for r, (_, text) in zip(sorted(got, key=lambda r: (r["id"] or -1, len(r["ids"]))), sorted(texts, key=lambda x: (x[0], len(x[1]))), strict=True):
        assert r["n_tokens"] == len(r["ids"])
        for w in lattice.split_words(text):
            if w not in known:
                known[w] = brute_word(w, pieces, scored)
        assert r["ids"] == [i for w in lattice.split_words(text) for i in known[w]]
    back = sorted((r["id"] or -1, r["text"]) for r in lattice.decode(out, pieces).collect())
    assert back == texts
    assert lattice.encode(df.limit(0), pieces).count() == 0


def test_long_runs_and_pieces_over_words_are_encoded_whole(spark, pieces, scored):
    joined = ["".join(words(40, 70 + n).split()) for n in range(6)]
    texts = [*joined, "x " + joined[0] + "." * 150, "漢字" * 90, "aGVsbG8" * 40 + "==", "a_{bc}_{d} $_x;\r\n(_y)\r\n.", "wörter" * 30 + "🙂" * 70]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["id"]: r for r in lattice.encode(df, pieces).collect()}
    assert all(r["exact"] for r in got.values())
    assert [got[n]["ids"] for n in range(len(texts))] == [brute_word(" " + t, pieces, scored) for t in texts]


def test_texts_are_cut_once_and_words_have_the_same_codes_everywhere(spark, pieces, monkeypatch):
    # small blocks, buckets and slices: several of each, and blocks with the same rows
    monkeypatch.setattr(lattice, "BLOCK", 3000)
    monkeypatch.setattr(lattice, "BLOCKS_IN_BUCKET", 2)
    monkeypatch.setattr(lattice, "BUCKETS", 2)
    monkeypatch.setattr(lattice, "PARTITIONS", 1)
    rows = [(n, words(300, n % 4)) for n in range(12)] + [(1, "x" * 70 + " a_b.com, é. ▁!"), (2, None), (3, "")] * 2
    out = lattice.encode(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2, "doc_id"), pieces)
    got = sorted((r["id"], bytes(str(r["ids"]), "utf-8"), r["exact"]) for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one shuffle of blocks, read three times
    assert plan[:plan.find("Initial Plan")].count("ReusedExchange") >= 2
    back = sorted((r["id"], r["text"]) for r in lattice.decode(out, pieces).collect())
    assert back == sorted((i, t or "") for i, t in rows) and all(e for *_, e in got)


def test_cut_gives_the_words_of_every_text(pieces):
    words_of = lattice.Words(pieces)
    signs = ["a", "Straße", "x9", "é", "ɏ", "中", "_", "a_b", ".", ",", "!", "x.", "com.", ".com", "a,", "-", "^", "`", "~", "\u00d7", "3\u00bd", "²"]
    gaps = [" ", " ", " ", " ", "  ", "\n", "\t", " \n", "\u00a0", " \u00a0", "\u2003 ", "\x1f", "\x85", "\r\n", ""]
    draw = random.Random(8)
    texts = ["".join(draw.choice(signs) + draw.choice(gaps) for _ in range(draw.randint(1, 9))) for _ in range(3000)] + [None, "", " ", " a", "a ", "\n"]
    order, message, shares = lattice._cut(pa.array(texts, pa.string()), words_of, 5)
    listed = [w for share in shares for w in share.to_pylist()]
    common, whole, sizes, *slices = map(lattice._numbers, message)
    named = [listed[p] for p in common] + listed
    flat = [named[n] for part in slices for n in part]
    assert len(set(listed)) == len(listed) and whole.all() and len(order) == len(texts)
    for at, end, size in zip(order, np.cumsum(sizes), sizes, strict=True):
        assert flat[end - size: end] == words_of(texts[at])


# neighbours


def vectors(spark, seed=4, count=700, size=24):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, size))
    x = centres[draw.integers(0, 12, count)] + 0.7 * draw.normal(size=(count, size))
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(count)]
    odd = [
        (count, None), (count + 1, [0.0] * size), (count + 2, [float("nan")] * size), (count + 3, [None] * size), (count + 4, [1.0]),
        (None, [1.0] * size), (count + 20, [float("inf")] * size),
    ]
    copies = [(1000 + n, rows[20][1]) for n in range(60)]
    return spark.createDataFrame(rows + odd + copies, "vec_id bigint, embedding array<float>").withColumn("part", F.lit("x")), rows + copies


def test_neighbours(spark):
    df, rows = vectors(spark)
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    got: dict = {}
    for r in neighbours.search(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in ids[ids % 20 == 0].tolist():
        own = x[ids == q][0]
        scores = (x * own).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        exact = dict(zip(ids.tolist(), scores.tolist(), strict=True))
        assert all(s == exact[v] for _, v, s in mine)
        assert all((a[2], -a[1]) >= (b[2], -b[1]) for a, b in zip(mine, mine[1:]))
        hits += len({m[1] for m in mine} & {int(ids[i]) for i in order})
        total += 20
    assert set(got) == set(ids[ids % 20 == 0].tolist()) and hits / total >= 0.9


def test_few_vectors(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(df).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4)]
    assert neighbours.search(df.limit(0)).count() == 0
