"""Cross-tokenizer alignment against whole-text tokenisation and offsets compared one by one."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from samples import awkward, documents
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.common import QUERIES, frequent
from ledgerloom.sources.staging import stage

ODD = [
    "a  b   c \n\n d\t e\x1c f \x85 g 's it's  ' s <|endoftext|> x </s> <s>  ▁ a ▁ b 𝔘 ２ ①", "  lead", "tail ", "\n", " ", "\x00 a",
    "é ̀ b  ́", "لا إله 你好 世界 สวัสดี", "=" * 500 + " " + "-=" * 300, "x" * 3000, "ab " * 2000, "<unk> <0x41> ▁",
]


def tokenizers():
    a = Tokenizer.from_file(alignment.BYTE_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)


def brute(texts):
    """Per text (ids a, ids b, groups as lists of two id lists), by offsets at which both sides end."""
    a_model, b_model = tokenizers()
    back = {c: bytes([b]) for c, b in alignment.byte_alphabet().items()}
    out = []
    for text in texts:
        if not text:
            out.append(([], [], []))
            continue
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_bytes = [b"".join(back[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append(([], [], []))
            continue
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (a_bytes, b_bytes)]
        groups = []
        for cut in sorted(ends[0] & ends[1]):
            groups.append(([], []))
            for side, (ids, values) in enumerate(((a, a_bytes), (b, b_bytes))):
                at = 0
                low = 0 if len(groups) == 1 else last
                for i, v in zip(ids, values, strict=True):
                    at += len(v)
                    if low < at <= cut:
                        groups[-1][side].append(i)
            last = cut
        out.append((a, b, groups))
    return out


def expected(texts):
    found = brute(texts)
    links = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for _, _, groups in found]
    docs = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    rows = []
    for (a, b, groups), c in zip(found, links, strict=True):
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((
            len(a), len(b), len(groups), sum(c.values()), sum(n for p, n in c.items() if docs[p] == top[p[0]]),
            sum(n * docs[p] for p, n in c.items()), hashlib.sha256(shown.encode()).hexdigest() if shown else "",
        ))
    return rows


@pytest.mark.parametrize("most", [alignment.FREQUENT, 20, 0])
def test_alignment_equals_offsets(spark, most):
    texts = [t for _, t, _ in awkward() if t is None or len(t) < 5000] + ODD + ["hello world", "hello world", "hello there"]
    df = documents(spark, [(n // 2, t, "a") for n, t in enumerate(texts)])
    aligned = stage(alignment.align(df), "aligned")
    rows = alignment.link_scores(aligned, most).collect()
    got = sorted((r["id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows)
    assert got == sorted((n // 2, *row) for n, row in enumerate(expected(texts)))
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in rows if r["groups"])


def test_large_groups_count_pairs_instead_of_listing(monkeypatch):
    """Where links of a group are many its pairs are counted; the answer does not depend on how links are held."""
    size = np.array([2, 3, 4, 1])
    # every sixth byte ends both sides: 11 groups of 3 and 2 tokens
    parts = alignment.align_parts([[0] * 33], [[1] * 22], [[0]], np.array([66]), size, size)
    assert [x.tolist() for x in (parts.n_a, parts.n_b, parts.n_groups, parts.n_links)] == [[33], [22], [11], [66]]
    # one group of 31 and 31 tokens beside a part with a group of one token each
    a, b, sizes = [[2] * 30 + [1, 3]], [[1, *[2] * 30, 3]], np.array([1, 0, 123])
    whole = alignment.align_parts(a, b, [[2, 0]], sizes, size, size)
    monkeypatch.setattr(alignment, "LISTED", 10)
    counted = alignment.align_parts(a, b, [[2, 0]], sizes, size, size)
    assert whole.groups == counted.groups and whole.n_groups.tolist() == [1, 0, 1] and whole.n_links.tolist() == [1, 0, 31 * 31]
    assert whole.groups[:2] == ["3|3", ""]

    def links(parts):
        sums = Counter()
        owner = np.repeat(np.arange(3), np.diff(np.r_[0, parts.ends]))
        for o, p, n in zip(owner.tolist(), parts.pairs.tolist(), parts.links.tolist(), strict=True):
            sums[o, p] += n
        return sums

    assert links(whole) == links(counted)


def test_a_megabyte_without_spaces(spark):
    df = documents(spark, [(1, "ab" * 500_000, "a"), (2, "é" * 200_000, "a")])
    rows = alignment.align(df, keep_groups=False).select("id", "n_a", "n_b", "n_links").collect()
    assert all(r["n_links"] >= r["n_a"] > 0 for r in rows)


def test_empty_table_and_extra_columns(spark):
    df = documents(spark, [(1, "one two", "a")])
    odd = df.selectExpr("*", "'x' as pairs", "'x' as n_a", "'y' as `TEXT`", "7 as `DOC_ID`")
    assert [r["n_groups"] for r in alignment.align(odd).collect()] == [2]
    empty = stage(alignment.align(df.limit(0)), "aligned")
    assert alignment.link_scores(empty).count() == 0


def test_frequent_is_bounded_and_splits_all(spark):
    counts = spark.createDataFrame([(i, 1 + 1000 // (i + 1)) for i in range(300)], "k int, n long")
    for most in (0, 1, 7, 100, 1000):
        high, low = frequent(counts, most)
        h, w = high.collect(), low.collect()
        assert len(h) <= most and len(h) + len(w) == 300
        assert not h or not w or min(r["n"] for r in h) > max(r["n"] for r in w)


def test_registered_query(spark):
    rows = QUERIES["op11_cross_tokenizer"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    short = {i: t for i, t in texts.items() if len(t or "") < 400}
    for r in rows:
        if r["doc_id"] in short:
            ((a, b, groups),) = brute([short[r["doc_id"]]])
            assert (r["n_a"], r["n_b"], r["n_groups"]) == (len(a), len(b), len(groups))


def test_parts_that_are_not_given_back_empty_their_text_only():
    pair = alignment.load(alignment.BYTE_MODEL, alignment.PIECE_MODEL)
    kept = pair.b_bytes[5000]
    texts = ["one two", "zwei " + kept.decode().strip() + " drei", "one three", None]
    try:
        pair.b_bytes[5000] = b"?"
        numbers, shown, pairs, links, ends = alignment.align_texts(pair, texts)
    finally:
        pair.b_bytes[5000] = kept
    assert numbers[:, 2].tolist() == [2, 0, 2, 0] or 5000 not in pair.b.encode(texts[1])
    assert shown[3] == "" and ends[3] == ends[2] == len(pairs) == len(links)


def test_links_are_listed_for_a_few_texts_at_a_time(spark, monkeypatch):
    """No slice of a batch lists links of all its texts, and the slices give the rows of the whole."""
    texts = ["a rose is a rose", None, "", "ein Wort   zwei Worte", "x" * 300, "a rose"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    whole = sorted(alignment.align(df).collect(), key=lambda r: r["id"])
    monkeypatch.setattr(alignment, "ROWS", 100)
    assert sorted(alignment.align(df).collect(), key=lambda r: r["id"]) == whole
    pair = alignment.load(alignment.BYTE_MODEL, alignment.PIECE_MODEL)
    held = alignment.Aligned.of(pair, texts)
    parts = [held.rows(at, at + 7) for at in range(0, 119, 7)]
    numbers, shown, pairs, links, ends = alignment.align_texts(pair, texts)
    assert np.array_equal(np.concatenate([p[0] for p in parts]), numbers[:119])
    assert [s for p in parts for s in p[1]] == shown[:119]
    assert np.array_equal(np.concatenate([p[2] for p in parts]), pairs[: ends[118]])
    assert max(len(p[2]) for p in parts) < len(pairs) / 10


def test_runs_hold_every_text_once():
    import pyarrow as pa

    column = pa.array(["abc", None, "", "défg" * 10, "x", "yz"], pa.string())
    assert list(alignment.runs(column, 5)) == [(0, 4), (4, 6)]
    assert list(alignment.runs(column, 1000)) == [(0, 6)]
    assert list(alignment.runs(column.slice(0, 0), 5)) == []
    assert [n for a, b in alignment.runs(column, 1) for n in range(a, b)] == list(range(6))


def test_parts_of_a_batch_are_let_go_with_it():
    import gc

    pair = alignment.load(alignment.BYTE_MODEL, alignment.PIECE_MODEL)
    gc.collect()
    gc.disable()
    try:
        before = sum(isinstance(o, defaultdict) for o in gc.get_objects())
        for n in range(5):
            alignment.align_texts(pair, [f"some text {n}", "another text"])
        assert sum(isinstance(o, defaultdict) for o in gc.get_objects()) == before
    finally:
        gc.enable()
