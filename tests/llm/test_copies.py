"""Exact copies, repeats and SimHash classes against brute force."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pytest
import xxhash
from samples import awkward, documents, words

from ledgerloom.llm import exact_dedup, repeats, simhash
from ledgerloom.llm.common import components


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(spark):
    rows = awkward()
    got = exact_dedup.exact_groups(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    groups: dict[bytes, list] = {}
    for i, t, _ in rows:
        groups.setdefault(hashlib.sha256(lower(t).encode()).digest(), []).append(i)
    kept: dict[bytes, int] = {}
    for r in got:
        ids = groups[bytes(r["digest"])]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max(i for i in ids if i is not None)
        kept[bytes(r["digest"])] = kept.get(bytes(r["digest"]), 0) + r["kept"]
    assert set(kept.values()) == {1}


def test_exact_rows_and_empty(spark):
    rows = awkward()
    df = documents(spark, rows)
    out = exact_dedup.drop_exact_copies(df)
    assert out.columns == df.columns
    assert out.count() == len({lower(t) for _, t, _ in rows})
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_frequent_digest_is_decided_on_the_map_side(spark):
    df = documents(spark, [(i, "same" if i % 3 == 0 else f"t{i}", "a") for i in range(600)])
    got = {r["id"]: r for r in exact_dedup.exact_groups(df).collect()}
    assert got[0]["keep_id"] == 597 and got[0]["group_size"] == 200 and got[1]["kept"]


def brute_repeats(rows, n=repeats.LENGTH):
    first: dict[bytes, int] = {}
    ids = [repeats.LAST if i is None else i for i, _, _ in rows]
    bodies = [(t or "").encode() for _, t, _ in rows]
    for i, b in zip(ids, bodies, strict=True):
        for p in range(len(b) - n + 1):
            first[b[p: p + n]] = min(first.get(b[p: p + n], i), i)
    out = []
    for i, b in zip(ids, bodies, strict=True):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if first[b[p: p + n]] < i:
                gone[p: p + n] = True
        turn = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int))).reshape(-1, 2)
        out.append((i, len(b), [tuple(x) for x in turn.tolist()], np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out)


@pytest.mark.parametrize("block", [2_000_000, 3000])
def test_repeats(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "BUCKET", 4 * block)
    monkeypatch.setattr(repeats, "SUFFIXES", 500)
    rows = awkward() + [(200 + n, words(60, 50 + n % 4) + words(3, n), "a") for n in range(20)]
    got = repeats.remove_repeats(documents(spark, rows)).collect()
    have = sorted(
        (repeats.LAST if r["id"] is None else r["id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got
    )
    assert have == brute_repeats(rows)
    assert repeats.remove_repeats(documents(spark, rows).limit(0)).count() == 0


def test_prefix_intervals():
    # common prefixes of sorted neighbours, and all their intervals of length 2 or more
    found = repeats.prefix_intervals(np.array([3, 5, 5, 3, 0, 2]), 2)
    assert sorted(found) == [(0, 4, 3), (1, 3, 5), (5, 6, 2)]


def test_repeat_groups_have_all_occurrences():
    core = words(20, 3)[:60].encode()
    texts = [b"x" + core + b"p", b"y" + core + b"q", b"z" + core + b"r"]
    lengths = np.array([len(t) for t in texts])
    text, start, length, low = repeats.repeat_groups(
        b"".join(texts), np.cumsum(lengths) - lengths, lengths, np.array([5, 3, 9]), np.array([5, 3, 9])
    )
    assert sorted(zip(text.tolist(), start.tolist(), length.tolist(), low.tolist(), strict=True)) == [
        (0, 1, 60, 3), (1, 1, 60, 3), (2, 1, 60, 3)
    ]


def brute_print(text, n):
    parts = lower(text).encode().split()
    if not parts:
        return 0
    grams = [b" ".join(parts[i: i + n]) for i in range(max(1, len(parts) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows, limit):
    prints = [brute_print(t, 3) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= limit:
            root[find(a)] = find(b)
    least: dict[int, int] = {}
    for n, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted((-1 if i is None else i, prints[n], least[find(n)]) for n, (i, _, _) in enumerate(rows))


def test_simhash_classes(spark):
    rows = awkward() + [(300 + n, words(200, 70 + n // 5) + f" {words(n % 5, n)}", "a") for n in range(40)]
    df = documents(spark, rows)
    got = simhash.classes(simhash.fingerprints(df, "doc_id", "text", 3)).collect()
    have = sorted((-1 if r["id"] is None else r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in got)
    assert have == brute_classes(rows, 3)
    assert len({r["component_id"] for r in got}) < len({r["fp"] for r in got})
    empty = simhash.classes(simhash.fingerprints(df.limit(0), "doc_id", "text", 3))
    assert empty.count() == 0


@pytest.mark.parametrize("limit", [1, 3, 5])
def test_pigeonring_loses_no_link(spark, limit):
    draw = np.random.default_rng(limit)
    base = draw.integers(0, 1 << 62, 40)
    values = set(base.tolist())
    for b in base.tolist():
        for _ in range(12):
            bits = draw.choice(64, draw.integers(1, limit + 3), replace=False)
            v = b % (1 << 64)
            for bit in bits.tolist():
                v ^= 1 << bit
            values.add(v - (1 << 64) if v >> 63 else v)
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    have = {(r["a"], r["b"]) for r in simhash.links(df, limit).collect()}
    want = {
        (a, b) for a, b in itertools.combinations(sorted(values), 2) if ((a ^ b) % (1 << 64)).bit_count() <= limit
    }
    assert have == want and want


def test_components_of_chains_and_hubs(spark):
    pairs = [(n, n + 1) for n in range(60)] + [(1000, n) for n in range(1001, 1200)] + [(2000, 2000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert {got[n] for n in range(61)} == {0} and {got[n] for n in range(1000, 1200)} == {1000}


def test_near_copies(spark):
    rows = [r for r in awkward() if r[0] != 15] + [(300 + n, words(200, 70 + n // 5) + f" {words(n % 5, n)}", "a") for n in range(40)]
    rows += [(2000, None, "a"), (2001, "", "a"), (2002, " ", "a")]
    df = documents(spark, rows)
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    # of each class of brute force the row with the smallest id stays
    want = sorted({c for _, _, c in brute_classes(rows, 3)})
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == want
    assert simhash.drop_near_copies(df.limit(0)).count() == 0


def test_rows_that_repeat_whole_leave_one(spark):
    rows = [(1, words(50, 1), "a")] * 3 + [(None, words(60, 2), "a")] * 2 + [(5, words(50, 3), "a")]
    df = documents(spark, rows)
    assert simhash.drop_near_copies(df).count() == 3
    assert exact_dedup.drop_exact_copies(df).count() == 3


@pytest.mark.parametrize("drop", [simhash.drop_near_copies, exact_dedup.drop_exact_copies])
def test_clashing_columns_come_back_as_they_were(spark, drop):
    extra = {"TEXT": 1, "DOC_ID": 2, "__id": 3, "__key": 4, "c0": 5, "keep": 6, "fp": 7}
    df = documents(spark, awkward()).selectExpr("*", *[f"{v} AS `{k}`" for k, v in extra.items()])
    out = drop(df)
    assert out.columns == df.columns
    plain = drop(documents(spark, awkward()))
    assert out.count() == plain.count()
    last = out.toDF(*[f"x{n}" for n in range(len(out.columns))]).select(*[f"x{n}" for n in range(len(out.columns) - len(extra), len(out.columns))])
    assert {tuple(r) for r in last.collect()} == {tuple(extra.values())}
