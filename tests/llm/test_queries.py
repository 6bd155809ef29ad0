"""Every registered query of this subpackage and the pipeline, over a small given table: columns, types, digests and whole tables."""

from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from samples import documents

import corpus_pipeline
from ledgerloom.llm import lattice
from ledgerloom.llm.common import is_scan, numbered
from ledgerloom.llm.queries import QUERIES
from ledgerloom.sources.staging import drop_staged, stage

SF = "/root/testdata/sf0.001"
#: Columns and types that the contracts name; more may follow.
COLUMNS = {
    "op1_url_trust": "page_id host:string path:string rule:string verdict:string",
    "op2_exact_dedup": "doc_id keep_id group_size:bigint kept:boolean text_sha256:string",
    "op3_repeats": "doc_id n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    "op4_neighbours": "query_id:bigint rank:int vec_id:bigint score:double",
    "op5_toxicity": "doc_id held_out:boolean score:double predicted:int",
    "op6_html_extraction": "page_id url:string text:string n_chars:bigint",
    "op7_simhash": "doc_id fingerprint:string component_id",
    "op8_pii": "doc_id n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op9_mixing": "doc_id size:bigint source_size:bigint target:double taken:bigint",
    "op10_sentencepiece": "doc_id",
    "op11_cross_tokenizer": "doc_id:bigint n_a:bigint n_b:bigint n_groups:bigint n_links:bigint n_best:bigint count_sum:bigint groups_sha256:string",
    "op12_collocations": "lang:string rank:bigint phrase:string a:bigint l:bigint r:bigint n:bigint score:bigint",
    "op13_language_model": "doc_id held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
}


@pytest.fixture(scope="module")
def found(spark):
    return {name: stage(QUERIES[name](spark, SF), name) for name in COLUMNS}


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_all_are_registered():
    assert QUERIES.keys() == COLUMNS.keys()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(found, texts, spark, name):
    kinds = dict(found[name].dtypes)
    for column in COLUMNS[name].split():
        column, _, kind = column.partition(":")
        assert column in kinds and (not kind or kinds[column] == kind), (column, kinds.get(column))
    if "doc_id" in kinds:
        assert sorted(r["doc_id"] for r in found[name].select("doc_id").collect()) == sorted(texts)
    if "page_id" in kinds:
        assert found[name].count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_digests_of_exact_copies(found, texts):
    for r in found["op2_exact_dedup"].collect():
        assert r["text_sha256"] == hashlib.sha256(lower(texts[r["doc_id"]]).encode()).hexdigest()


def test_digests_of_what_repeats_leave(found, texts):
    """Every 50-byte string of all texts, its smallest document first."""
    first: dict[bytes, int] = {}
    bodies = {i: t.encode() for i, t in sorted(texts.items())}
    for i, b in bodies.items():
        for p in range(len(b) - 49):
            first.setdefault(b[p: p + 50], i)
    for r in found["op3_repeats"].collect():
        body = bodies[r["doc_id"]]
        gone = bytearray(len(body))
        for p in range(len(body) - 49):
            if first[body[p: p + 50]] < r["doc_id"]:
                gone[p: p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(body, gone, strict=True) if not g)
        assert (r["n_bytes"], r["n_removed"]) == (len(body), sum(gone))
        assert r["n_spans"] == len(re.findall(rb"\x01+", bytes(gone))) and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_fingerprints(found, texts):
    for r in found["op7_simhash"].collect():
        parts = lower(texts[r["doc_id"]]).encode().split()
        grams = [b" ".join(parts[i: i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert r["fingerprint"] == f"{bits:016x}"


def test_digests_of_personal_data(found, texts):
    from test_long_texts import by_patterns

    for r in found["op8_pii"].collect():
        base = by_patterns(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r["spans"].split(","))


def test_held_out_documents(found):
    import zlib

    for r in found["op5_toxicity"].collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5)


def test_pipeline(spark, texts):
    """Each stage works on what the one before it kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), "stage")
        kept.append(docs)
        if name != "SentencePiece":
            assert docs.columns == columns
    toxic, exact, near, mixed, encoded = (k.select("doc_id").collect() for k in kept)
    ids = [{r["doc_id"] for r in rows} for rows in (toxic, exact, near, mixed, encoded)]
    assert ids[0] <= set(texts) and ids[1] < ids[0] and ids[2] <= ids[1] and ids[3] <= ids[2] and ids[4] == ids[3]
    # of equal texts one stays, the largest id
    groups: dict[str, int] = {}
    for i in ids[0]:
        groups[lower(texts[i])] = max(groups.get(lower(texts[i]), i), i)
    assert ids[1] == set(groups.values())
    # of near copies one stays: no two of them are left within three bits
    left = QUERIES["op7_simhash"](spark, SF).where(F.col("doc_id").isin(list(ids[2])))
    assert left.groupBy("component_id").count().where("count > 1").isEmpty() or len(ids[2]) == len(ids[1])
    pieces = lattice.read_pieces()
    decoded = lattice.decode(kept[4], pieces, "doc_id")
    assert sorted(map(tuple, decoded.collect())) == sorted((r["doc_id"], r["text"]) for r in kept[3].collect())
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == kept[4].columns and run.count() == kept[4].count()


def test_what_is_not_a_scan_is_staged(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert is_scan(docs) and is_scan(docs.select("text", "doc_id")) and is_scan(docs.selectExpr("*", "1 AS x"))
    shuffled = docs.repartition(3)
    assert not is_scan(shuffled) and not is_scan(docs.where("doc_id > 3")) and not is_scan(documents(spark, [(1, "a", "b")]))
    held, restored = numbered(shuffled)
    assert held.inputFiles() and restored(held).columns == docs.columns
    numbers = [held.select("row", "c0").collect() for _ in range(2)]
    assert sorted(numbers[0]) == sorted(numbers[1]) and len({r["row"] for r in numbers[0]}) == docs.count()
    drop_staged(held)
    with pytest.raises(ValueError):
        drop_staged(docs)
