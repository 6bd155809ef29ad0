"""Small tables with the awkward rows every operator has to bear."""

from __future__ import annotations

import random

WORDS = "anea ble con der esta fin gor han ist jul kel lor men nor opa pri qua ros sed tul und ver wix yon zet".split()


def words(count: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(WORDS) for _ in range(draw.randint(1, 3))) for _ in range(count))


def documents(spark, rows: list[tuple], extra: bool = True):
    """documents with columns that clash in name or case with those of operators."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(full, schema)
    if not extra:
        return df
    from pyspark.sql import functions as F

    clash = {"id": "x", "digest": "x", "size": "x", "row": "x", "block": "x", "place": "x", "key": "x", "label": "x", "score": "x"}
    return df.withColumns({k: F.lit(v) for k, v in clash.items()})


def awkward(seed: int = 1) -> list[tuple]:
    base = words(80, seed)
    long = words(9000, seed + 1)
    passage = words(30, seed + 2)
    rows = [
        (1, base, "b"), (2, base, "b"), (3, base.upper(), "a"), (4, None, None), (5, "", "c"), (6, "   \n\t", "c"), (7, long, "a"),
        (8, long + " end", "a"), (9, "x", None), (10, "é" * 60, "ä"), (11, "ab" * 100, "b"), (12, "ab" * 90, "b"),
        (None, base, "b"), (13, words(40, 9) + " " + passage + " " + words(40, 10), "a"), (14, passage, "a"),
        (15, words(20, 11) + " " + passage, "c"), (15, words(20, 11) + " " + passage, "c"), (15, "other text of one id", "c"),
        (16, "▁ mark  two  spaces\r\nline", "b"), (17, "w" * 300, "b"),
    ]
    return rows + [(100 + n, base + " tail" * (n % 3), "b") for n in range(12)]
