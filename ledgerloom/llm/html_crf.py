"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A block's label (article or not) depends on its features and on its neighbour's label. The
field is trained by gradient ascent on labelled pages and decoded by Viterbi, page by page, on whole pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, query, table
from ledgerloom.llm.html_blocks import blocks, features

#: Labelled pages of the default training set, and rounds over it.
TRAIN_PAGES, ROUNDS = 800, 120
#: Features seen in fewer blocks are left out.
LEAST_SEEN = 3


@dataclass(frozen=True)
class Field:
    """Weights for the label "article" of each feature, and of neighbouring labels."""

    weights: dict[str, float]
    moves: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, page: list[list[str]]) -> list[int]:
        """Most probable labels of a page's blocks; ties go to "not article"."""
        if not page:
            return []
        get = self.weights.get
        (nn, na), (an, aa) = self.moves
        no, yes, back = 0.0, sum(get(f, 0.0) for f in page[0]), []
        for block in page[1:]:
            score = sum(get(f, 0.0) for f in block)
            from_no = (0 if no + nn >= yes + an else 1, 0 if no + na >= yes + aa else 1)
            no, yes = max(no + nn, yes + an), max(no + na, yes + aa) + score
            back.append(from_no)
        label = 0 if no >= yes else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = ROUNDS, ridge: float = 0.0001) -> Field:
    """Maximum conditional likelihood by Adam over all pages at once; forward and backward sums in log space."""
    import numpy as np

    seen: dict[str, int] = {}
    for page, _ in pages:
        for block in page:
            for f in block:
                seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= LEAST_SEEN))}
    pages = [p for p in pages if p[0]]
    if not pages:
        return Field({}, ((0.0, 0.0), (0.0, 0.0)))
    longest = max(len(p) for p, _ in pages)
    rows = [(n, t, index[f]) for n, (p, _) in enumerate(pages) for t, block in enumerate(p) for f in block if f in index]
    page_at, time_at, feature_at = (np.array(c) for c in zip(*rows, strict=True))
    gold = np.zeros((len(pages), longest))
    there = np.zeros((len(pages), longest), bool)
    for n, (p, labels) in enumerate(pages):
        gold[n, : len(p)], there[n, : len(p)] = labels, True
    pair = there[:, 1:]
    gold_moves = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & pair).sum() for b in (0, 1)] for a in (0, 1)], float)
    total = there.sum()
    w, moves = np.zeros(len(index)), np.zeros((2, 2))
    state = [np.zeros(len(index) + 4), np.zeros(len(index) + 4)]
    for step in range(1, rounds + 1):
        unary = np.zeros((len(pages), longest, 2))
        np.add.at(unary[:, :, 1], (page_at, time_at), w[feature_at])
        ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
        ahead[:, 0] = unary[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.where(
                there[:, t, None], unary[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves[None], axis=1), ahead[:, t - 1]
            )
        for t in range(longest - 2, -1, -1):
            behind[:, t] = np.where(
                there[:, t + 1, None], np.logaddexp.reduce((unary[:, t + 1] + behind[:, t + 1])[:, None, :] + moves[None], axis=2), 0.0
            )
        norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
        chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - norm[:, None]) * there
        both = np.exp(
            ahead[:, :-1, :, None] + moves[None, None] + (unary[:, 1:] + behind[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        ) * pair[:, :, None, None]
        slope = np.bincount(feature_at, (gold - chance)[page_at, time_at], len(index))
        slope = np.r_[slope, (gold_moves - both.sum(axis=(0, 1))).ravel()] / total - ridge * np.r_[w, moves.ravel()]
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope * slope
        change = 0.2 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        w, moves = w + change[:-4], moves + change[-4:].reshape(2, 2)
    return Field({f: float(w[i]) for f, i in index.items()}, tuple(tuple(float(x) for x in r) for r in moves))


@lru_cache(maxsize=2)
def default_field(count: int = TRAIN_PAGES) -> Field:
    """The field of the pages built by rule; the same for every call."""
    from ledgerloom.llm.html_pages import labelled_pages

    found = [(features(blocks(page)), labels) for page, labels in labelled_pages(count)]
    return train([p for p in found if len(p[0]) == len(p[1])])


def main_text(page: str | None, field: Field) -> str:
    """The article's blocks in page order, one line each; empty if there are none."""
    found = blocks(page)
    labels = field.decode(features(found))
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every input row; null and empty pages have an empty text."""
    rows = pick(pages, id=id_col, url=url_col, html=html_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = pa.array([main_text(h.as_py(), field) for h in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["id", "url", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string")


@query("op6_html_extraction")
def op6(spark: SparkSession, root: str) -> DataFrame:
    """Every page's main text and its length."""
    return extract(table(spark, root, "pages"), default_field()).select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )
