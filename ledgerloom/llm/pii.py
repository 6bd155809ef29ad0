"""Personal data by weak supervision.

The base patterns find what a fixed rule calls personal data. Looser patterns propose further spans;
labelers (pattern shape, checksum, gazetteer of cue words, context, surroundings) vote
on every span or abstain. Expectation-maximisation estimates how reliable each labeler is from the counts of
vote patterns, of which there are at most 3 ** labelers whatever the corpus; the posteriors train
a logistic classifier on the spans' features, again from counts. Base spans stay in any case; a proposed span
is added if the classifier says so.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import pick, query, table
from ledgerloom.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
#: Fixed: parts of the base patterns. An address is a run before an @ and a domain behind it; an ip is four numbers
#: of a chain. Found from these parts a text is read once, however long its runs are.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A loose address must hold one of these.
_AT = re.compile(r"[\[(]\s?at\s?[\])]")
#: Looser patterns: what else may be personal data of a kind.
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{2,64}\s?[\[(]\s?at\s?[\])]\s?[A-Za-z0-9-]+(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\.)[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./-][0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+(.-])(?:00[1-9][0-9\x20().-]{7,17}[0-9]|\([0-9]{3}\)\x20?[0-9]{3}[-.\x20][0-9]{4}|[0-9]{3}[-.\x20][0-9]{3}[-.\x20][0-9]{4})(?![0-9-])"),
}
#: Fixed: words before a span that name its kind, lower case.
CUES = {
    "email": ("email", "e-mail", "mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "from", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "telephone", "whatsapp"),
}
#: Fixed: words before a number that say it is no personal data.
ANTI = ("version", "isbn", "order", "invoice", "page", "article", "section", "id", "no", "ref", "sku", "serial")
#: Characters before and after a span that the labelers see.
CONTEXT = 40
LABELERS = ("shape", "checksum", "cue", "anti", "alone", "base")
ROUNDS = 50


def luhn(digits: str) -> bool:
    """Whether the check digit of a number is right."""
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (1 + n % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


_NO_DIGIT = re.compile(r"[^0-9]+")


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))
    if kind == "email":
        return True
    digits = _NO_DIGIT.sub("", text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of run, @ and domain; a domain's end may cut the front of the next run."""
    end = 0
    for run in _LOCAL.finditer(text) if "@" in text else ():
        if run.end() > end and text[run.end(): run.end() + 1] == "@":
            domain = _DOMAIN.match(text, run.end() + 1)
            if domain:
                yield max(run.start(), end), domain.end()
                end = domain.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers in a row of every chain of numbers between single dots, then the next four."""
    for chain in _CHAIN.finditer(text) if "." in text else ():
        if chain.group().count(".") >= 3:
            numbers = [m.span() for m in _NUMBER.finditer(text, chain.start(), chain.end())]
            for at in range(0, len(numbers) - 3, 4):
                yield numbers[at][0], numbers[at + 3][1]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end) by kind as listed, then start; failing matches are dropped."""
    found = {
        "email": _emails(text), "ip": _ips(text), "card": (m.span() for m in _CARD.finditer(text)),
        "phone": (m.span() for m in _PHONE.finditer(text)) if "+" in text else (),
    }
    return [(kind, s, e) for kind in KINDS for s, e in found[kind] if _valid(kind, text[s:e])]


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    """Proposed spans, by kind and start."""
    return [
        (kind, m.start(), m.end()) for kind in KINDS if kind != "email" or _AT.search(text) for m in LOOSE[kind].finditer(text)
    ]


def apart(spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that touch no base span of their kind; base spans of a kind do not overlap and are in order."""
    edges = {kind: ([s for k, s, _ in base if k == kind], [e for k, _, e in base if k == kind]) for kind in KINDS}

    def touches(kind: str, start: int, end: int) -> bool:
        starts, ends = edges[kind]
        at = bisect_right(ends, start)
        return at < len(starts) and starts[at] < end

    return [x for x in spans if not touches(*x)]


_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def votes(text: str, kind: str, start: int, end: int, is_base: bool) -> tuple[int, ...]:
    """A vote of each labeler: 1 for personal data, 0 against, -1 for none."""
    span = text[start:end]
    digits = _NO_DIGIT.sub("", span)
    before = text[max(0, start - CONTEXT): start].lower()
    words = _WORD.findall(before)[-4:]
    left, right = text[start - 1: start], text[end: end + 1]
    if kind == "email":
        shape = int("." in span.rpartition("@")[2] or "dot" in span)
        check = -1
    elif kind == "ip":
        shape = 1
        check = int(_valid("ip", span)) if "." in span else -1
    elif kind == "card":
        shape = int(len(digits) == 16 and digits[:1] in "23456")
        check = int(luhn(digits)) if digits else 0
    else:
        shape = int(span[:1] in "+(" or span[:2] == "00" or len(digits) == 10)
        check = int(8 <= len(digits) <= 15)
    cue = 1 if any(w in CUES[kind] for w in words) else -1
    anti = 0 if words and words[-1] in ANTI else -1
    alone = int(not (left.isalnum() or right.isalnum()))
    return shape, check, cue, anti, alone, 1 if is_base else -1


def fit_reliability(counts: dict[tuple[str, tuple[int, ...]], int], rounds: int = ROUNDS) -> dict:
    """EM over counts of (kind, vote pattern): per kind a prior and each labeler's vote rates for yes and no.

    Labelers are taken as independent given the truth. Rates start from trust in a vote and are held
    to their side by pseudo-counts, so that a labeler that always votes alike cannot turn the classes around.
    """
    model = {}
    for kind in KINDS:
        seen = [(v, n) for (k, v), n in counts.items() if k == kind]
        prior, rates = 0.5, [((0.2, 0.8), (0.8, 0.2)) for _ in LABELERS]
        for _ in range(rounds if seen else 0):
            yes_total = no_total = 0.0
            table_ = [[[1.0, 4.0], [4.0, 1.0]] for _ in LABELERS]
            for pattern, n in seen:
                p = posterior(prior, rates, pattern)
                yes_total += n * p
                no_total += n * (1 - p)
                for at, vote in enumerate(pattern):
                    if vote >= 0:
                        table_[at][0][vote] += n * p
                        table_[at][1][vote] += n * (1 - p)
            prior = (yes_total + 1) / (yes_total + no_total + 2)
            rates = [tuple((y[0] / sum(y), y[1] / sum(y)) for y in side) for side in table_]
        model[kind] = (prior, rates)
    return model


def posterior(prior: float, rates: list, pattern: tuple[int, ...]) -> float:
    """Probability that a span with these votes is personal data."""
    odds = math.log(prior / (1 - prior))
    for (yes, no), vote in zip(rates, pattern, strict=True):
        if vote >= 0:
            odds += math.log(yes[vote] / no[vote])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _features(kind: str, pattern: tuple[int, ...]) -> list[float]:
    out = [1.0] + [float(kind == k) for k in KINDS]
    for vote in pattern:
        out += [float(vote == 1), float(vote == 0)]
    return out


@dataclass(frozen=True)
class SpanModel:
    """Labeler reliabilities and the weights of the span classifier."""

    reliability: dict
    weights: tuple[float, ...]

    def probability(self, kind: str, pattern: tuple[int, ...]) -> float:
        z = sum(w * f for w, f in zip(self.weights, _features(kind, pattern), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every input row: kind, start, end (code points, end exclusive), base flag and votes of each span.

    Null and empty texts have no spans. Proposed spans that touch a base span of their kind are left out. Texts of any length
    are read whole, in time that grows with their length; a labeler sees ``CONTEXT`` characters and the last four
    words before a span. Repeated ids and rows stay rows of their own; other columns are ignored, whatever their names.
    """
    rows = pick(docs, id=id_col, text=text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                more = apart(loose_spans(text), base)
                out.append([
                    {"kind": k, "start": s, "end": e, "base": own, "votes": list(votes(text, k, s, e, own))}
                    for own, spans in ((True, base), (False, more)) for k, s, e in spans
                ])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind_)], ["id", "spans"])

    import pyarrow as pa

    kind_ = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.list_(pa.int32())),
    ]))
    return rows.mapInArrow(
        run, f"id {rows.schema['id'].dataType.simpleString()}, "
        "spans array<struct<kind:string,start:bigint,end:bigint,base:boolean,votes:array<int>>>",
    )


def fit(found: DataFrame) -> SpanModel:
    """Reliabilities and classifier from all spans of ``candidates``; only counts of vote patterns reach the driver."""
    import numpy as np

    patterns = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n"))
    # at most len(KINDS) * 3 ** len(LABELERS) rows
    counts = {(r["kind"], tuple(r["votes"])): r["n"] for r in patterns.collect()}
    reliability = fit_reliability(counts)
    if not counts:
        return SpanModel(reliability, tuple([-30.0] + [0.0] * (len(_features("", (0,) * len(LABELERS))) - 1)))
    keys = sorted(counts)
    p = np.array([posterior(*reliability[k], v) for k, v in keys])
    # counts are scaled to a fixed total, so that the ridge weighs alike at every size
    n = np.array([counts[k] for k in keys], float)
    n *= 1000.0 / n.sum()
    x = np.array([_features(k, v) for k, v in keys])
    beta = np.zeros(x.shape[1])
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + np.eye(len(beta)), x.T @ (n * (p - q)) - beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return SpanModel(reliability, tuple(beta.tolist()))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, spans) of every input row: kind, start, end, base and probability of the spans that stand, by kind and start.

    Base spans always stand; proposed ones from ``threshold``.
    """
    found = stage(candidates(docs, id_col, text_col), "pii-spans")
    model = fit(found)
    patterns = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes").distinct().collect()
    known = {(r["kind"], tuple(r["votes"])): model.probability(r["kind"], tuple(r["votes"])) for r in patterns}
    if not known:
        empty = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,probability:double>>"
        return found.select("id", F.array().cast(empty).alias("spans"))
    pairs = F.create_map(*[x for (k, v), p in known.items() for x in (F.lit(k + ":" + ",".join(map(str, v))), F.lit(p))])
    order = F.create_map(*[x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))])
    scored = F.transform("spans", lambda s: F.struct(
        order[s["kind"]].alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"),
        pairs[F.concat(s["kind"], F.lit(":"), F.concat_ws(",", F.transform(s["votes"], lambda v: v.cast("string"))))].alias("probability"),
    ))
    standing = F.array_sort(F.filter(scored, lambda s: s["base"] | (s["probability"] >= threshold)))
    return found.select("id", F.transform(standing, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), s["probability"].alias("probability"),
    )).alias("spans"))


@query("op8_pii")
def op8(spark: SparkSession, root: str) -> DataFrame:
    """Every document's personal data: base counts and digest, and all spans."""
    found = personal_data(table(spark, root, "documents"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
