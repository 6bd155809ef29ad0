"""The registered queries of this subpackage."""

from __future__ import annotations

from ledgerloom.llm import alignment, bilinear, exact_dedup, html_crf, lattice, mixing, neighbours, phrases, pii, repeats, simhash, toxicity, url_trust  # noqa: F401
from ledgerloom.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
