"""Leaf blocks of an HTML page, with the features that the extraction model sees."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_STOP = re.compile(r">|=\s*([\"'])")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
#: Fixed: elements that end a block, whose content is no text, and that have no content.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
RAW_TAGS = frozenset("script style textarea iframe".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed: an opening tag that ends an open one of the same group.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_P_ENDS = BLOCK_TAGS - {"button", "label", "option", "legend", "summary", "caption", "p", "select"}
#: Ancestors that a block's features see, nearest first.
DEPTH = 12


@dataclass
class Block:
    """A leaf block: its text, the tags and names of its ancestors, the share of linked text."""

    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    linked: float


def _names(attributes: str) -> tuple[str, ...]:
    found = []
    for m in _ATTRIBUTE.finditer(attributes):
        found += _TOKEN.findall((m[2] or m[3] or m[4] or "").lower())
    return tuple(found)


class Scanner:
    """The markup of a page, in one pass: no place is searched twice for what is not there."""

    def __init__(self, page: str) -> None:
        self.page, self.absent = page, dict.fromkeys((">", '"', "'", "-->", "]]>"), len(page) + 1)

    def find(self, what: str, start: int) -> int:
        """Where ``what`` is next, -1 if nowhere; an answer of nowhere is kept."""
        if start >= self.absent[what]:
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.absent[what] = start
        return at

    def tag_end(self, start: int) -> int:
        """Place of the > that ends a tag whose name ends at ``start``; one in a quoted value does not. -1 if there is none.

        A quote that is never closed is a character of the value.
        """
        at = start
        while self.find(">", at) >= 0:
            stop = _STOP.search(self.page, at)
            if stop[1] is None:
                return stop.start()
            close = self.find(stop[1], stop.end())
            at = stop.end() if close < 0 else close + 1
        return -1 if at == start else self.find(">", start)

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """(kind, text, attributes): kind text, open or close; the last two with the tag's name, lower case."""
        page, at, size = self.page, 0, len(self.page)
        while at < size:
            start = page.find("<", at)
            if start < 0:
                start = size
            if start > at:
                yield "text", page[at:start], ""
            if start == size:
                return
            at = start + 1
            if page.startswith("!--", at):
                end = self.find("-->", at + 3)
                at = size if end < 0 else end + 3
            elif page.startswith("![CDATA[", at):
                end = self.find("]]>", at + 8)
                yield "text", page[at + 8: size if end < 0 else end], ""
                at = size if end < 0 else end + 3
            elif page[at: at + 1] in ("!", "?"):
                end = self.find(">", at)
                if end < 0:
                    yield "text", "<", ""
                else:
                    at = end + 1
            elif name := _NAME.match(page, at):
                end = self.tag_end(name.end())
                if end >= 0:
                    closing = name[0][0] == "/"
                    yield "close" if closing else "open", name[0].lstrip("/").lower(), page[name.end(): end]
                    at = end + 1
                    if not closing and name[0].lower() in RAW_TAGS and not page[name.end(): end].endswith("/"):
                        at = self.raw_end(name[0], at)
                elif page.find("<", at) < 0:
                    return  # a tag that the end of the page cuts off
                else:
                    yield "text", "<", ""
            else:
                yield "text", "<", ""

    def raw_end(self, tag: str, start: int) -> int:
        """Where a script or its like ends; the end of the page if it is not closed."""
        closed = re.compile(rf"</{re.escape(tag)}\b", re.I).search(self.page, start)
        end = self.find(">", closed.end()) if closed else -1
        return len(self.page) if end < 0 else end + 1


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order; unclosed, crossed and cut-off tags do no harm. Null and empty pages have none.

    Pages of any length are read whole, in time that grows with their length. Only scripts, styles, text areas and frames
    have no text; drawings, formulas and their like are parts of the block that holds them.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                near = stack[: -DEPTH - 1: -1]
                out.append(Block(
                    text, tuple(t for t, _ in near), tuple(n for _, names in near for n in names),
                    min(1.0, linked / max(1, sum(map(len, parts)))),
                ))
            parts, linked = [], 0

    def pop_to(at: int) -> None:
        while len(stack) > at:
            opened[stack.pop()[0]] -= 1

    for kind, tag, attributes in Scanner(page or ""):
        if kind == "text":
            parts.append(tag)
            if opened["a"]:
                linked += len(tag)
            continue
        if kind == "close":
            if tag in BLOCK_TAGS:
                close()
            if opened[tag]:
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in RAW_TAGS:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close()
            ends = _ENDS.get(tag, set()) | ({"p"} if tag in _P_ENDS or tag == "p" else set())
            if any(opened[e] for e in ends):
                # an open paragraph, with whatever inline tags are open in it, ends here
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        pop_to(i)
                        break
                    if stack[i][0] in BLOCK_TAGS:
                        break
        if tag not in VOID_TAGS and not attributes.endswith("/"):
            stack.append((tag, _names(attributes)))
            opened[tag] += 1
    close()
    return out


def _bin(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= e for e in edges)


def features(page: list[Block]) -> list[list[str]]:
    """Features of each block: ancestor tags, words of their class, id and role, and the text's shape."""
    out = []
    title = next((b.text for b in page if b.tags[:1] == ("title",)), "")
    for block in page:
        words = block.text.split()
        size = _bin(len(words), (3, 6, 11, 21, 51))
        block_tag = next((t for t in block.tags if t in BLOCK_TAGS), "")
        found = ["bias", f"tag={block_tag}", f"size={size}", f"linked={_bin(block.linked, (0.01, 0.34, 0.67))}"]
        found += [f"in={t}" for t in set(block.tags)]
        found += [f"name={n}" for n in set(block.names)]
        found.append(f"ends={block.text[-1] in '.!?:;…”»'}")
        found.append(f"commas={min(3, block.text.count(','))}")
        found.append(f"tag+size={block_tag}+{size}")
        if any(c in block.text[:80] for c in "©®") or "&middot" in block.text:
            found.append("copyright")
        if title and block_tag != "title" and (block.text.startswith(title[:20]) or title.startswith(block.text[:20])):
            found.append("title")
        out.append(found)
    return out
