"""Labelled pages for training: layouts put together by rule, every block with its label.

Containers, class names and block kinds are drawn from lists of what pages commonly use; the text is made of
syllables, so that no model can learn words. One seed gives one set of pages.
"""

from __future__ import annotations

import random

#: Fixed: elements and names that hold an article, and parts of pages that do not belong to it.
ARTICLES = (
    ("article", ""), ("main", ""), ("div", "content"), ("div", "main-content"), ("div", "entry-content"), ("section", "post"),
    ("div", "article-body"), ("div", "story"), ("div", "post-content"), ("article", "post hentry"), ("td", "content"), ("div", "text"),
)
MENUS = (("nav", ""), ("div", "menu"), ("ul", "navbar"), ("div", "navigation"), ("div", "breadcrumb"), ("div", "topnav"), ("nav", "pagination"), ("div", "tags"))
HEADERS = (("header", ""), ("div", "header"), ("div", "masthead"), ("div", "logo"), ("header", "site-header"), ("div", "top-bar"))
FOOTERS = (("footer", ""), ("div", "footer"), ("div", "copyright"), ("footer", "site-footer"), ("div", "bottom"))
SIDES = (("aside", ""), ("div", "sidebar"), ("div", "widget"), ("aside", "related"), ("div", "related-posts"), ("div", "recommended"), ("div", "popular"))
NOTICES = (("div", "cookie-notice"), ("div", "notice"), ("div", "consent"), ("div", "gdpr banner"), ("div", "alert"), ("div", "popup modal"), ("div", "paywall"))
ADVERTS = (("div", "ad"), ("div", "advert"), ("div", "ads"), ("div", "sponsored"), ("div", "promo"), ("aside", "advertisement"), ("div", "banner"), ("ins", "adsbygoogle"))
FORMS = (("form", ""), ("div", "newsletter"), ("form", "search"), ("div", "subscribe"), ("div", "signup"), ("form", "login"))
COMMENTS = (("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "disqus"), ("div", "replies"), ("section", "discussion"), ("div", "reader-comments"))
SHARES = (("div", "share"), ("div", "social"), ("div", "author-bio"), ("div", "meta byline"))
_SYLLABLES = "an en on ti re th er st in at ou es nd ha or le la de ra mi co ve sch ung lich eau ment ción os".split()


class _Page:
    def __init__(self, draw: random.Random) -> None:
        self.draw, self.out, self.labels = draw, [], []

    def words(self, low: int, high: int, stop: bool = True) -> str:
        d = self.draw
        words = ["".join(d.choice(_SYLLABLES) for _ in range(d.randint(1, 3))) for _ in range(d.randint(low, high))]
        for i in range(6, len(words) - 1, d.randint(6, 14)):
            words[i] += d.choice((",", ".", ","))
        text = " ".join(words).capitalize()
        return text + d.choice((".", ".", ".", "!", "?")) if stop else text

    def block(self, tag: str, text: str, label: int, closed: bool = True) -> None:
        self.out.append(f"<{tag}>{text}" + (f"</{tag}>" if closed else ""))
        self.labels.append(label)

    def box(self, kind: tuple[str, str], fill) -> None:
        tag, name = kind
        named = f" {self.draw.choice(('class', 'class', 'id'))}=\"{name}\"" if name else ""
        self.out.append(f"<{tag}{named}>")
        fill()
        self.out.append(f"</{tag}>")

    def links(self, low: int = 2, high: int = 7) -> None:
        self.out.append("<ul>")
        for _ in range(self.draw.randint(low, high)):
            self.block("li", f"<a href=\"/x\">{self.words(1, 4, False)}</a>", 0)
        self.out.append("</ul>")

    def plain(self, low: int = 2, high: int = 25) -> None:
        d = self.draw
        for _ in range(d.randint(1, 2)):
            text = self.words(low, high)
            if d.random() < 0.3:
                text = f"<a href=\"/y\">{text}</a>"
            tag = d.choice(("p", "div", "span", ""))
            if tag in ("p", "div"):
                self.block(tag, text, 0)
            else:
                self.out.append(f"<div>{text}</div>")
                self.labels.append(0)

    def copyright(self) -> None:
        self.out.append(f"&copy; {self.words(1, 3, False)} &middot; {self.words(4, 20)}")
        self.labels.append(0)

    def bare(self, low: int, high: int) -> None:
        self.out.append(self.words(low, high))
        self.labels.append(0)

    def form(self) -> None:
        self.block("label", self.words(1, 4, False), 0)
        self.out.append("<input name=\"q\">")
        self.block("button", self.words(1, 2, False), 0)
        if self.draw.random() < 0.5:
            self.block("p", self.words(4, 20), 0)

    def comments(self) -> None:
        if self.draw.random() < 0.7:
            self.block("h3", self.words(1, 3, False), 0)
        for _ in range(self.draw.randint(1, 5)):
            def one():
                if self.draw.random() < 0.5:
                    self.block("div", self.words(1, 3, False), 0)
                for _ in range(self.draw.randint(1, 2)):
                    self.block("p", self.words(3, 60), 0)
            self.box((self.draw.choice(("div", "li", "article")), self.draw.choice(("comment", "comment-body", "reply", ""))), one)

    def article(self, title: str) -> None:
        d = self.draw

        def fill():
            if d.random() < 0.8:
                self.block(d.choice(("h1", "h1", "h2")), title, 1)
            for _ in range(d.randint(1, 14)):
                pick = d.random()
                if pick < 0.70:
                    text = self.words(1, 5) if d.random() < 0.25 else self.words(2, 110)
                    if d.random() < 0.2:
                        text = "<b>" + text + ("<br>" if d.random() < 0.5 else "</b>")
                        self.block("p", text, 1, d.random() < 0.5)
                        continue
                    if d.random() < 0.2:
                        text += f" <a href=\"/z\">{self.words(1, 4, False)}</a> " + self.words(3, 20)
                    self.block("p", text, 1, d.random() < 0.9)
                elif pick < 0.78:
                    self.block(d.choice(("h2", "h3", "h4")), self.words(1, 8, False), 1)
                elif pick < 0.85:
                    self.out.append("<ul>")
                    for _ in range(d.randint(2, 4)):
                        self.block("li", self.words(2, 20, d.random() < 0.5), 1)
                    self.out.append("</ul>")
                elif pick < 0.90:
                    self.block("blockquote", self.words(8, 40), 1)
                elif pick < 0.93:
                    self.block("pre", self.words(4, 30, False), 1)
                elif pick < 0.95:
                    self.out.append("<table><tr>")
                    for _ in range(d.randint(2, 4)):
                        self.block("td", self.words(1, 8, False), 1)
                    self.out.append("</tr></table>")
                elif pick < 0.975:
                    self.box(d.choice(ADVERTS), lambda: self.bare(2, 25))
                else:
                    self.box(d.choice(SHARES[:2] + SIDES), lambda: self.links(1, 4))

        self.box(d.choice(ARTICLES), fill)

    def build(self) -> tuple[str, list[int]]:
        d = self.draw
        text = self.words(4, 14, False)
        self.out.append(f"<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>{text}</title><style>p{{}}</style><script>var t=\"</p>\";</script></head><body>")
        self.labels.append(0)
        before = [
            (0.4, lambda: self.box(d.choice(HEADERS), self.plain)), (0.8, lambda: self.box(d.choice(MENUS), self.links)),
            (0.4, lambda: self.box(d.choice(NOTICES), self.plain)), (0.3, lambda: self.box(d.choice(FORMS), self.form)),
            (0.5, lambda: self.box(d.choice(ADVERTS), lambda: self.bare(2, 25))), (0.3, lambda: self.box(d.choice(SIDES), self.links)),
        ]
        after = [
            (0.3, lambda: self.box(d.choice(SHARES), self.plain)), (0.4, lambda: self.box(d.choice(SIDES), d.choice((self.links, self.plain)))),
            (0.4, lambda: self.box(d.choice(COMMENTS), self.comments)), (0.4, lambda: self.box(d.choice(ADVERTS), self.plain)),
            (0.3, lambda: self.box(d.choice(FORMS), self.form)), (0.2, lambda: self.box(d.choice(NOTICES), self.plain)),
            (0.8, lambda: self.box(d.choice(FOOTERS), d.choice((self.copyright, self.plain, self.links)))),
        ]
        for steps, mixed in ((before, True), (None, False), (after, False)):
            if steps is None:
                self.article(text)
                continue
            if mixed:
                d.shuffle(steps)
            for chance, step in steps:
                if d.random() < chance:
                    step()
        if d.random() < 0.9:
            self.out.append("</body></html>")
        return "".join(self.out), self.labels


def labelled_pages(count: int, seed: int = 7) -> list[tuple[str, list[int]]]:
    """``count`` pages with the label of each leaf block: 1 for the article."""
    draw = random.Random(seed)
    return [_Page(draw).build() for _ in range(count)]
