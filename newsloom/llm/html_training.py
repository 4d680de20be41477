"""Labelled training pages: layouts drawn at random, with every text's label known.

No labelled pages are at hand, so they are made. A page is a tree whose texts
carry their label; marks (class and id words) and wrapping are drawn from what
is common on the web, and are left out often enough that tags, place and text
have to tell as well.
"""

from __future__ import annotations

import random

from newsloom.llm.html_extract import Block, leaf_blocks

_CONTENT = ["content", "article", "post", "entry", "story", "main", "body", "text", "prose", "page content", "article body", "post content", "entry content", "story text", "single"]
_SITE_TOP = ["header", "masthead", "top", "site header", "page header", "branding", "navbar", "topbar"]
_MENU = ["nav", "menu", "navigation", "main menu", "links", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc list", "tabs"]
_SIDE = ["sidebar", "side", "aside", "widget", "related", "popular", "trending", "recommended", "more", "rail", "secondary", "teaser list"]
_FOOT = ["footer", "bottom", "site footer", "legal", "copyright", "colophon", "foot"]
_ADVERT = ["ad", "ads", "advert", "advertisement", "banner", "promo", "sponsor", "sponsored", "adslot", "dfp", "commercial"]
_NOTICE = ["cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "gdpr", "banner cookie", "overlay", "disclaimer", "message"]
_FORM = ["search", "newsletter", "subscribe", "signup", "login", "form", "contact form", "poll"]
_SOCIAL = ["share", "social", "sharing", "follow", "tags", "buttons", "tools"]
_COMMENTS = ["comments", "comment list", "discussion", "responses", "replies", "disqus", "reader comments", "comment section"]


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.truth: list[tuple[str, int]] = []
        syllables = ["".join(self.r.choice("bcdfghklmnprstvwz") + self.r.choice("aeiouäéè") for _ in range(self.r.randint(1, 2))) for _ in range(60)]
        self.words = ["".join(self.r.sample(syllables, self.r.randint(1, 3))) for _ in range(400)]
        self.n = 0

    def some(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.r.randint(low, high)):
            words = self.some(3, 18).split()
            if len(words) > 6 and self.r.random() < 0.6:
                words[len(words) // 2] += ","
            out.append(" ".join(words).capitalize() + self.r.choice("....!?"))
        return " ".join(out)

    def text(self, said: str, label: int) -> str:
        """The text with its number, by which its block is found again."""
        self.n += 1
        key = f"q{self.n}q"
        self.truth.append((key, label))
        return f"{key} {said}"

    def mark(self, words: list[str], often: float = 0.8) -> str:
        if self.r.random() > often:
            return ""
        said = self.r.choice(words)
        said = self.r.choice([said, said.replace(" ", "-"), said.replace(" ", "_"), f"{said.replace(' ', '-')} {self.r.choice(['col', 'box', 'wrap', 'inner', 'clearfix', 'block'])}"])
        return f' {self.r.choice(["class", "class", "class", "id"])}="{said}"'

    def within(self, tag: str, marks: str, inside: str) -> str:
        return f"<{tag}{marks}>{inside}</{tag}>"

    def link(self, said: str) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{said}</a>'

    # boilerplate
    def menu(self) -> str:
        items = "".join(f"<li>{self.link(self.text(self.some(1, 3), 0))}{self.r.choice(['</li>', '</li>', ''])}" for _ in range(self.r.randint(3, 9)))
        tag = self.r.choice(["nav", "nav", "div", "ul"])
        return self.within(tag, self.mark(_MENU, 0.4 if tag == "nav" else 0.95), items if tag == "ul" else self.within("ul", "", items))

    def top(self) -> str:
        inside = self.r.choice(["", self.within(self.r.choice(["div", "h1", "h2", "p"]), self.mark(["logo", "title", "brand"], 0.5), self.link(self.text(self.some(1, 4), 0)))]) + self.r.choice(["", self.within("p", self.mark(["tagline", "slogan"], 0.5), self.text(self.some(3, 8), 0))])
        return self.within(*self.r.choice([("header", self.mark(_SITE_TOP, 0.4)), ("div", self.mark(_SITE_TOP, 1))]), inside + self.r.choice(["", self.menu()]))

    def advert(self) -> str:
        said = self.r.choice([self.some(2, 8), self.sentences(1, 2), self.sentences(1, 3)])
        said = self.r.choice([self.link(self.text(said, 0)), self.text(said, 0)])
        tag = self.r.choice(["div", "div", "aside", "section"])
        return self.within(tag, self.mark(_ADVERT, 1), self.r.choice([said, self.within("p", "", said)]))

    def notice(self) -> str:
        inside = self.within("p", "", self.text(self.sentences(1, 3), 0)) + self.r.choice(["", self.within("button", "", self.text(self.some(1, 2), 0))])
        return self.within(self.r.choice(["div", "div", "section", "aside", "dialog"]), self.mark(_NOTICE, 1), inside)

    def form(self) -> str:
        inside = self.r.choice(["", self.within("h3", "", self.text(self.some(2, 4), 0))]) + self.within("label", "", self.text(self.some(1, 3), 0)) + '<input name="q">' + self.r.choice(["", self.within("p", "", self.text(self.sentences(1, 2), 0))]) + self.within("button", "", self.text(self.some(1, 2), 0))
        if self.r.random() < 0.2:
            inside += self.within("select", "", "".join(f"<option>{self.text(self.some(1, 2), 0)}" for _ in range(3)))
        own = self.within("form", self.mark(_FORM, 0.5), inside)
        return self.r.choice([own, self.within("div", self.mark(_FORM, 0.8), own)])

    def side(self) -> str:
        parts = []
        for _ in range(self.r.randint(1, 3)):
            title = self.within(self.r.choice(["h2", "h3", "h4", "p"]), "", self.text(self.some(1, 4), 0))
            body = self.r.choice(
                [
                    lambda: self.within("ul", "", "".join(f"<li>{self.link(self.text(self.some(2, 8), 0))}</li>" for _ in range(self.r.randint(2, 6)))),
                    lambda: self.within("p", "", self.text(self.sentences(1, 3), 0)),
                    lambda: self.within("p", "", self.link(self.text(self.sentences(1, 1), 0))),
                    self.advert,
                ]
            )()
            parts.append(self.within("div", self.mark(["widget", "box", "module", "teaser"], 0.5), title + body))
        return self.within(*self.r.choice([("aside", self.mark(_SIDE, 0.4)), ("div", self.mark(_SIDE, 1)), ("section", self.mark(_SIDE, 1))]), "".join(parts))

    def foot(self) -> str:
        said = self.r.choice(["&copy; " + self.some(1, 6), self.sentences(1, 2), "&copy; " + self.some(1, 3) + " &middot; " + self.sentences(1, 2)])
        inside = self.r.choice([self.text(said, 0), self.within("p", "", self.text(said, 0))]) + self.r.choice(["", self.menu(), self.within("p", "", self.text(self.sentences(1, 2), 0))])
        return self.within(*self.r.choice([("footer", self.mark(_FOOT, 0.4)), ("div", self.mark(_FOOT, 1))]), inside)

    def social(self) -> str:
        return self.within(self.r.choice(["div", "ul"]), self.mark(_SOCIAL, 1), "".join(f"<li>{self.link(self.text(self.some(1, 2), 0))}</li>" for _ in range(self.r.randint(2, 4))))

    def comments(self) -> str:
        wrapped = self.r.random() < 0.8
        parts = [self.within("h3", "", self.text(self.some(1, 3), 0)) if wrapped else ""]
        for _ in range(self.r.randint(1, 5)):
            who = self.r.choice(["", self.within(self.r.choice(["span", "div", "h4"]), self.mark(["author", "user", "name"], 0.7), self.text(self.some(1, 2), 0))])
            said = "".join(self.within("p", "", self.text(self.sentences(1, 4), 0)) for _ in range(self.r.randint(1, 2)))
            tag = self.r.choice(["div", "li", "article", "section"])
            parts.append(self.within(tag, self.mark(["comment", "reply", "response", "comment body"], 0.7 if wrapped else 1), who + said))
        if not wrapped:
            return "".join(parts[1:])
        return self.within(self.r.choice(["div", "section", "ol"]), self.mark(_COMMENTS, 1), "".join(parts) + self.r.choice(["", self.form()]))

    # main text
    def paragraph(self) -> str:
        said = self.r.choice([self.sentences(1, 1), self.sentences(2, 7), self.sentences(2, 7), self.some(1, 6)])
        x = self.r.random()
        if x < 0.15:
            said = said.replace(" ", f" {self.link(self.some(1, 2))} ", 1)
        elif x < 0.25:
            said = f"<b>{said}<br>" if x < 0.2 else f"<b>{said}</b>"
        key = self.text("", 1)
        return f"<p>{key}{said}" + self.r.choice(["</p>", "</p>", ""])

    def part(self) -> str:
        x = self.r.random()
        if x < 0.72:
            return self.paragraph()
        if x < 0.8:
            return self.within(self.r.choice(["h2", "h3", "h4"]), "", self.text(self.some(1, 6), 1))
        if x < 0.87:
            return self.within(self.r.choice(["ul", "ol"]), "", "".join(f"<li>{self.text(self.r.choice([self.some(2, 8), self.sentences(1, 2)]), 1)}</li>" for _ in range(self.r.randint(2, 5))))
        if x < 0.91:
            return self.within("blockquote", "", self.r.choice([self.text(self.sentences(1, 3), 1), self.within("p", "", self.text(self.sentences(1, 3), 1))]))
        if x < 0.94:
            return self.within("table", "", "".join(f"<tr><td>{self.text(self.some(1, 3), 1)}<td>{self.text(self.some(1, 3), 1)}" for _ in range(self.r.randint(2, 4))))
        if x < 0.97:
            return self.within("figure", "", '<img src="x.png">' + self.within("figcaption", "", self.text(self.some(3, 9), 1)))
        return self.within("pre", "", self.text(self.some(3, 12), 1))

    def article(self) -> str:
        title = self.r.choice(["", self.within("h1", self.mark(["title", "headline", "entry title"], 0.3), self.text(self.r.choice([self.some(2, 10), self.sentences(1, 1)]), 1))])
        if title and self.r.random() < 0.2:
            title = self.within("header", self.mark(["entry header", "article header"], 0.3), title)
        parts = [title]
        for _ in range(self.r.choice([0, 1, 2, 3, 5, 8, 14])):
            parts.append(self.part())
            if self.r.random() < 0.15:
                parts.append(self.r.choice([self.advert, self.advert, self.social, self.form, self.side, self.notice])())
        if title == "" and len(parts) == 1:
            parts.append(self.paragraph())
        inside = "".join(parts)
        kind = self.r.random()
        if kind < 0.45:
            return self.within("article", self.mark(_CONTENT, 0.4), inside)
        if kind < 0.6:
            return self.within("main", self.mark(_CONTENT, 0.4), self.r.choice([inside, self.within("article", "", inside), self.within("div", self.mark(_CONTENT, 0.8), inside)]))
        if kind < 0.7:
            return self.within("article", "", self.within("div", self.mark(_CONTENT, 0.8), inside))
        return self.within(self.r.choice(["div", "section"]), self.mark(_CONTENT, 0.95), inside)

    def page(self) -> str:
        r = self.r
        before = [f for f, p in ((self.notice, 0.3), (self.top, 0.6), (self.menu, 0.7), (self.advert, 0.4), (self.form, 0.2), (self.side, 0.15)) if r.random() < p]
        after = [f for f, p in ((self.social, 0.25), (self.side, 0.4), (self.comments, 0.35), (self.advert, 0.3), (self.form, 0.25), (self.notice, 0.15), (self.foot, 0.8)) if r.random() < p]
        middle = self.article() if r.random() < 0.97 else ""
        # the parts were numbered as they were made; blocks are found by number, in any order
        body = "".join(f() for f in before) + middle + "".join(f() for f in after)
        if r.random() < 0.3:
            body = self.within("div", self.mark(["wrapper", "page", "container", "site", "layout", "wrap"], 1), body)
        return f"<!DOCTYPE html><html><head><title>{self.some(2, 6)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def labelled_pages(pages: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    """Blocks of each page with their labels."""
    out = []
    for k in range(pages):
        own = _Page(seed * 100_003 + k)
        label = {}
        page = own.page()
        label.update(own.truth)
        blocks, labels = [], []
        for b in leaf_blocks(page):
            key, _, said = b.text.partition(" ")
            if key not in label:
                continue
            blocks.append(Block(said or key, b.path, max(0, min(b.linked - len(key) - 1, len(said)))))
            labels.append(label[key])
        if blocks:
            out.append((blocks, labels))
    return out
