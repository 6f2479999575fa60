"""Labelled pages made from layouts: what teaches the page model which nodes are main text.

A labelled page is a pair: its html, and its main text as blocks joined by empty
lines. These are put together from the pieces that pages have (site header,
menu, notice, advert, article, sidebar, comments, footer) in usual and unusual
markup, with invented words, so that only structure, names and shapes of texts
can be learnt.
"""

from __future__ import annotations

import random

# Names that authors of pages give to the parts.
NAMES = {
    "main": "content article post entry story main body text page-content post-body entry-content article-body main-content story-text",
    "menu": "nav menu navbar navigation main-menu topnav site-nav breadcrumb breadcrumbs toc pagination pager tabs",
    "header": "header masthead site-header top-bar banner-top branding logo page-head",
    "footer": "footer site-footer bottom copyright legal page-foot footer-links colophon",
    "sidebar": "sidebar side-bar aside widget widgets rail left-col related recommended trending popular more-stories",
    "notice": "notice cookie cookie-banner consent gdpr alert message popup modal overlay paywall subscribe-notice",
    "advert": "ad ads advert advertisement sponsor sponsored promo banner promotion adsense ad-slot dfp",
    "comments": "comments comment-list comment reply replies discussion responses disqus user-comments comment-thread",
    "form": "search search-form login newsletter signup subscribe contact-form",
    "share": "share social social-links share-buttons follow tags post-tags",
}
NAMES = {part: names.split() for part, names in NAMES.items()}
SYLLABLES = "ba ce di fo gu la me ni or pa qui re sa to un va wen xi yor zel ka ström né".split()


class _Page:
    """One page under construction: pieces of html, and the blocks of its main text."""

    def __init__(self, chance: random.Random):
        self.chance, self.kept, self.odd = chance, [], False

    def words(self, least: int, most: int) -> str:
        n = self.chance.randint(least, most)
        words = ["".join(self.chance.choices(SYLLABLES, k=self.chance.randint(1, 3))) for _ in range(n)]
        words = [w + self.chance.choices(["", ",", ".", " &amp;", "|"], [40, 4, 6, 0.3, 0.2])[0] for w in words]
        return " ".join(words).capitalize()

    def sentence(self, least: int = 1, most: int = 25) -> str:
        return self.words(least, most).rstrip(",") + self.chance.choice("....!?")

    def paragraph(self) -> str:
        """Mostly sentences; also one word, words in columns, or the same word over and over."""
        roll = self.chance.random() * (0.12 if self.odd else 1)
        if roll < 0.05:
            return " ".join([self.words(1, 1)] * self.chance.randint(5, 120))
        if roll < 0.12:
            return self.chance.choice((" | ", " ", "$$$ ", ", ")).join(self.words(1, 2) for _ in range(self.chance.randint(3, 60)))
        return " ".join(self.sentence() for _ in range(self.chance.choice((1, 1, 1, 2, 3, 5, 9, 25))))

    def keep(self, text: str) -> str:
        self.kept.append(text.replace("&amp;", "&"))
        return text

    def named(self, part: str, often: float = 0.85) -> str:
        """An attribute with a name of the part, or none."""
        if self.chance.random() > often:
            return ""
        names = self.chance.sample(NAMES[part], self.chance.choice((1, 1, 2)))
        return f' {self.chance.choice(("class", "class", "id"))}="{" ".join(names)}"'

    def links(self, least: int, most: int) -> list[str]:
        return [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(self.chance.randint(least, most))]

    def link_list(self, least: int = 3, most: int = 9) -> str:
        links = self.links(least, most)
        form = self.chance.random()
        if form < 0.7:
            return "<ul>" + "".join(f"<li>{link}</li>" for link in links) + "</ul>"
        return self.chance.choice((" ", " | ", " &middot; ")).join(links)

    def menu(self) -> str:
        tag = self.chance.choice(("nav", "nav", "div", "ul"))
        if tag == "ul":
            return f"<ul{self.named('menu', 1)}>" + "".join(f"<li>{link}</li>" for link in self.links(3, 9)) + "</ul>"
        return f"<{tag}{self.named('menu', 0.4 if tag == 'nav' else 1)}>{self.link_list()}</{tag}>"

    def header(self) -> str:
        tag = self.chance.choice(("header", "header", "div"))
        title = f"<{self.chance.choice(('h1', 'p', 'div', 'span'))}>{self.words(1, 4)}"
        title += f"</{title[1:].split('>')[0]}>"
        slogan = f"<p>{self.sentence(2, 10)}</p>" if self.chance.random() < 0.5 else ""
        return f"<{tag}{self.named('header', 0.5 if tag == 'header' else 1)}>{title}{slogan}{self.menu() if self.chance.random() < 0.5 else ''}</{tag}>"

    def aside(self, part: str) -> str:
        """A block named after what it is: advert, notice, sidebar, share links."""
        tag = self.chance.choice(("p", "p", "div", "div", "section") if part in ("advert", "notice") else ("div", "div", "section", "aside"))
        if part == "sidebar" and self.chance.random() < 0.5:
            tag = "aside"
        if tag == "p":
            inner = self.sentence(2, 25)
        elif part in ("sidebar", "share"):
            inner = (f"<h3>{self.words(1, 4)}</h3>" if self.chance.random() < 0.6 else "") + self.link_list()
            if self.chance.random() < 0.4:
                inner += f"<p>{self.paragraph()}</p>"
        else:
            inner = self.chance.choice((self.sentence(2, 25), f"<p>{self.paragraph()}</p>", f"<a href='#'>{self.sentence(2, 9)}</a>"))
        return f"<{tag}{self.named(part, 0.5 if tag == 'aside' else 1)}>{inner}</{tag}>"

    def form(self) -> str:
        label = f"<label>{self.words(1, 4)}</label><input name=q>"
        text = f"<p>{self.sentence()}</p>" if self.chance.random() < 0.6 else ""
        return f"<form{self.named('form', 0.5)}>{text}{label}<button>{self.words(1, 2)}</button></form>"

    def comments(self) -> str:
        item = self.chance.choice(("li", "div", "article"))
        own = self.named("comments", 0.5)
        tail = f"<a href='#'>{self.words(1, 1)}</a>" if self.chance.random() < 0.5 else ""
        items = "".join(f"<{item}{own}><b>{self.words(1, 2)}</b><p>{self.paragraph()}</p>{tail}</{item}>" for _ in range(self.chance.randint(1, 6)))
        if item == "li":
            items = f"<ol>{items}</ol>"
        tag = self.chance.choice(("div", "section", "aside"))
        return f"<{tag}{self.named('comments', 1)}><h3>{self.words(1, 3)}</h3>{items}{self.form() if self.chance.random() < 0.4 else ''}</{tag}>"

    def footer(self) -> str:
        tag = self.chance.choice(("footer", "footer", "div"))
        inner = self.chance.choice(("&copy; ", "", "Copyright ")) + self.words(1, 4) + " &middot; " + self.paragraph()
        if self.chance.random() < 0.5:
            inner = f"<p>{inner}</p>{self.link_list()}"
        return f"<{tag}{self.named('footer', 0.4 if tag == 'footer' else 1)}>{inner}</{tag}>"

    def block(self) -> str:
        """A block of the article that is no plain paragraph."""
        form = self.chance.randrange(7)
        if form == 0:
            tag = self.chance.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{self.keep(self.sentence())}</li>" for _ in range(self.chance.randint(2, 6))) + f"</{tag}>"
        if form == 1:
            return f"<blockquote><p>{self.keep(self.paragraph())}</p></blockquote>"
        if form == 2:
            return f"<pre>{self.keep(self.words(3, 20))}</pre>"
        if form == 3:
            rows = range(self.chance.randint(1, 4))
            return "<table>" + "".join(f"<tr><td>{self.keep(self.words(1, 4))}</td><td>{self.keep(self.words(1, 4))}</td></tr>" for _ in rows) + "</table>"
        if form == 4:
            return f"<figure><img src=x><figcaption>{self.keep(self.sentence())}</figcaption></figure>"
        if form == 5:
            return f"<div>{self.keep(self.paragraph())}</div>"
        return f"<dl><dt>{self.keep(self.words(1, 3))}</dt><dd>{self.keep(self.sentence())}</dd></dl>"

    def article(self) -> str:
        parts = []
        if self.chance.random() < 0.9:
            heading = f"<h1>{self.keep(self.words(1, 10))}</h1>"
            parts.append(f"<header>{heading}</header>" if self.chance.random() < 0.2 else heading)
        many = self.chance.random() < 0.12  # very many short paragraphs
        for _ in range(self.chance.randint(20, 80) if many else self.chance.choice((1, 1, 2, 3, 5, 8, 14, 25))):
            roll = 0.2 + self.chance.random() * 4 if many else self.chance.random()
            if roll < 0.12:
                parts.append(f"<h2>{self.keep(self.words(1, 6))}</h2>")
            elif roll < 0.3:
                parts.append(self.block())
            elif roll < 0.45:
                parts.append(self.chance.choice((self.form, self.menu, *(lambda p=p: self.aside(p) for p in ("advert", "share", "sidebar", "notice"))))())
            text = self.sentence(1, 5) if many else self.paragraph()
            if self.chance.random() < 0.15:
                text = f"<a href='/x'>{text}</a>" if self.chance.random() < 0.2 else f"<b>{text}</b>"
            self.keep(text.replace("<b>", "").replace("</b>", "").replace("<a href='/x'>", "").replace("</a>", ""))
            parts.append(f"<p>{text}" + ("</p>" if self.chance.random() < 0.9 else ""))
        tag = self.chance.choice(("article", "article", "main", "div", "div", "section"))
        named = self.named("main", {"div": 0.75, "section": 0.9}.get(tag, 0.4))
        inner = "".join(parts)
        if self.chance.random() < 0.3:
            inner = f"<div{self.named('main', 0.6)}>{inner}</div>"
        return f"<{tag}{named}>{inner}</{tag}>"

    def maybe(self, share: float, make, *args) -> str:
        return make(*args) if self.chance.random() < share else ""

    def html(self) -> str:
        before = [
            self.maybe(0.6, self.header), self.maybe(0.7, self.menu), self.maybe(0.3, self.aside, "notice"), self.maybe(0.5, self.aside, "advert"),
            self.maybe(0.2, self.aside, "sidebar"), self.maybe(0.2, self.form),
        ]
        self.odd = self.chance.random() < 0.15  # an article of such paragraphs only
        article = self.article()
        self.odd = False
        after = [
            self.maybe(0.3, self.aside, "share"), self.maybe(0.4, self.aside, "sidebar"), self.maybe(0.4, self.comments), self.maybe(0.3, self.aside, "advert"),
            self.maybe(0.2, self.menu), self.maybe(0.2, self.aside, "notice"), self.maybe(0.2, self.form),
        ]
        self.chance.shuffle(before)
        wrapped = "".join(before) + article + "".join(after)
        if self.chance.random() < 0.4:
            wrapped = f"<div{self.chance.choice(('', ' class=wrapper', ' id=page', ' class=container'))}>{wrapped}</div>"
        return f"<html><head><title>x</title></head><body>{wrapped}{self.maybe(0.85, self.footer)}</body></html>"


def labelled_pages(n: int = 400, seed: int = 1) -> list[tuple[str, str]]:
    """n labelled pages, the same ones for the same seed."""
    chance = random.Random(seed)
    out = []
    for _ in range(n):
        page = _Page(chance)
        html = page.html()
        out.append((html, "\n\n".join(page.kept)))
    return out
