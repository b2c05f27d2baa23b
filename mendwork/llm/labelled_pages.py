"""Invented web pages whose blocks are labelled, for training: layouts, names and lengths drawn by page number."""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Names under which pages keep the parts of an article, and everything around it.
ARTICLE = (
    "article", "main", "main article", "section.post", "div.content", "div#content", "div.article-body", "div.post-content", "div.entry-content", "div.story",
    "div#main", "section.article", "div.main-content", "div[role=main]", "div.articleBody", "div[itemprop=articleBody]", "td.content", "div.page div.text", "div",
    "main div.wrapper", "article div.body", "div.container article", "div.post div.entry", "section#story", "div.blog-post",
)
AROUND = {
    "header": ("header", "div#header", "div.header", "div.masthead", "div.site-header", "div.top-bar", "div[role=banner]", "header.branding"),
    "menu": ("nav", "nav.menu", "div.nav", "div#navigation", "div.menu", "ul.menu", "div[role=navigation]", "div.navbar", "nav.breadcrumb", "div.breadcrumbs", "div.topnav", "ul#nav"),
    "notice": ("div.notice", "div.cookie-notice", "div#cookie-banner", "div.alert", "div.gdpr-consent", "div.popup", "div.modal", "div.announcement", "section.notice",
               "div.newsletter", "div.subscribe", "p.notice", "div[role=alert]", "dialog", "div.paywall", "div.banner"),
    "advert": ("div.ad", "div.ads", "div.advert", "div.advertisement", "div#ad-top", "div.sponsored", "div.promo", "aside.ad", "ins.adsbygoogle", "section.advert", "div.ad-slot", "p.ad",
               "div.sponsor", "div.banner-ad"),
    "sidebar": ("aside", "div.sidebar", "div#sidebar", "aside.sidebar", "div.right-column", "div.widget", "div.related", "section.related", "div.recommended", "div.popular", "td.sidebar",
                "div.rail", "div[role=complementary]", "ul.related-links"),
    "share": ("div.share", "div.social", "ul.share-buttons", "div.tags", "div.toolbar"),
    "comments": ("section.comments", "div#comments", "div.comments", "ol.commentlist", "section#comments", "div.comment-list", "div.discussion", "div.replies", "div#disqus", "section.responses",
                 "div.reader-comments", "div.feedback"),
    "form": ("form", "form.search", "form#contact", "form.newsletter", "div.form form", "form.login", "div.search form"),
    "footer": ("footer", "div#footer", "div.footer", "footer.site-footer", "div.bottom", "div.copyright", "div.legal", "div[role=contentinfo]", "section.footer"),
    "hidden": ("div[hidden]", "div[style=display:none]", "div[aria-hidden=true]"),
}
_SOUNDS = ("the an er on re ti es or ar nd", "der sch ein ung ich ge lich en", "que eau tion le la é ment ou", "ció de que ra os ar el do", "при ста ов но ть ер", "の に 日 本 語 は を た")


class _Page:
    """The pieces of one page, and the label of every block of it in turn."""

    def __init__(self, number: int, seed: int):
        self.rng = random.Random(f"{seed}:{number}")
        self.sounds = self.rng.choice(_SOUNDS).split(" ")
        self.upper = self.rng.random() < 0.08
        self.html: list[str] = []
        self.labels: list[int] = []

    def word(self) -> str:
        return "".join(self.rng.choice(self.sounds) for _ in range(self.rng.randint(1, 4)))

    def words(self, n: int) -> str:
        found = [self.word() for _ in range(n)]
        for i in range(n):
            if self.rng.random() < 0.04:
                found[i] += self.rng.choice((",", " &", " <", ' "' + self.word() + '"', " 12", ";"))
        return " ".join(found).capitalize()

    def sentences(self, longest: int) -> str:
        return " ".join(self.words(self.rng.randint(1, 18)) + self.rng.choice("....!?") for _ in range(self.rng.randint(1, longest)))

    def put(self, text: str, label: int) -> None:
        """Text that becomes a block, or the rest of one."""
        self.html.append(escape(text, quote=self.rng.random() < 0.5))
        self.labels.append(label)

    def tag(self, written: str) -> None:
        self.html.append(written.upper() if self.upper else written)

    def open(self, path: str) -> list[str]:
        """Opens the elements of a path like ``div.name section#name``; gives their tags."""
        tags = []
        for step in path.split(" "):
            tag, attribute = step, ""
            if "[" in step:
                tag, rest = step.split("[")
                name, _, value = rest.rstrip("]").partition("=")
                attribute = f' {name}="{value}"' if value else f" {name}"
            elif "." in step or "#" in step:
                sign = "." if "." in step else "#"
                tag, name = step.split(sign)
                name += self.rng.choice(("", "", "", f" {self.word()}", f"-{self.rng.randint(1, 9)}", f" {self.word()}-{self.word()}"))
                attribute = f' {"class" if sign == "." else "id"}="{name}"'
            if tag == "td":
                self.tag("<table><tr>")
            self.html.append(f"<{tag}{attribute}>")
            tags.append(tag)
        return tags

    def close(self, tags: list[str]) -> None:
        for tag in reversed(tags):
            self.tag(f"</{tag}>" + ("</tr></table>" if tag == "td" else ""))

    def paragraph(self, label: int, longest: int = 8) -> None:
        kind = self.rng.random()
        if kind < 0.12:
            self.tag("<p><b>")
            self.put(self.sentences(longest), label)
            self.tag("<br>")
        elif kind < 0.2:
            self.tag("<p>")
            self.put(self.sentences(longest), label)
        elif kind < 0.25:
            self.tag("<p>")
            self.put(self.words(self.rng.randint(1, 3)) + self.rng.choice((".", "", "!")), label)
            self.tag("</p>")
        elif kind < 0.32:
            self.tag("<p>")
            self.put(self.sentences(2), label)
            self.html.append(f' <a href="/{self.word()}">{self.word()}</a> <em>{self.word()}</em> ')
            self.html.append(escape(self.sentences(3)))
            self.tag("</p>")
        else:
            self.tag("<p>")
            self.put(self.sentences(longest), label)
            self.tag("</p>")

    def listing(self, label: int, linked: bool, most: int = 8) -> None:
        tag = self.rng.choice(("ul", "ul", "ol"))
        self.tag(f"<{tag}>")
        for _ in range(self.rng.randint(1, most)):
            self.tag("<li>")
            if linked:
                self.html.append(f'<a href="/{self.word()}">')
            self.put(self.words(self.rng.randint(1, 4 if linked else 25)), label)
            if linked:
                self.tag("</a>")
            if self.rng.random() < 0.8:
                self.tag("</li>")
        self.tag(f"</{tag}>")

    def around(self, part: str) -> None:
        """One part of the page that is not the article."""
        tags = self.open(self.rng.choice(AROUND[part]))
        draw = self.rng.random()
        if tags[-1] in ("ul", "ol"):
            for _ in range(self.rng.randint(1, 7)):
                self.tag("<li>")
                if part == "comments":
                    self.put(self.sentences(4), 0)
                else:
                    self.html.append('<a href="#">')
                    self.put(self.words(self.rng.randint(1, 4)), 0)
                    self.html.append("</a>")
                self.tag("</li>")
        elif tags[-1] == "p":
            self.put(self.sentences(3), 0)
        elif part == "menu":
            self.listing(0, True)
        elif part == "form":
            for _ in range(self.rng.randint(1, 3)):
                self.tag("<div>")
                self.html.append("<label>")
                self.put(self.words(self.rng.randint(1, 6)), 0)
                self.html.append('</label> <input type="text" name="q"></div>')
            if draw < 0.5:
                self.tag("<p>")
                self.put(self.sentences(2), 0)
                self.tag("</p>")
            self.html.append("<button>")
            self.put(self.word(), 0)
            self.html.append("</button>")
        elif part == "comments":
            self.tag("<h3>")
            self.put(self.words(2), 0)
            self.tag("</h3>")
            for _ in range(self.rng.randint(1, 6)):
                inner = self.open(self.rng.choice(("div.comment", "article.comment", "div", "li", "div.reply")))
                if draw < 0.5:
                    self.tag("<div>")
                    self.put(self.words(2), 0)
                    self.tag("</div>")
                self.paragraph(0, 5)
                self.close(inner)
        elif part == "footer":
            if draw < 0.7:
                self.html.append("&copy; ")
                self.put(f"{self.word()}.example &middot; ".replace("&middot;", "·") + self.sentences(2), 0)
            else:
                self.listing(0, True, 5)
                self.paragraph(0, 2)
        elif part == "sidebar":
            self.tag("<h4>")
            self.put(self.words(self.rng.randint(1, 4)), 0)
            self.tag("</h4>")
            if draw < 0.5:
                self.listing(0, True, 6)
            else:
                for _ in range(self.rng.randint(1, 3)):
                    self.paragraph(0, 3)
        elif part == "header":
            self.tag("<h1>" if draw < 0.4 else "<div>")
            self.put(self.words(self.rng.randint(1, 5)), 0)
            self.tag("</h1>" if draw < 0.4 else "</div>")
            if draw > 0.5:
                self.paragraph(0, 1)
        elif draw < 0.5:
            self.put(self.sentences(4), 0)
        else:
            for _ in range(self.rng.randint(1, 2)):
                self.paragraph(0, 4)
        self.close(tags)

    def article(self) -> None:
        tags = self.open(self.rng.choice(ARTICLE))
        rng = self.rng
        if rng.random() < 0.85:
            heading = rng.choice(("h1", "h1", "h1", "h2"))
            inside = rng.random() < 0.12
            self.tag("<header>" * inside + f"<{heading}>")
            self.put(self.words(rng.randint(1, 14)) + rng.choice(("", ".", "!")), 1)
            self.tag(f"</{heading}>" + "</header>" * inside)
        for _ in range(rng.choice((1, 2, 4, 8, 14, 20))):
            kind = rng.random()
            if kind < 0.74:
                self.paragraph(1, rng.choice((1, 3, 8, 20)))
            elif kind < 0.8:
                tag = rng.choice(("h2", "h3"))
                self.tag(f"<{tag}>")
                self.put(self.words(rng.randint(1, 8)), 1)
                self.tag(f"</{tag}>")
            elif kind < 0.84:
                self.listing(1, False)
            elif kind < 0.87:
                tag = rng.choice(("blockquote", "pre", "div"))
                self.tag(f"<{tag}>")
                self.put(self.sentences(4), 1)
                self.tag(f"</{tag}>")
            elif kind < 0.89:
                self.tag("<figure>")
                self.html.append('<img src="a.png" alt="x">')
                self.tag("<figcaption>")
                self.put(self.words(6), 1)
                self.tag("</figcaption></figure>")
            elif kind < 0.91:
                self.tag("<table>")
                for _ in range(2):
                    self.tag("<tr><td>")
                    self.put(self.words(2), 1)
                    self.tag("</td><td>")
                    self.put(self.words(3), 1)
                    self.tag("</td></tr>")
                self.tag("</table>")
            else:
                self.around(rng.choice(("advert", "advert", "share", "sidebar", "notice", "form", "hidden")))
        if rng.random() < 0.15:
            self.around("share")
        if rng.random() < 0.12:
            self.around("comments")
        if rng.random() < 0.08:
            self.tag("<footer>")
            self.put(self.sentences(2), 0)
            self.tag("</footer>")
        self.close(tags)

    def build(self) -> tuple[str, list[int]]:
        rng = self.rng
        self.html.append("<!DOCTYPE html><html><head><meta charset=utf-8><title>" + escape(self.words(5)) + "</title><style>p{margin:0}</style>")
        self.html.append('<script>var t="</p>";</script></head><body>')
        wrapper = self.open(rng.choice(("div.wrapper", "div#page", "div.site", "div", "div.container"))) if rng.random() < 0.4 else []
        before = [p for p, share in (("notice", 0.25), ("header", 0.5), ("menu", 0.85), ("form", 0.15), ("advert", 0.4), ("hidden", 0.1), ("sidebar", 0.15)) if rng.random() < share]
        if rng.random() < 0.3:
            rng.shuffle(before)
        for part in before:
            self.around(part)
            if rng.random() < 0.2:
                self.html.append("<!-- <p>old</p> -->")
        if rng.random() < 0.94:
            self.article()
        for part, share in (("share", 0.1), ("advert", 0.3), ("comments", 0.35), ("sidebar", 0.45), ("form", 0.2), ("menu", 0.1), ("footer", 0.85), ("notice", 0.1)):
            if rng.random() < share:
                self.around(part)
        self.close(wrapper)
        if rng.random() < 0.9:
            self.html.append("</body></html>")
        return "".join(self.html), self.labels


def invent(number: int, seed: int) -> tuple[str, list[int]]:
    """The page of a number: its source, and 1 for each block that is main text, else 0."""
    return _Page(number, seed).build()


def labelled_pages(spark: SparkSession, pages: int, seed: int = 7) -> DataFrame:
    """``html`` and ``main`` (one label a block, in page order) of so many invented pages; the same on any cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [invent(n, seed) for n in batch.column(0).to_pylist()]
            columns = [pa.array([h for h, _ in made], pa.string()), pa.array([m for _, m in made], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["html", "main"])

    return spark.range(pages).mapInArrow(run, "html string, main array<int>")
