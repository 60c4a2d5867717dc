"""Main text of web pages by text-to-tag ratio.

The standard library's parser delivers a page as events.  Block elements end a
line; a line holds its text, the number of tags in it and the region (outermost
article or main element, else the body) it lies in.  Lines inside menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts and
styles are marked as boilerplate.  Forms and elements marked by a whole class
name, id or role stay if they hold an article, a main element or most of the
text (comments: no article); menus, headers, footers and asides stay if they
hold a main element.  End tags that may be omitted are implied.  Each line's ratio of characters to tags is
smoothed by a Gaussian over its neighbours; lines above a threshold from the
ratios' spread are content.  Regions compete by their content: where articles
and main elements together have at least as much as the body outside them, all
of them with content are selected, else the body is; of the other side, regions
with at least ``_SHARE`` of the largest one's content are selected too.  Outside
articles the ratio also selects inside a region: neighbouring lines that are
links for the most part make a block, and a block whose ratio is under the
threshold, a menu without a name, goes.  All other lines of selected regions
that are not boilerplate are the main text, in page order: a short paragraph
between long ones stays.  ``menu`` and ``comments`` as a part of a longer class
name or id mark boilerplate, too, where the element holds no article.

Defined results: a null or empty page has an empty text; pages of any length are
read whole; regions of equal content are all selected; repeated rows give
repeated results; an empty table gives an empty result; columns other than
those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# Elements that end a line, hold boilerplate, name a region, or have no end tag.
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section "
                   "summary table caption tbody td tfoot th thead title tr ul".split())
INERT = frozenset("head title script style noscript template iframe svg canvas object button select textarea "
                  "option".split())
ASIDES = frozenset("nav header footer aside menu dialog".split())
BOILERPLATE = INERT | ASIDES | {"form"}
REGIONS = frozenset({"article", "main"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement ad-banner ad-container ad-slot ad-unit ad-wrapper adsbygoogle sponsor sponsored "
    "sponsored-content promo banner sidebar side-bar site-sidebar widget-area menu main-menu nav-menu navbar nav-bar nav "
    "main-nav site-nav nav-links navigation main-navigation site-navigation primary-navigation breadcrumb breadcrumbs "
    "footer site-footer page-footer header site-header masthead cookie cookies cookie-banner cookie-bar cookie-consent "
    "cookie-notice consent notice alert popup modal newsletter newsletter-signup subscribe signup share share-buttons "
    "sharing social social-links social-media social-share related related-posts related-articles recommended "
    "recommended-posts respond".split())
COMMENT_NAMES = frozenset("comment comments comment-list comment-section comments-section comments-area comment-body "
                          "comment-form comment-respond disqus disqus-thread replies".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
# Parts of longer names that mark boilerplate, and parts before them that take that back.
MENU_PARTS, COMMENT_PARTS = frozenset({"menu"}), frozenset({"comment", "comments"})
WITHOUT = frozenset({"no", "without", "hide", "has", "with"})
_SHARE = 0.2
_LINKED = 0.5  # share of a line's characters in links from which it counts as links
# Fixed values, from HTML's rules: start tags that close an open p or the elements of their own kind, and what bounds that.
CELLS = frozenset({"td", "th", "caption"})
ROWS = CELLS | {"tr"}
GROUPS = ROWS | {"tbody", "thead", "tfoot"}
SCOPE = CELLS | {"table", "template", "object"}
LISTS = SCOPE | frozenset("ul ol dl menu section article main aside nav header footer form blockquote fieldset".split())
CLOSES_P = (BLOCKS | {"menu"}) - frozenset("br body head html legend summary caption tbody td tfoot th thead title tr".split())
IMPLIED = {"li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, LISTS), "dd": ({"dt", "dd"}, LISTS),
           "td": (CELLS, {"table"}), "th": (CELLS, {"table"}), "tr": (ROWS, {"table"}),
           "tbody": (GROUPS, {"table"}), "thead": (GROUPS, {"table"}), "tfoot": (GROUPS, {"table"}),
           "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"})}
IN_HEAD = frozenset("head base link meta title style script noscript template".split())
PAGE_PARTS = REGIONS | ASIDES | {"form", "body", "html", "section"}


class LineParser(HTMLParser):
    """Collects lines as (text, tags, region, mark, linked) and marks as [mark around it, kind, holds an article, holds a main].

    ``linked``: whether most of the line is links and it lies in no article.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.region = self.region_count = 0
        self.mark = -1  # the innermost open element that may be boilerplate
        self.marks: list[list] = []
        self.open: list[tuple[str, int, int]] = []  # open elements: tag, mark and region around them
        self.places: dict[str, list[int]] = {}  # where in ``open`` the elements of a tag are
        self.blocks: list[int] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            links = self.linked > _LINKED * len(text) and not self.places.get("article")
            self.lines.append((text, self.tags, self.region, self.mark, links))
        self.text, self.tags, self.linked = [], 0, 0

    def last(self, tags) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def close_from(self, place: int) -> None:
        """Closes the element at ``place`` and those in it."""
        while len(self.open) > place:
            tag, mark, region = self.open.pop()
            if mark != self.mark:
                self.end_line()
            self.mark, self.region = mark, region
            self.places[tag].pop()
            if self.blocks and self.blocks[-1] == len(self.open):
                self.blocks.pop()

    def close_implied(self, tag: str) -> None:
        if self.places.get("head") and (tag == "body" or (self.open[-1][0] == "head" and tag not in IN_HEAD)):
            self.close_from(self.places["head"][-1])
        kinds, bounds = IMPLIED.get(tag, ((), ()))
        while (place := self.last(kinds)) > self.last(bounds):
            self.close_from(place)
        if tag in CLOSES_P and (place := self.last(("p",))) > self.last(SCOPE | {"button"}):
            self.close_from(place)

    def kind_of(self, tag: str, names: dict) -> str:
        """Why the element may be boilerplate, or an empty text."""
        if tag in INERT:
            return "inert"
        if tag in ASIDES or ("hidden" in names and tag not in ("html", "body")):
            return "aside"
        if tag in ("html", "body") or tag in REGIONS:
            return ""
        words = {w.lower().replace("_", "-") for a in ("class", "id") for w in (names.get(a) or "").split()}
        parts = {b for w in words for a, b in zip(["", *w.split("-")], w.split("-")) if a not in WITHOUT}
        if words & COMMENT_NAMES or parts & COMMENT_PARTS:
            return "comments"
        role = (names.get("role") or "").lower()
        loose = words & BOILERPLATE_NAMES or parts & MENU_PARTS
        return "loose" if tag == "form" or loose or role in BOILERPLATE_ROLES else ""

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCKS or tag in BOILERPLATE:
            self.end_line()
        self.close_implied(tag)
        self.tags += 1
        if tag in VOID:
            return
        kind = self.kind_of(tag, dict(attrs))
        if kind and self.text:
            self.end_line()
        place = len(self.open)
        self.open.append((tag, self.mark, self.region))
        self.places.setdefault(tag, []).append(place)
        if tag != "p" and (tag in BLOCKS or tag in BOILERPLATE):
            self.blocks.append(place)
        if tag in REGIONS:
            at = self.mark
            while at >= 0 and self.marks[at][1] != "inert":
                if self.marks[at][3] or (tag != "main" and (self.marks[at][2] or self.marks[at][1] != "loose")):
                    break
                self.marks[at][2 if tag != "main" else 3] = True
                at = self.marks[at][0]
            if not self.region:
                self.region_count += 1
                self.region = self.region_count
        if kind:
            self.marks.append([self.mark, kind, False, False])
            self.mark = len(self.marks) - 1

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        block = tag in BLOCKS or tag in BOILERPLATE
        if block:
            self.end_line()
        self.tags += 1
        place = self.last((tag,))
        if place < 0:
            return
        if tag in PAGE_PARTS:
            bound = -1
        elif tag in GROUPS or tag == "table":
            bound = self.last(("table",)) if tag != "table" else -1
        elif block:
            bound = self.last(SCOPE | {"ul", "ol"} if tag == "li" else SCOPE - {tag})
        else:
            bound = self.blocks[-1] if self.blocks else -1
        if place > bound:
            self.close_from(place)

    def handle_data(self, data: str) -> None:
        at = self.open[-1][0] if self.open else ""
        if at == "head" and not data.isspace():
            self.close_from(len(self.open) - 1)
        if at not in ("script", "style"):
            self.text.append(data)
            if self.places.get("a"):
                self.linked += len(data.strip())

    def skipped(self) -> list[bool]:
        """Per line whether it is boilerplate."""
        dead: list[bool] = []
        for around, kind, article, main in self.marks:
            stays = kind != "inert" and (main or (kind == "loose" and article))
            dead.append(not stays)
        sizes = [0] * len(self.marks)
        for text, _, _, mark, _ in self.lines:
            if mark >= 0:
                sizes[mark] += len(text)
        total = sum(len(text) for text, _, _, mark, _ in self.lines if mark < 0)
        for m in range(len(self.marks) - 1, -1, -1):
            around, kind = self.marks[m][:2]
            if kind == "inert":
                continue
            if around >= 0:
                sizes[around] += sizes[m]
            else:
                total += sizes[m]

        def inside(of: list[bool]) -> list[bool]:
            out: list[bool] = []
            for (around, *_), own in zip(self.marks, of):
                out.append(own or (around >= 0 and out[around]))
            return out

        within = inside(dead)
        named = sum(len(text) for text, _, region, mark, _ in self.lines if region and (mark < 0 or not within[mark]))
        for m, (_, kind, _, _) in enumerate(self.marks):
            if dead[m] and kind in ("loose", "comments") and 2 * sizes[m] > total and 4 * named < sizes[m]:
                dead[m] = False
        within = inside(dead)
        return [mark >= 0 and within[mark] for *_, mark, _ in self.lines]


def smooth(ratios: np.ndarray, radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    kernel = np.exp(-np.arange(-radius, radius + 1) ** 2 / (2 * sigma ** 2))
    padded = np.pad(ratios, radius, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def without_menus(lines: list[tuple], linked: list[bool], threshold: float) -> list[tuple]:
    """``lines``, blocks of links whose ratio is under the threshold skipped."""
    out, at = list(lines), 0
    while at < len(lines):
        end = at
        while end < len(lines) and linked[end] and not lines[end][3] and lines[end][2] == lines[at][2]:
            end += 1
        chars, tags = sum(len(line[0]) for line in lines[at:end]), sum(line[1] for line in lines[at:end])
        if chars / max(1, tags) < threshold:
            out[at:end] = [(*line[:3], True) for line in lines[at:end]]
        at = max(end, at + 1)
    return out


def main_text(html: str | None, spread: float = 0.5) -> str:
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = [(*line[:3], skip) for line, skip in zip(parser.lines, parser.skipped())]
    if not lines:
        return ""
    ratios = smooth(np.array([0.0 if skip else len(text) / max(1, tags) for text, tags, _, skip in lines]))
    threshold = min(spread * ratios.std(), ratios.max())
    content = ratios >= threshold
    lines = without_menus(lines, [line[4] for line in parser.lines], threshold)
    weight: dict[int, float] = {}
    for (text, _, region, skip), inside in zip(lines, content):
        if not skip:
            weight[region] = weight.get(region, 0.0) + (len(text) if inside else 0.0)
    largest = max(weight.values(), default=0.0)
    body = weight.get(0, 0.0)
    named_first = sum(weight.values()) - body >= body
    selected = {r for r, w in weight.items() if w >= _SHARE * largest or (named_first and r > 0 and w > 0)}
    return " ".join(text for text, _, region, skip in lines if region in selected and not skip)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    return pages.select("page_id", "url", "html").mapInPandas(run, schema)
