"""Main text of web pages by the distribution of text over blocks of lines."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.llm.common import query, table

#: Lines in a sliding window, and the text a window must hold to be a surge (or half of the page's fullest window).
WINDOW = 3
SURGE = 80

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template"}
APART = {"nav", "footer", "aside", "form", "button", "select", "head", "svg", "dialog", "menu", "object", "canvas"}
LINE = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
BOXES = {"div", "section", "ul", "ol", "dl", "table", "p", "span", "header", "figure", "details"}
#: Words of a class, id or role that mark a box beside the article.
BESIDE = frozenset(
    "ad ads advert advertisement advertising adbox sponsor sponsored promo promotion banner sidebar side widget menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead topbar header notice cookie cookies consent popup modal alert "
    "comment comments reply replies disqus share sharing social related recommended newsletter subscribe signup login search "
    "contentinfo complementary pagination pager tags copyright".split())
#: Those of them that stand on wrappers of whole pages as well, as in "has-sidebar".
WRAPPING = frozenset("sidebar side header menu nav navbar banner widget tags share sharing social related search form".split())
READERS = frozenset("comment comments reply replies disqus".split())
ARTICLE = ("main", "article")
#: Elements that hold blocks of text; the text of each shows whether a box stands between its paragraphs.
HOLDERS = {"body", "div", "section", "td", "th", "article", "main", "blockquote", "center", "details", "figure", "dd", "li"}
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>")
#: Characters within which a tag with quoted values must end; beyond, quotes are not looked at.
TAG_SIZE = 4096
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")
ANY_TAG = re.compile(r"<!--(?:[^-]|-(?!->))*+(?:-->)?|<(/?)([a-z][^\s/<>]*)[^<>]*+>")


def _beside(name: str, attributes: str, in_article: bool) -> set[str]:
    """Words that mark an element as a box beside the article; a name of APART counts as one."""
    if name in APART:
        return {name}
    words: set[str] = {"header"} if name == "header" else set()
    if name in BOXES and "=" in attributes:
        for a, b, c in NAMES.findall(attributes):
            words |= BESIDE.intersection(PART.findall((a or b or c).lower()))
    return words - {"header"} if in_article else words


class Outline:
    """Where the elements of a page end, where its article begins, and how much text outside links a stretch has.

    Each name's tags, and the text, are read once, when first asked for."""

    def __init__(self, html: str):
        self.lower = html.lower()
        self._ends: dict[str, dict[int, int]] = {}
        self._first: dict[str, int] = {}
        self._text: tuple[list[int], list[int]] | None = None

    def end(self, name: str, start: int) -> int:
        """End of the element whose start tag begins at `start`; its last possible end if it is not closed, or -1."""
        if name not in self._ends:
            self._ends[name] = self._pair(name)
        return self._ends[name].get(start, -1)

    def _pair(self, name: str) -> dict[int, int]:
        ends: dict[int, int] = {}
        still_open: list[int] = []
        last, last_end = -1, -1
        for tag in re.finditer(rf"<(/?){re.escape(name)}(?=[\s/>]|$)", self.lower):
            start = tag.start()
            if not tag[1]:
                if name == "p" and still_open:  # an open paragraph ends where the next begins
                    ends[still_open.pop()] = start
                if name not in RAW or not still_open:
                    still_open.append(start)
                continue
            stop = self.lower.find(">", tag.end())
            last, last_end = start, len(self.lower) if stop < 0 else stop + 1
            if still_open:
                ends[still_open.pop()] = last_end
        for start in still_open:
            if start < last:
                ends[start] = last_end
        return ends

    def first(self, name: str) -> int:
        """Start of the first tag of a name, or -1."""
        if name not in self._first:
            tag = re.search(rf"<{name}(?=[\s/>])", self.lower)
            self._first[name] = tag.start() if tag else -1
        return self._first[name]

    def holds(self, name: str, start: int, stop: int) -> bool:
        """Whether the first tag of a name lies within a stretch."""
        return start < self.first(name) < stop

    def text(self, start: int, stop: int) -> int:
        """About how many characters outside tags and links a stretch has."""
        if self._text is None:
            places, sums, total, at, skipped = [0], [0], 0, 0, ""
            for tag in ANY_TAG.finditer(self.lower):
                if not skipped:
                    total += len(self.lower[at:tag.start()].strip())
                places.append(tag.start())
                sums.append(total)
                at, name = tag.end(), tag[2]
                if skipped:
                    skipped = "" if tag[1] and name == skipped else skipped
                elif name and not tag[1] and (name == "a" or name in RAW):
                    skipped = name
            places.append(len(self.lower))
            sums.append(total if skipped else total + len(self.lower[at:].strip()))
            self._text = places, sums
        places, sums = self._text
        upto = [sums[bisect_right(places, x) - 1] for x in (start, stop)]
        return upto[1] - upto[0]

    def keeps(self, words: set[str], name: str, start: int, stop: int, in_article: bool) -> bool:
        """Whether an element that is named like a box holds the article all the same.

        It does if the first main or article begins in it; if it has the page's headline and no article has one; or if
        it has over half of the page's text, is named like a wrapper, and no main or article stands elsewhere."""
        if name in APART and name != "form":
            return False
        if any(self.holds(mark, start, stop) for mark in ARTICLE):
            return True
        marked = [self.first(mark) for mark in ARTICLE if self.first(mark) >= 0]
        if self.holds("h1", start, stop) and words <= WRAPPING:
            if in_article or not any(self.lower.find("<h1", m, self.end(n, m)) >= 0 for n, m in (
                    (n, self.first(n)) for n in ARTICLE) if m >= 0):
                return True
        if words <= WRAPPING and (in_article or not marked):
            return 2 * self.text(start, stop) > self.text(0, len(self.lower))
        return False


def page_lines(html: str) -> list[tuple[str, int]]:
    """Lines of a page without markup, and the length of each one's text outside links.

    Block-level tags end lines. Boxes beside the article (menus, footers, forms, adverts and the like) leave empty lines,
    as many as they had; but none within main or article, nor, adverts and the like, behind paragraphs of their own parent.
    Lines of main and article that are all links have a length of 1, so they end no run. Scripts, styles and comments leave
    nothing. White space is one space, references are decoded."""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    linked = 0
    in_link = False
    outline = Outline(html)
    lower = outline.lower
    holders: list[list] = [["", 0]]  # open elements that hold text, with the length of what each has itself
    opened: Counter[str] = Counter()

    def in_article() -> bool:
        return any(opened[name] for name in ARTICLE)

    def end_line() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            free = max(0, len(text) - linked)
            lines.append((text, max(1, free) if in_article() else free))
            holders[-1][1] += free
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        text = unescape(text)
        parts.append(text)
        if in_link:
            linked += len(" ".join(text.split()))

    at, n = 0, len(html)
    while at < n:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        if start > at:
            add(html[at:start])
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = n if stop < 0 else stop + 3
            continue
        if html.startswith(("<!", "<?"), start):
            stop = html.find(">", start)
            at = n if stop < 0 else stop + 1
            continue
        tag = TAG.match(html, start, start + TAG_SIZE) or LOOSE_TAG.match(html, start)
        if not tag:
            add("<")
            at = start + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            in_link = in_link and name != "a"
            if name in LINE:
                end_line()
            while opened[name]:
                shut = holders.pop()[0]
                opened[shut] -= 1
                if shut == name:
                    break
            continue
        if name in RAW:
            stop = outline.end(name, start)
            if stop >= 0:
                at = stop
            elif name not in ("title", "template", "noscript"):
                at = n  # what is left is the element's
            continue
        words = _beside(name, tag[3], in_article())
        stop = outline.end(name, start) if words else -1
        if stop >= at and not outline.keeps(words, name, start, stop, in_article()):
            if name != "head":
                if name != "span":
                    end_line()
                between = holders[-1][1] >= SURGE and name not in ("nav", "footer", "header") and READERS.isdisjoint(words)
                if not in_article() and not between:
                    inside = [lower.count(mark, at, stop) for mark in ("<li", "<p>", "<p ", "<div")]
                    lines += [("", 0)] * (1 + sum(inside))
            at = stop
            continue
        if name in HOLDERS:
            end_line()
            holders.append([name, 0])
            opened[name] += 1
        if name == "a":
            in_link = True
        elif name == "br":
            parts.append(" ")
        elif name in LINE:
            in_link = False
            end_line()
    end_line()
    return lines


def text_runs(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """Runs of lines [first, end) from a surge point to a dive point.

    Where a window's text reaches `surge`, or half that of the fullest window where that is less, text surges; the surge
    point is where the rise to it began, behind the last line without text. The dive point is the next window without
    text, or the end."""
    sums = [sum(lengths[i:i + window]) for i in range(len(lengths))]
    wanted = min(surge, max(sums, default=0) / 2)
    out, i = [], 0
    while i < len(sums):
        if sums[i] and sums[i] >= wanted:
            first, j = i, i
            while first > 0 and lengths[first - 1]:
                first -= 1
            while not lengths[first]:
                first += 1
            while j < len(sums) and sums[j]:
                j += 1
            out.append((first, j))
            i = j
        else:
            i += 1
    return out


def main_text(html: str | None) -> str:
    """Lines between surge and dive points, joined by blank lines; empty for null or where there is none."""
    lines = page_lines(html or "")
    kept = [line for a, b in text_runs([n for _, n in lines]) for line, _ in lines[a:b] if line]
    return "\n\n".join(kept)


def extracted(pages: DataFrame, out: str = "text") -> DataFrame:
    """All rows and columns of `pages` and the main text of `html` in `out`, empty where there is none or html is null.

    Whole pages are read, each in time linear in its length but for names like boxes nested in each other; there is no shuffle. Repeated
    rows are read each. A column that is already named `out` is replaced."""
    @F.pandas_udf("string")
    def extract(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in html], index=html.index, dtype=object)

    return pages.withColumn(out, extract(F.col("html")))


@query("op4_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extracted(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
