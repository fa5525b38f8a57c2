"""Main text of web pages by the text-to-tag ratio of their lines.

The page is read as a stream of parser events. Every block of text (what lies between two block-level tags) is a line with a
number of characters, of characters inside links and of tags. The ratio of text outside links to tags is smoothed over
neighbouring lines with a Gaussian, and a threshold (two clusters of the logarithm, found by two-means) tells content
lines from others. Content lines vote for the container that holds the article: the innermost one with nearly all of the
content, an ``article`` or ``main`` first. The result is every line inside it that is not in a navigation, form,
comment or similar part.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, and common names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr""".split())
DROPPED = frozenset("""nav header footer aside form script style noscript template iframe svg button select textarea title menu
dialog object canvas audio video fieldset""".split())
PARTS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar
side menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices popup
modal overlay newsletter subscribe subscription comment comments reply replies disqus respond related share sharing social widget
login signup search pagination pager toolbar""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "p": {"p"}}
HOLDERS = frozenset("html body article main section div td blockquote".split())


class _Lines(HTMLParser):
    """Collects lines: [text parts, characters in links, tags, open containers, in a dropped part]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []
        self.kinds: list[str] = []
        self.lines: list[tuple[str, int, int, tuple[int, ...], bool]] = []
        self.parts: list[str] = []
        self.linked = self.tags = 0
        self.links = 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            holders = tuple(at for _, at, _ in self.stack if at >= 0)
            self.lines.append((text, self.linked, self.tags, holders, any(drop for *_, drop in self.stack)))
            self.tags = 0
        self.parts, self.linked = [], 0

    @staticmethod
    def unwanted(tag: str, attrs) -> bool:
        if tag in DROPPED:
            return True
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if value and key in ("class", "id") and tag not in ("html", "body", "article", "main"):
                if PARTS.intersection(value.lower().replace("-", " ").replace("_", " ").split()):
                    return True
            if value and (key == "role" and value.lower() in ROLES or key == "style" and "display:none" in value.replace(" ", "").lower()):
                return True
        return False

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
        if tag not in INLINE:
            self.flush()
            closes = CLOSED_BY.get(tag, {"p"} if tag in HOLDERS or tag in DROPPED or tag in ("ul", "ol", "table", "pre", "h1", "h2", "h3",
                                                                                         "h4", "h5", "h6", "dl") else ())
            while self.stack and self.stack[-1][0] in closes:
                self.stack.pop()
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        if tag not in INLINE or self.unwanted(tag, attrs):
            if tag in INLINE:
                self.flush()
            at = -1
            if tag in HOLDERS:
                at = len(self.kinds)
                self.kinds.append(tag)
            self.stack.append((tag, at, self.unwanted(tag, attrs)))

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        found = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if tag not in INLINE or found is not None:
            self.flush()
        if found is not None:
            del self.stack[found:]

    def handle_data(self, data):
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def ratios(lines) -> np.ndarray:
    """Characters outside links per tag of each line."""
    return np.array([max(0, len(text) - linked) / max(1, tags) for text, linked, tags, *_ in lines])


def smoothed(values: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma * sigma))
    kernel /= kernel.sum()
    return np.convolve(np.pad(values, reach, mode="edge"), kernel, mode="valid")


def split_point(values: np.ndarray, rounds: int = 20) -> float:
    """Border of two clusters of log(1 + value), or below all values if they do not differ."""
    logs = np.log1p(values)
    low, high = logs.min(), logs.max()
    if high - low < 1e-9:
        return -1.0
    for _ in range(rounds):
        border = (low + high) / 2
        new = logs[logs <= border].mean(), logs[logs > border].mean()
        if new == (low, high):
            break
        low, high = new
    return float(np.expm1((low + high) / 2))


def main_text(html: str | None, share: float = 0.9) -> str:
    """Main text of one page: its lines joined by an empty line; empty for null, empty or text-free pages."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    lines = parser.lines
    wanted = [i for i, line in enumerate(lines) if not line[4]]
    if not wanted:
        return ""
    smooth = smoothed(ratios(lines))
    border = split_point(smooth)
    content = [i for i in wanted if smooth[i] > border] or wanted
    weight: dict[int, int] = {}
    for i in content:
        for holder in lines[i][3]:
            weight[holder] = weight.get(holder, 0) + len(lines[i][0])
    total = sum(len(lines[i][0]) for i in content)
    articles = [h for h in weight if parser.kinds[h] in ("article", "main")]
    if articles and sum(len(lines[i][0]) for i in content if set(articles).intersection(lines[i][3])) >= 0.5 * total:
        chosen = set(articles)
    else:
        full = [h for h, w in weight.items() if w >= share * total]
        chosen = {max(full)} if full else None
    return "\n\n".join(lines[i][0] for i in wanted if chosen is None or chosen.intersection(lines[i][3]))


def text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return run(html.cast("string"))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns with the main ``text`` of every page and its length in code points."""
    return pages.select(*keep, text_column(F.col(html_col)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
