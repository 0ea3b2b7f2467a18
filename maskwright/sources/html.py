"""Text, links and detail pages of fetched HTML."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_HIDDEN = {"script", "style", "noscript"}
_BREAKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "table", "ul", "ol", "section", "article", "nav", "header", "footer", "title"}
#: containers that hold the document proper, best first
PREFERRED_IDS = ("jud", "jud_content")


class _Reader(HTMLParser):
    """Collects the title, all visible text, and text below preferred containers."""

    def __init__(self, preferred: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.preferred, self.hidden, self.in_title = preferred, 0, False
        self.title, self.parts, self.inner = "", [], {p: [] for p in preferred}
        self.open: list[tuple[str, str | None]] = []

    def handle_starttag(self, tag, attrs):
        mark = dict(attrs).get("id")
        if tag not in ("br", "img", "meta", "link", "input", "hr"):
            self.open.append((tag, mark if mark in self.preferred else None))
        self.hidden += tag in _HIDDEN
        self.in_title = self.in_title or tag == "title"
        if tag in _BREAKS:
            self._add("\n")

    def handle_endtag(self, tag):
        if tag in _HIDDEN and self.hidden:
            self.hidden -= 1
        if tag == "title":
            self.in_title = False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break
        if tag in _BREAKS:
            self._add("\n")

    def handle_data(self, data):
        if self.hidden:
            return
        if self.in_title:
            self.title += data
        else:
            self._add(data)

    def _add(self, data):
        self.parts.append(data)
        for _, mark in self.open:
            if mark:
                self.inner[mark].append(data)


def _lines(parts: list[str]) -> str:
    lines = (" ".join(line.split()) for line in "".join(parts).split("\n"))
    return "\n".join(line for line in lines if line)


def read_html(html: str, preferred: tuple[str, ...] = PREFERRED_IDS) -> tuple[str, str]:
    """Title and visible text; a preferred container, where there is one, is all the text."""
    reader = _Reader(preferred)
    reader.feed(html)
    reader.close()
    inner = next((reader.inner[p] for p in preferred if "".join(reader.inner[p]).strip()), None)
    return " ".join(reader.title.split()), _lines(inner if inner is not None else reader.parts)


def html_text(html: Column) -> Column:
    """struct<title, body> of a page."""

    @F.pandas_udf("title string, body string")
    def extract(pages: pd.Series) -> pd.DataFrame:
        found = [read_html(h) if h is not None else (None, None) for h in pages]
        return pd.DataFrame(found, columns=["title", "body"])

    return extract(html)


def absolute_links(html: Column, base: Column) -> Column:
    """Distinct link targets in order, joined to the page's address."""

    @F.pandas_udf("array<string>")
    def join(links: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([list(dict.fromkeys(urljoin(b or "", link.rstrip("),;")) for link in found)) if found is not None else None for found, b in zip(links, bases)])

    return join(F.regexp_extract_all(F.replace(html, F.lit("\\/"), F.lit("/")), F.lit("""(?:href|src)=["']([^"']+)["']"""), F.lit(1)), base)


def choose_url(urls: Column, part: Column) -> Column:
    """First URL that has ``part`` once decoded, else the only one, else null."""
    hit = F.filter(urls, lambda u: F.contains(F.coalesce(F.try_url_decode(u), u), part))
    return F.coalesce(F.get(hit, F.lit(0)), F.when(F.size(urls) == 1, F.get(urls, F.lit(0))))
