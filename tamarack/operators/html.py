"""Pages from HTML: title, text, tables, PDF links and images.

Built on the standard parser in an Arrow function; markup that isn't closed doesn't lose
text. A page that can't be parsed gives nulls, never a failed task.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls

#: Elements whose whole content is dropped, and elements that have no end.
DROPPED = ("script", "style", "nav", "footer", "header")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SCHEMA = "title string, text_content string, tables array<array<array<string>>>, pdf_links array<string>, images array<string>, content_length int"


class _Reader(HTMLParser):
    def __init__(self, dropped: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.dropped = frozenset(dropped)
        self.skip: list[str] = []  # open dropped elements
        self.title, self.in_title = [], False
        self.texts: list[str] = []
        self.tables: list[list[list[str]]] = []
        self.open_tables: list[list[list[str]]] = []
        self.cells: list[list[str]] = []  # open cells' texts, innermost last
        self.links: list[str] = []
        self.images: list[str] = []

    def handle_starttag(self, tag, attrs):
        if self.skip:
            if tag in self.dropped and tag not in _VOID:
                self.skip.append(tag)
            return
        if tag in self.dropped:
            self.skip.append(tag)
            return
        a = dict(attrs)
        if tag == "title":
            self.in_title = True
        elif tag == "a" and a.get("href"):
            self.links.append(a["href"])
        elif tag == "img" and a.get("src"):
            self.images.append(a["src"])
        elif tag == "table":
            t: list[list[str]] = []
            self.tables.append(t)
            self.open_tables.append(t)
        elif tag == "tr" and self.open_tables:
            row: list[str] = []
            for t in self.open_tables:  # a nested table's rows are also rows of the outer one
                t.append(row)
        elif tag in ("td", "th") and self.open_tables and self.open_tables[-1]:
            span = a.get("colspan") or "1"
            self.cells.append([])
            row = self.open_tables[-1][-1]
            row.append(self.cells[-1])  # joined at the end
            row.extend([] for _ in range(max(0, int(span) - 1 if span.isdigit() else 0)))

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if tag == "title":
            self.in_title = False
        elif tag in ("td", "th") and self.cells:
            self.cells.pop()
        elif tag == "table" and self.open_tables:
            self.open_tables.pop()

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_title:
            self.title.append(data)
        text = data.strip()
        if text:
            self.texts.append(text)
        for c in self.cells[-1:]:
            c.append(data)

    def error(self, message):  # pragma: no cover
        raise ValueError(message)


def parse_html(source: str, url: str = "", dropped: tuple[str, ...] = DROPPED) -> tuple | None:
    """(title, text, tables of two rows or more, absolute PDF links, absolute images, length), or None if it can't be parsed."""
    try:
        r = _Reader(dropped)
        r.feed(source)
        r.close()
        tables = []
        for t in r.tables:
            rows = [["".join(c).strip() for c in row] for row in t if row]
            rows = [row for row in rows if any(row)]
            if len(rows) >= 2:
                tables.append(rows)
        text = re.sub(r"\n{3,}", "\n\n", "\n".join(r.texts))
        link = lambda h: urljoin(url, h)
        pdfs = [link(h) for h in r.links if h.lower().endswith(".pdf")]
        return "".join(r.title).strip(), text, tables, pdfs, [link(s) for s in r.images], len(text)
    except (ValueError, AssertionError, RecursionError):
        return None


def parsed(html: Column, url: Column, dropped: tuple[str, ...] = DROPPED) -> Column:
    """Struct of a page's parts; null for null or unreadable HTML."""

    @F.pandas_udf(SCHEMA)
    def run(sources: pd.Series, addresses: pd.Series) -> pd.DataFrame:
        rows = [parse_html(s, u or "", dropped) if s is not None else None for s, u in zip(sources, addresses)]
        return pd.DataFrame([r or (None,) * 6 for r in rows], columns=["title", "text_content", "tables", "pdf_links", "images", "content_length"]).astype({"content_length": "Int32"})

    return run(html, url)


def pages(raw: DataFrame, least: int = 100, dropped: tuple[str, ...] = DROPPED, v6: bool = True) -> DataFrame:
    """Pages of raw(url, html, ...) with more than ``least`` characters of text; unsafe links and images are left out."""
    df = raw.withColumn("_p", parsed(F.col("html"), F.col("url"), dropped)).drop("html")
    keep = [c for c in df.columns if c != "_p"]
    safe = lambda c: F.filter(F.col(f"_p.{c}"), lambda u: urls.is_safe(u, v6=v6)).alias(c)
    out = df.select(*keep, "_p.title", "_p.text_content", "_p.tables", safe("pdf_links"), safe("images"), "_p.content_length")
    return out.where(F.col("content_length") > least)
