"""HTML pages as rows: tables without loss, links and page diagnostics, with the standard library's parser, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame


class Page(HTMLParser):
    """Collects title, headings, links, counts and tables; text is joined by single blanks. Cells of nested tables belong to the inner table."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.headings, self.links, self.tables = "", [], [], []
        self.counts = {"table": 0, "a": 0, "form": 0, "script": 0}
        self._open: list[dict] = []
        self._text: list[list[str]] = []
        self._mute = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.counts and (tag != "a" or dict(attrs).get("href")):
            self.counts[tag] += 1
        if tag in ("script", "style"):
            self._mute += 1
        if tag == "a" and (href := (dict(attrs).get("href") or "").strip()) and not href.startswith("#"):
            self.links.append(href)
        if tag == "table":
            self._open.append({"rows": [], "cell": None})
        elif tag == "tr" and self._open:
            self._close_cell()
            self._open[-1]["rows"].append([])
        elif tag in ("td", "th") and self._open:
            self._close_cell()
            if not self._open[-1]["rows"]:
                self._open[-1]["rows"].append([])
            self._open[-1]["cell"] = []
        elif tag in ("title", "h1", "h2", "h3", "h4", "h5", "h6"):
            self._text.append([])

    def _close_cell(self) -> None:
        t = self._open[-1]
        if t["cell"] is not None:
            t["rows"][-1].append(" ".join(" ".join(t["cell"]).split()))
            t["cell"] = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self._mute = max(0, self._mute - 1)
        if tag in ("td", "th") and self._open:
            self._close_cell()
        elif tag == "table" and self._open:
            self._close_cell()
            self.tables.append([r for r in self._open.pop()["rows"] if r])
        elif tag in ("title", "h1", "h2", "h3", "h4", "h5", "h6") and self._text:
            words = " ".join(" ".join(self._text.pop()).split())
            if tag == "title":
                self.title = self.title or words
            elif words and words not in self.headings:
                self.headings.append(words)

    def handle_data(self, data: str) -> None:
        if self._mute or not data.strip():
            return
        if self._open and self._open[-1]["cell"] is not None:
            self._open[-1]["cell"].append(data)
        if self._text:
            self._text[-1].append(data)


def parse(html: str | None) -> Page:
    page = Page()
    page.feed(html or "")
    page.close()
    while page._open:  # tables never closed
        page.handle_endtag("table")
    return page


def pages_to_rows(df: DataFrame, key: str, html: str, kind: str = "bigint") -> DataFrame:
    """(key, title, headings, links, n_tables, n_links, n_forms, n_scripts, tables) per page; a null page has nothing. Malformed markup is read as far as it goes."""
    schema = f"{key} {kind}, title string, headings array<string>, links array<string>, n_tables int, n_links int, n_forms int, n_scripts int, tables array<struct<table_index:int,rows:array<array<string>>>>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, text in zip(b[key], b[html], strict=True):
                p = parse(text)
                tables = [{"table_index": i + 1, "rows": t} for i, t in enumerate(x for x in p.tables if x)]
                out.append((k, p.title, p.headings, p.links, p.counts["table"], p.counts["a"], p.counts["form"], p.counts["script"], tables))
            yield pd.DataFrame(out, columns=[f.split(" ")[0] for f in (key, "title", "headings", "links", "n_tables", "n_links", "n_forms", "n_scripts", "tables")])

    return df.select(key, html).mapInPandas(read, schema)
