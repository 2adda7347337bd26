"""HTML pages as table rows with what layouts need: classes, cells, links and emphasis. A batch of pages at a time, standard library parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = "struct<tbl:int,table_id:string,table_class:string,row:int,row_class:string,direct:boolean,cells:array<struct<text:string,tag:string,links:array<string>,bold:string>>>"
_TABLE_PARTS = ("tbody", "thead", "tfoot")


def _squeezed(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


class Rows(HTMLParser):
    """Rows of all tables in the order they open. A cell's text, links and bold text include those of tables nested in it; `direct` tells that a row stands right under its table."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.text: list[str] = []
        self._tables: list[dict] = []
        self._cells: list[dict] = []
        self._count = self._mute = self._bold = 0

    def _end_cell(self, table: dict) -> None:
        while self._cells and self._cells[-1]["of"] is table:
            cell = self._cells.pop()
            if table["current"] is not None:
                table["current"]["cells"].append({"text": _squeezed(cell["text"]), "tag": cell["tag"], "links": cell["links"], "bold": _squeezed(cell["bold"])})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        top = self._tables[-1] if self._tables else None
        if tag in ("script", "style"):
            self._mute += 1
        elif tag == "table":
            self._count += 1
            self._tables.append({"tbl": self._count, "table_id": a.get("id") or "", "table_class": a.get("class") or "", "part": False, "n": 0, "current": None})
        elif tag in _TABLE_PARTS and top:
            self._end_cell(top)
            top["part"] = True
        elif tag == "tr" and top:
            self._end_cell(top)
            top["n"] += 1
            top["current"] = {k: top[k] for k in ("tbl", "table_id", "table_class")} | {"row": top["n"], "row_class": a.get("class") or "", "direct": not top["part"], "cells": []}
            self.rows.append(top["current"])
        elif tag in ("td", "th") and top:
            self._end_cell(top)
            self._cells.append({"of": top, "tag": tag, "text": [], "links": [], "bold": []})
        elif tag == "a" and a.get("href"):
            for c in self._cells:
                c["links"].append(a["href"].strip())
        elif tag in ("b", "strong"):
            self._bold += 1

    def handle_endtag(self, tag: str) -> None:
        top = self._tables[-1] if self._tables else None
        if tag in ("script", "style"):
            self._mute = max(0, self._mute - 1)
        elif tag in ("b", "strong"):
            self._bold = max(0, self._bold - 1)
        elif tag in ("td", "th", "tr") and top:
            self._end_cell(top)
        elif tag in _TABLE_PARTS and top:
            self._end_cell(top)
            top["part"] = False
        elif tag == "table" and top:
            self._end_cell(top)
            self._tables.pop()

    def handle_data(self, data: str) -> None:
        if self._mute or not data.strip():
            return
        self.text.append(data)
        for c in self._cells:
            c["text"].append(data)
            if self._bold:
                c["bold"].append(data)


def page_rows(df: DataFrame, key: str, html: str, kind: str = "bigint") -> DataFrame:
    """(key, text, rows) per page: its visible text with single blanks, and its table rows. A null page has neither; malformed markup is read as far as it goes; other columns are left out."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, content in zip(b[key], b[html], strict=True):
                p = Rows()
                p.feed(content or "")
                p.close()
                while p._tables:
                    p.handle_endtag("table")
                out.append((k, _squeezed(p.text), p.rows))
            yield pd.DataFrame(out, columns=[key, "text", "rows"])

    return df.select(key, html).mapInPandas(read, f"{key} {kind}, text string, rows array<{ROW}>")


def rows_of(pages: DataFrame, key: str) -> DataFrame:
    """One row per table row: the key, the row's fields, `values` (texts of its cells) and `tds` (of those that are td)."""
    r = pages.select(key, F.explode("rows").alias("r")).select(key, "r.*")
    return r.withColumn("values", F.transform("cells", lambda c: c["text"])).withColumn("tds", F.transform(F.filter("cells", lambda c: c["tag"] == "td"), lambda c: c["text"]))
