"""Tables and links from HTML text, by the standard library's parser in batches of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from gritstone.session import ship


class _Tables(HTMLParser):
    """All table rows as lists of (tag, attributes, text, first link)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[tuple[str, dict, str, str | None]]]] = []
        self.open: list[list[list[tuple[str, dict, str, str | None]]]] = []
        self.cell: tuple[str, dict, list[str], list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append([])
            self.tables.append(self.open[-1])
        elif tag == "tr" and self.open:
            self._end()
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open:
            self._end()
            if not self.open[-1]:
                self.open[-1].append([])
            self.cell = (tag, dict(attrs), [], [])
        elif tag == "a" and self.cell:
            self.cell[3].extend(v for k, v in attrs if k == "href" and v)

    def _end(self):
        if self.cell and self.open and self.open[-1]:
            tag, attrs, text, links = self.cell
            self.open[-1][-1].append((tag, attrs, " ".join("".join(text).split()), links[0] if links else None))
        self.cell = None

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self._end()
        elif tag == "table" and self.open:
            self._end()
            self.open.pop()

    def handle_data(self, data):
        if self.cell:
            self.cell[2].append(data)


def tables(html: str):
    p = _Tables()
    p.feed(html or "")
    p.close()
    return p.tables


def rows_by_attribute(html: str, attribute: str = "data-stat") -> list[dict[str, str]]:
    """Rows keyed by an attribute of their cells; repeated header rows don't count; ``2 (1)`` becomes ``2``."""
    out = []
    for table in tables(html):
        for row in table:
            own = {a[attribute]: text.split(" (")[0] if text[:1].isdigit() else text for _, a, text, _ in row if a.get(attribute)}
            if own and not all(tag == "th" for tag, *_ in row) and any(own.values()):
                out.append(own)
    return out


def rows_by_header(html: str, wanted: Sequence[str], least_rows: int = 10) -> list[dict[str, str]]:
    """Rows of the first table whose headers have all that are wanted and that has rows enough; ranks before names go."""
    for table in tables(html):
        if not table:
            continue
        header = [text for _, _, text, _ in table[0]]
        body = [r for r in table[1:] if any(tag == "td" for tag, *_ in r)]
        if set(wanted) <= set(header) and len(body) >= least_rows:
            return [{h: c[2].split(". ", 1)[1] if c[2].split(". ", 1)[0].isdigit() and ". " in c[2] else c[2] for h, c in zip(header, r)} for r in body]
    return []


def linked_rows(html: str, token: str = "verein") -> list[dict[str, str]]:
    """name, id (the path part after the token of the row's first such link) and the last cell that looks like money."""
    out = []
    for table in tables(html):
        for row in table:
            links = [(text, link.split("/")) for _, _, text, link in row if link and f"/{token}/" in link]
            money = [text for _, _, text, _ in row if any(s in text for s in ("€", "£", "$"))]
            if links:
                text, parts = links[0]
                out.append({"name": text, "id": parts[parts.index(token) + 1], "value": money[-1] if money else ""})
    return out


def explode_pages(pages: DataFrame, key: str, html: str, kind: str = "attribute", **settings) -> DataFrame:
    """key, row (from 0) and cells (a map) of each table row in each page."""
    ship(pages.sparkSession)
    parse = {"attribute": rows_by_attribute, "header": rows_by_header, "links": linked_rows}[kind]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(k, i, r) for k, h in zip(pdf[key], pdf[html]) for i, r in enumerate(parse(h, **settings))]
            if found:  # an empty column has no type that could become a map
                yield pd.DataFrame({key: [x[0] for x in found], "row": [x[1] for x in found], "cells": [x[2] for x in found]})

    return pages.select(key, html).mapInPandas(run, f"{key} {dict(pages.dtypes)[key]}, row int, cells map<string,string>")


class _Outline(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.links, self.words, self.skip, self.in_title = [], 0, 0, 0, False

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.in_title |= tag == "title"
        self.links += tag == "a" and any(k == "href" for k, _ in attrs)

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0
        self.in_title &= tag != "title"

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.skip:
            self.words += len(data.split())


def outlines(pages: DataFrame) -> DataFrame:
    """page_id, title, links and words of each page."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, h in zip(pdf["page_id"], pdf["html"]):
                p = _Outline()
                p.feed(h or "")
                p.close()
                rows.append((k, "".join(p.title).strip(), p.links, p.words))
            yield pd.DataFrame(rows, columns=["page_id", "title", "n_links", "n_words"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, title string, n_links long, n_words long")
