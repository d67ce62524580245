"""Cell extraction from raw HTML over a table of pages.

Elements without structure are found by SQL expressions. Tables nest, so they are read by a scan over the tags of a page with a
stack of what is open.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?</\1\s*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?")
MOST_SPAN = 1000  # columns or rows a cell can claim, as browsers have it


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(v[1:-1] if v[:1] in "\"'" else v) for k, v in ATTRIBUTE.findall(text or "")}


def _span(attributes: dict[str, str], name: str) -> int:
    digits = re.match(r"\s*(\d+)", attributes.get(name, ""))
    return min(max(int(digits[1]), 1), MOST_SPAN) if digits else 1


class _Table:
    """A table that is open: its rows so far, and the row and cell that are open in it."""

    def __init__(self, wanted: bool):
        self.wanted, self.rows, self.row, self.cell, self.tag = wanted, [], None, None, ""

    def close_cell(self) -> None:
        if self.cell is not None and self.row is not None:
            text = entities.unescape("".join(self.cell[0])).strip()
            self.row.append((self.tag, text or None, *self.cell[1:]))
        self.cell = None

    def close_row(self) -> None:
        self.close_cell()
        if self.row is not None:
            self.rows.append(self.row)
        self.row = None


def scan_table(page: str | None, table_id: str) -> list[list[tuple]] | None:
    """Rows of the first table with the id, each a list of (tag, text or None, colspan, rowspan); None without such a table.

    A table inside a cell adds its text to that cell, not rows to the outer table. Cells and rows without an end tag end where
    the next one begins. Comments, scripts and styles are passed over; a table that is not closed ends with the page.
    """
    open_tables: list[_Table] = []
    last, page = 0, page or ""

    def text(part: str) -> None:
        for t in open_tables:
            if t.cell is not None:
                t.cell[0].append(part)

    for m in TOKEN.finditer(page):
        text(page[last: m.start()])
        last = m.end()
        tag = (m[3] or "").lower()
        if tag == "table" and not m[2]:
            here = any(t.wanted for t in open_tables)
            open_tables.append(_Table(not here and _attributes(m[4]).get("id") == table_id))
        elif tag == "table" and open_tables:
            t = open_tables.pop()
            t.close_row()
            if t.wanted:
                return t.rows
        elif tag == "tr" and open_tables:
            open_tables[-1].close_row()
            if not m[2]:
                open_tables[-1].row = []
        elif tag in ("td", "th") and open_tables:
            t = open_tables[-1]
            t.close_cell()
            if not m[2]:
                if t.row is None:
                    t.row = []
                own = _attributes(m[4])
                t.tag, t.cell = tag, ([], _span(own, "colspan"), _span(own, "rowspan"))
    text(page[last:])
    for t in open_tables:
        if t.wanted:
            t.close_row()
            return t.rows
    return None


def spread(rows: list[list[tuple]]) -> list[list[tuple]]:
    """Cells that span columns or rows, repeated in every place they cover."""
    out, waiting = [], {}
    for row in rows:
        line, left = [], list(row)
        while left or any(k >= len(line) for k in waiting):
            k = len(line)
            if k in waiting:
                cell, n = waiting.pop(k)
                line.append(cell)
                if n > 1:
                    waiting[k] = (cell, n - 1)
            elif left:
                cell = left.pop(0)
                for j in range(cell[2]):
                    if k + j in waiting:
                        break
                    line.append(cell)
                    if cell[3] > 1:
                        waiting[k + j] = (cell, cell[3] - 1)
            else:
                line.append(("td", None, 1, 1))
        out.append(line)
    return out


def cells(fragment: Column, tag: str) -> Column:
    """Trimmed text of every ``tag`` element of a fragment; empty cells stay as NULL entries."""
    found = F.regexp_extract_all(fragment, F.lit(f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    bare = F.transform(found, lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", "")))
    return F.transform(bare, lambda c: F.when(c != "", c))


def elements(df: DataFrame, html: str, tag: str, keep) -> DataFrame:
    """keep..., position, cell: one row per element with text."""
    out = df.select(*keep, F.posexplode(cells(F.col(html), tag)).alias("position", "cell"))
    return out.where(F.col("cell").isNotNull())


def table_rows(df: DataFrame, html: str, table_id: str, names, keep=(), strict: bool = True, spans: bool = False) -> DataFrame:
    """Rows of the table with the given id: positional names, header-only rows skipped.

    With ``strict`` a row with another number of cells is left out rather than shifted; `rejected_rows` lists those. With
    ``spans`` a cell counts in every column and row that it spans.
    """
    out = _rows_of(df, html, table_id, keep, spans)
    if strict:
        out = out.where(F.size("_c") == len(names))
    return out.select(*keep, "row", *[F.try_element_at("_c", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def rejected_rows(df: DataFrame, html: str, table_id: str, names, keep=(), spans: bool = False) -> DataFrame:
    """keep..., row, cells: the rows `table_rows` leaves out for their number of cells."""
    out = _rows_of(df, html, table_id, keep, spans).where(F.size("_c") != len(names))
    return out.select(*keep, "row", F.size("_c").alias("cells"))


def _rows_of(df: DataFrame, html: str, table_id: str, keep, spans: bool = False) -> DataFrame:
    """keep..., row (position in the table) and _c (texts of the data cells) of rows that have a data cell."""
    def scan(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            found = [scan_table(page, table_id) or [] for page in batch]
            yield pd.Series([[[c[1] for c in row if c[0] == "td"] for row in (spread(rows) if spans else rows)] for rows in found])

    # a page without the id in it has no such table, and is not sent to Python
    page = F.when(F.contains(F.col(html), F.lit(table_id)) | F.contains(F.col(html), F.lit("&")), F.col(html))
    rows = df.select(*keep, F.pandas_udf(scan, "array<array<string>>")(page).alias("_rows"))
    return rows.select(*keep, F.posexplode("_rows").alias("row", "_c")).where(F.size("_c") > 0)
