"""Tables inside stored web pages."""
from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

ROWS_PER_FRAME = 5_000


class _TableText(HTMLParser):
    """Collects the cells of the first table carrying a class."""

    def __init__(self, table_class: str):
        super().__init__(convert_charrefs=True)
        self.table_class, self.depth, self.done = table_class, 0, False
        self.rows: list[list[tuple[str, int, int]]] = []
        self.cell: list[str] | None = None
        self.spans = (1, 1)

    def _matches(self, attrs: dict) -> bool:
        value = attrs.get("class") or ""
        return value == self.table_class or self.table_class in value.split()

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        attrs = dict(attrs)
        if tag == "table" and (self.depth or self._matches(attrs)):
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self._close_cell()
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._close_cell()
            self.cell = []
            self.spans = tuple(int(v) if (v := attrs.get(a) or "").isdigit() else 1 for a in ("colspan", "rowspan"))
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if self.depth == 1 and tag in ("td", "th", "tr", "table"):
            self._close_cell()
        if tag == "table":
            self.depth -= 1
            self.done = self.depth == 0

    def handle_data(self, data):
        if self.cell is not None and not self.done:
            self.cell.append(data)

    def _close_cell(self):
        if self.cell is not None and self.rows:
            self.rows[-1].append((" ".join("".join(self.cell).split()), *self.spans))
        self.cell = None


def _grid(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Repeat spanning cells into every place they cover."""
    grid, pending = [], {}
    for row in rows:
        line, cells = [], iter(row)
        cell = next(cells, None)
        while cell is not None or len(line) in pending:
            at = len(line)
            if at in pending:
                text, left = pending.pop(at)
                if left > 1:
                    pending[at] = (text, left - 1)
                line.append(text)
                continue
            text, across, down = cell
            for _ in range(max(across, 1)):
                if down > 1:
                    pending[len(line)] = (text, down - 1)
                line.append(text)
            cell = next(cells, None)
        if line:
            grid.append(line)
    return grid


def first_table(html: str | None, table_class: str) -> list[dict[str, str]]:
    """Rows of the first table with the class, named by its first row's cells."""
    if not html:
        return []
    parser = _TableText(table_class)
    parser.feed(html)
    parser.close()
    header, *body = _grid(parser.rows) or [[]]
    # A name that comes again is numbered: Name, Name (2), Name (3).
    names = [f"{cell} ({header[:i + 1].count(cell)})" if cell in header[:i] else cell for i, cell in enumerate(header)]
    return [dict(zip(names, line)) for line in body]


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.nullif(F.col(name), F.lit(""))
    if isinstance(kind, T.NumericType):
        text = F.nullif(F.replace(text, F.lit(","), F.lit("")), F.lit("NaN"))
    return text.try_cast(kind).alias(name)


def extract_html_table(pages: DataFrame, html_col: str, table_class: str, schema: T.StructType,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per table row of every page, typed by ``schema`` (thousands separators dropped).

    Pages are parsed where they lie, and only those with a table tag in them; ``keep``
    carries page columns along.
    """
    pages = pages.filter(F.lower(F.col(html_col)).contains("<table"))
    names = [f.name for f in schema.fields]
    kept = [pages.schema[c] for c in keep]
    raw = T.StructType([*kept, *[T.StructField(n, T.StringType()) for n in names]])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                found += [(*row[:-1], *[cells.get(n) for n in names]) for cells in first_table(row[-1], table_class)]
                if len(found) >= ROWS_PER_FRAME:  # some small tables or one large one: never all tables of a batch
                    yield pd.DataFrame(found, columns=raw.names)
                    found = []
        if found:
            yield pd.DataFrame(found, columns=raw.names)

    cells = pages.select(*keep, html_col).mapInPandas(parse, raw)
    return cells.select(*keep, *[_typed(f.name, f.dataType) for f in schema.fields])
