"""Sheets of .xlsx workbooks, each workbook parsed once, by one task."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.session import scratch_path

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH = 5000


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _texts(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


class Book:
    """The sheets of one workbook and the strings they share."""

    def __init__(self, content: bytes):
        self._zip = zipfile.ZipFile(io.BytesIO(content))
        links = ElementTree.fromstring(self._zip.read("xl/_rels/workbook.xml.rels"))
        targets = {link.get("Id"): link.get("Target") for link in links}
        sheets = ElementTree.fromstring(self._zip.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        self._parts = {s.get("name"): targets[s.get(_REL)].lstrip("/") for s in sheets}
        self._shared: list[str] = []
        if "xl/sharedStrings.xml" in self._zip.namelist():
            strings = ElementTree.fromstring(self._zip.read("xl/sharedStrings.xml"))
            self._shared = [_texts(item) for item in strings.iter(f"{_MAIN}si")]

    def rows(self, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
        """(row number, cell texts) of one sheet, parsed as a stream.

        Rows and cells may name their places; one that does not follows the
        one before it.
        """
        if sheet not in self._parts:
            raise ValueError(f"no sheet {sheet!r}; there are {sorted(self._parts)}")
        target = self._parts[sheet]
        number = 0
        with self._zip.open(target if target.startswith("xl/") else f"xl/{target}") as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r") or number + 1)
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    named = cell.get("r")
                    at = _column_index(named) if named else len(cells)
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = self._text(cell)
                yield number, cells
                row.clear()

    def _text(self, cell: ElementTree.Element) -> str | None:
        value = cell.find(f"{_MAIN}v")
        if cell.get("t") == "inlineStr":
            return _texts(cell)
        if value is None:
            return None
        return self._shared[int(value.text)] if cell.get("t") == "s" else value.text


def _names(cells: Sequence[str | None]) -> list[str]:
    """A name for each cell of a header up to the last that has one."""
    width = max((i + 1 for i, h in enumerate(cells) if h), default=0)
    return [cells[i] or f"column_{i + 1}" for i in range(width)]


def read_sheets(spark: SparkSession, path: str, sheets: Sequence[str]) -> dict[str, DataFrame]:
    """Sheets of every workbook under ``path``, all columns as text.

    The first row of a sheet is its header and goes with the rows of its own
    workbook: columns are matched by name, in whatever order a workbook has
    them. Other names than in the first workbook raise, so do repeated ones.
    Cells to the right of the header are in ``column_n``.

    Workbooks are spread over tasks, a workbook itself is not splittable. Each
    is parsed once; its rows are stored under the shared folder. Only headers
    come to the driver, two different ones at most.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "sheet", "row", "header", "cells"]
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                book, rows = Book(content), []
                for sheet in sheets:
                    header: list[str] = []
                    for number, cells in book.rows(sheet):
                        if number == 1:
                            header, cells = _names(cells), []
                        rows.append((name, sheet, number, header, cells))
                        if len(rows) == _BATCH:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                yield pd.DataFrame(rows, columns=columns)

    books = spark.read.format("binaryFile").load(path).select("path", "content")
    kind = "path string, sheet string, `row` long, header array<string>, cells array<string>"
    place = scratch_path(spark, "sheets")
    books.mapInPandas(parse, kind).write.partitionBy("sheet").parquet(place)
    stored = spark.read.schema(kind).parquet(place)
    return {sheet: _sheet(stored.filter(F.col("sheet") == sheet), sheet) for sheet in sheets}


def _sheet(rows: DataFrame, sheet: str) -> DataFrame:
    sizes = rows.agg(F.max(F.size("cells")), F.max(F.size("header"))).head()
    first = rows.filter("row = 1").orderBy("path").select("header").head()
    if first is None or not first.header:
        raise ValueError(f"sheet {sheet!r} has no header row")
    names = list(first.header)
    same = F.array_sort("header") == F.array_sort(F.lit(names))
    other = rows.filter(~same | (F.size(F.array_distinct("header")) < F.size("header"))).select("path", "header").head()
    if other:
        raise ValueError(f"sheet {sheet!r} has the columns {names}, but in {other.path} {list(other.header)}")
    wide = range(len(names), max(sizes[0] or 0, len(names)))
    return rows.filter("row > 1").select(
        *[F.get("cells", (F.array_position("header", n) - 1).cast("int")).alias(n) for n in names],
        *[F.get("cells", F.lit(i)).alias(f"column_{i + 1}") for i in wide],
    )


def read_sheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """One sheet of every workbook under ``path``: see ``read_sheets``."""
    return read_sheets(spark, path, [sheet])[sheet]
