"""Excel workbooks: Spark reads the files, tasks take the sheets apart, all cells are strings."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html import escape
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.operators.validate import CORRUPT

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letters(number: int) -> str:
    letters = ""
    while number >= 0:
        letters, number = chr(65 + number % 26) + letters, number // 26 - 1
    return letters


def _elements(book: zipfile.ZipFile, name: str, tag: str) -> Iterator[ElementTree.Element]:
    """The elements of a part one after another, each forgotten when the next one comes."""
    with book.open(name) as part:
        parents: list[ElementTree.Element] = []
        for event, e in ElementTree.iterparse(part, ("start", "end")):
            if event == "start":
                parents.append(e)
                continue
            parents.pop()
            if e.tag == tag:
                yield e
                if parents:
                    parents[-1].remove(e)


def _sheet_rows(data: bytes, sheet: str | None, area: str | None) -> Iterator[list[str | None]]:
    """The rows of an area of a sheet. A row or cell without its address stands right after the one before it."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in _elements(book, "xl/sharedStrings.xml", f"{_MAIN}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = {s.get("name"): targets[s.get(f"{_REL}id")] for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
        target = sheets[sheet] if sheet else next(iter(sheets.values()))
        first, last, top, bottom = 0, None, 1, None
        if area and (m := re.fullmatch(r"([A-Z]+)(\d+)(?::([A-Z]+)(\d+))?", area)):
            first, top = column_number(m[1]), int(m[2])
            last, bottom = (column_number(m[3]), int(m[4])) if m[3] else (None, None)
        number = 0
        for row in _elements(book, f"xl/{target.lstrip('/').removeprefix('xl/')}", f"{_MAIN}row"):
            number = int(row.get("r") or number + 1)
            if bottom is not None and number > bottom:
                break
            if number < top:
                continue
            cells: dict[int, str | None] = {}
            at = -1
            for c in row.iter(f"{_MAIN}c"):
                at = column_number(re.match("[A-Z]+", c.get("r"))[0]) if c.get("r") else at + 1
                value, inline = c.find(f"{_MAIN}v"), c.find(f"{_MAIN}is")
                text = "".join(t.text or "" for t in inline.iter(f"{_MAIN}t")) if inline is not None else value.text if value is not None else None
                cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text
            end = last if last is not None else max(cells, default=first - 1)
            yield [cells.get(i) for i in range(first, end + 1)]


def workbook_rows(books: DataFrame, content: str, schema: StructType, sheet: str | None = None, area: str | None = None, header_mode: str = "first_line") -> DataFrame:
    """The rows of a sheet of every workbook in the binary column ``content``, under the names of ``schema``, as strings; null workbooks have none.

    A ``_corrupt_record`` in the schema takes the cells of rows that are wider than the other columns; without it further cells are dropped."""
    names, skip = [n for n in schema.names if n != CORRUPT], header_mode != "without_header"
    keeps = CORRUPT in schema.names

    def rows(data: bytes) -> Iterator[tuple]:
        for i, row in enumerate(_sheet_rows(data, sheet, area)):
            if i or not skip:
                text = ",".join(v or "" for v in row) if len(row) > len(names) else None
                yield (*(row + [None] * len(names))[: len(names)], *([text] if keeps else []))

    def take(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame[content].dropna():
                found = rows(data)
                while part := list(islice(found, 10_000)):
                    yield pd.DataFrame(part, columns=[*names, *([CORRUPT] if keeps else [])], dtype=object)

    fields = StructType([StructField(n, StringType()) for n in [*names, *([CORRUPT] if keeps else [])]])
    return books.select(content).mapInPandas(take, fields)


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None, area: str | None = None, header_mode: str = "first_line", schema: StructType | None = None) -> DataFrame:
    """A sheet of every workbook of a path, a folder or a glob on any file system that Spark reads. ``area`` is "A2:D9" or "B3"; the header mode first_line, without_header or ignore_header.
    Without a schema the first row of one workbook tells the names (first_line) or the number of columns."""
    books = spark.read.format("binaryFile").load(path).select("content")
    if schema is None:
        def first_row(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for data in frame["content"]:
                    yield pd.DataFrame({"head": [next(_sheet_rows(data, sheet, area), [])]})

        row = books.limit(1).mapInPandas(first_row, "head array<string>").first()
        head = row["head"] if row else []
        schema = StructType([StructField(v if header_mode == "first_line" and v else f"_c{i}", StringType()) for i, v in enumerate(head)])
    return workbook_rows(books, "content", schema, sheet, area, header_mode)


def workbook(rows: pd.DataFrame) -> bytes:
    """A workbook with the sheets Notes (empty) and Data, whose header stands in row 2 from column B on."""
    lines = [[*rows.columns], *rows.itertuples(index=False)]
    cells = ("".join(f'<c r="{letter}{i}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' for letter, v in zip(map(column_letters, range(1, len(line) + 1)), line, strict=True)) for i, line in enumerate(lines, 2))
    data = "".join(f'<row r="{i}">{c}</row>' for i, c in enumerate(cells, 2))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets><sheet name="Notes" sheetId="1" r:id="r1"/><sheet name="Data" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>{data}</sheetData></worksheet>')
    return out.getvalue()
