"""First sheet of .xlsx files as text rows, one task per file.

An .xlsx file is a zip of XML parts; the standard library reads both. The sheet is parsed as a
stream, so memory holds the shared strings and one batch of rows.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from comptoir.schemas import REQUIRED_FIELDS

# Cell texts that count as no value.
NO_VALUE = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
}

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
OFFICE = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
BATCH_ROWS = 10_000


def _text_of(node) -> str:
    """Text of a string item, without phonetic hints."""
    return "".join(t.text or "" for part in node for t in (
        [part] if part.tag == MAIN + "t" else part.findall(MAIN + "t") if part.tag == MAIN + "r" else []))


def _sheet_part(archive: zipfile.ZipFile, active: bool) -> str:
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    view = book.find(f"{MAIN}bookViews/{MAIN}workbookView")
    index = int(view.get("activeTab", 0)) if active and view is not None else 0
    relation = book.findall(f"{MAIN}sheets/{MAIN}sheet")[index].get(OFFICE + "id")
    for entry in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels")):
        if entry.get("Id") == relation:
            return posixpath.normpath(posixpath.join("/xl", entry.get("Target"))).lstrip("/")
    raise KeyError(relation)


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    with archive.open("xl/sharedStrings.xml") as part:
        texts = []
        for _, node in ElementTree.iterparse(part):
            if node.tag == MAIN + "si":
                texts.append(_text_of(node))
                node.clear()
        return texts


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _cell(node, shared: list[str]) -> str | None:
    kind = node.get("t", "n")
    if kind == "inlineStr":
        holder = node.find(MAIN + "is")
        return None if holder is None else _text_of(holder)
    value = node.findtext(MAIN + "v")
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "n":
        number = float(value)
        return str(int(number)) if number.is_integer() else str(number)
    return value


def sheet_rows(stream, active: bool = False) -> Iterator[list[str | None]]:
    """Rows of the first (or the active) sheet; rows the file leaves out come as empty rows."""
    with zipfile.ZipFile(stream) as archive:
        shared = _shared_strings(archive)
        expected = 1
        with archive.open(_sheet_part(archive, active)) as part:
            for _, node in ElementTree.iterparse(part):
                if node.tag != MAIN + "row":
                    continue
                number = int(node.get("r", expected))
                for _ in range(expected, number):
                    yield []
                cells: list[str | None] = []
                for cell in node.findall(MAIN + "c"):
                    place = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (place + 1 - len(cells)))
                    cells[place] = _cell(cell, shared)
                yield cells
                expected = number + 1
                node.clear()


def _records(content: bytes, fields: list[str]) -> Iterator[list[str | None]]:
    rows = sheet_rows(io.BytesIO(content))
    header = next(rows, [])
    places = [header.index(f) if f in header else None for f in fields]
    empty_rows = 0
    for cells in rows:
        record = [cells[p] if p is not None and p < len(cells) else None for p in places]
        if not any(cell not in (None, "") for cell in cells):
            empty_rows += 1  # kept only if a filled row follows
            continue
        for _ in range(empty_rows):
            yield [None] * len(fields)
        empty_rows = 0
        yield [None if value in NO_VALUE else value for value in record]


def workbook_rows(files: DataFrame, source: str = "magasins") -> DataFrame:
    """Rows of workbooks given as (path, content): the source's columns as text, and the path."""
    fields = REQUIRED_FIELDS[source]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for record in _records(content, fields):
                    rows.append(record + [path])
                    if len(rows) == BATCH_ROWS:
                        yield pd.DataFrame(rows, columns=[*fields, "path"], dtype=object)
                        rows = []
                yield pd.DataFrame(rows, columns=[*fields, "path"], dtype=object)

    schema = ", ".join(f"{name} string" for name in [*fields, "path"])
    return files.select("path", "content").mapInPandas(parse, schema)
