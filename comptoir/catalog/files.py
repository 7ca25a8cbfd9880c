"""Source files written from the test tables, in the formats the lake receives."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.schemas import INGEST_DATE, REQUIRED_FIELDS, SOURCE_FILE
from comptoir.sinks import run
from comptoir.sources.files import write_file

# The smallest set of parts a workbook consists of.
SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'
PARTS = {
    "[Content_Types].xml":
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels":
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
        'relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml":
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
        'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        '<sheets><sheet name="Feuille1" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels":
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
        'relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


#: Rows that a task turns into files, and of a lot, at most.
LOT_ROWS = 250_000


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows over as many tasks as they need: a table in one piece would be written by one task."""
    return rows.repartition(-(-count // LOT_ROWS)) if (count := rows.count()) > LOT_ROWS else rows


def workbook(rows: list[list]) -> bytes:
    """A workbook of one sheet: text cells as inline strings, numbers as numbers."""

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, (int, float)):
            return f"<c><v>{value}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'

    sheet = SHEET.format("".join(
        f'<row r="{i}">{"".join(map(cell, row))}</row>' for i, row in enumerate(rows, 1)))
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in {**PARTS, "xl/worksheets/sheet1.xml": sheet}.items():
            archive.writestr(name, text)
    return target.getvalue()


def as_workbooks(rows: DataFrame, source: str = "magasins") -> DataFrame:
    """(path, content): one workbook per batch of rows."""
    return _as_files(rows, source, "xlsx", _workbook_of)


def _workbook_of(table: pd.DataFrame) -> bytes:
    return workbook([list(table.columns), *table.values.tolist()])


def _json_array_of(table: pd.DataFrame) -> bytes:
    return json.dumps(table.to_dict("records"), ensure_ascii=False).encode()


def _as_files(rows: DataFrame, source: str, extension: str, encode) -> DataFrame:
    """One file per batch of rows, so that no task holds more than a batch."""
    fields = REQUIRED_FIELDS[source]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            table = batch.astype(object).where(batch.notna(), None)
            yield pd.DataFrame({"path": [f"{source}-{part:06d}-{number:06d}.{extension}"],
                                "content": [encode(table)]})

    return _dealt(rows.select(*fields)).mapInPandas(pack, "path string, content binary")


def _store_files(files: DataFrame, folder: str) -> None:
    """Write files from the tasks that hold them; a task run again writes the same names."""

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                write_file(f"{folder}/{name}", content)
            yield batch[["path"]]

    run(files.mapInPandas(store, "path string"))


def write_sales_csv(rows: DataFrame | Sequence[DataFrame], folder: str) -> None:
    """Rows given in pieces are written one piece after the other."""
    for number, piece in enumerate([rows] if isinstance(rows, DataFrame) else rows):
        (piece.select(*REQUIRED_FIELDS["ventes"]).write.mode("append" if number else "overwrite").option("header", True)
         .option("maxRecordsPerFile", LOT_ROWS)  # a lot whose records may go over several lines is read by one task
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder))


def write_json_arrays(rows: DataFrame, folder: str, source: str = "clients") -> None:
    _store_files(_as_files(rows, source, "json", _json_array_of), folder)


def write_lots(rows: DataFrame, folder: str, write) -> None:
    """Rows of the oldest lot into the folder itself, corrections below ``ingest_date=``."""
    corrected = F.col(SOURCE_FILE).contains("ingest_date=")
    write(rows.where(~corrected), f"{folder}/initial")
    write(rows.where(corrected), f"{folder}/ingest_date=2026-10-02")


def write_products_xml(rows: DataFrame, folder: str) -> None:
    (_dealt(rows).select(*REQUIRED_FIELDS["produits"]).write.mode("overwrite").format("xml")
     .option("rootTag", "produits").option("rowTag", "produit").save(folder))


def write_workbooks(rows: DataFrame, folder: str) -> None:
    _store_files(as_workbooks(rows), folder)


def without_origin(rows: DataFrame) -> DataFrame:
    return rows.drop(SOURCE_FILE, INGEST_DATE)
