"""Raw zone readers: every lot of a source, as text, with the file it came from."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir import schemas as S
from comptoir.operators.control import WIDEST
from comptoir.operators.joins import lookup
from comptoir.sinks import read_table
from comptoir.sources.files import open_input
from comptoir.sources.workbook import workbook_rows


#: Headers of so many lots are sent to the tasks that read rows; with more, both meet in a shuffle.
HEADERS_SENT = 50_000


def ingest_date(path: Column) -> Column:
    """Date in an ``ingest_date=`` folder; lots laid down by hand count as the oldest."""
    found = F.regexp_extract(path, r"ingest_date=(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(S.FIRST_INGEST_DATE))


def with_origin(rows: DataFrame, path: str = "_metadata.file_path") -> DataFrame:
    return rows.select(
        *[F.col(f"`{name}`") for name in rows.columns if name != path],
        F.col(path).alias(S.SOURCE_FILE),
        ingest_date(F.col(path)).alias(S.INGEST_DATE))


def clean_header(names: list[str]) -> list[str]:
    return [name.strip() for name in names]


def csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(file_path, header) of every CSV lot; the tasks read the first record only."""

    def first_record(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            headers = []
            for path in batch["path"]:
                with open_input(path) as stream:
                    lines = csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""))
                    headers.append(clean_header(next(lines, [])))
            yield batch[["file_path"]].assign(header=headers)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.[cC][sS][vV]").load(folder).select("path", "_metadata.file_path"))
    return files.mapInPandas(first_record, "file_path string, header array<string>")


def scan_by_position(spark: SparkSession, folder: str, columns: int, header: bool, breaks: bool) -> DataFrame:
    """The first columns of every CSV lot as `_c0`, `_c1`, …, and the file.

    Without ``breaks`` a lot is read by several tasks if it is large, and no record may go over several lines.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(columns)])
    return (spark.read.schema(schema).option("header", header).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.[cC][sS][vV]").option("multiLine", breaks).option("escape", '"')
            .csv(folder).select("*", "_metadata.file_path"))


def _required(place: Callable[[int], Column]) -> list[Column]:
    """The required columns, the i-th taken from where `place` has it."""
    return [place(i).alias(name) for i, name in enumerate(S.REQUIRED_FIELDS["ventes"])]


def _taken(places: Column, columns: int = WIDEST) -> list[Column]:
    cells = F.array(*(F.col(f"_c{i}") for i in range(columns)))
    return _required(lambda i: F.get(cells, F.get(places, F.lit(i))))


def read_filed_sales(spark: SparkSession, folder: str, breaks: bool = True) -> DataFrame:
    """All lots that the ingestion has filed, columns taken by name; no file is opened to learn its header.

    A lot in a folder ``disposition=…`` has its columns where the folder says; any other begins with the required columns in their order,
    and one that does not, laid down by hand, fails the scan. The two kinds are two scans, each of its own files.
    Say ``breaks=False`` if no lot has records over several lines: lots are then split over tasks.
    """
    required = S.REQUIRED_FIELDS["ventes"]
    other = F.col("file_path").contains("/disposition=")
    plain = scan_by_position(spark, folder, len(required), False, breaks).where(~other)
    cells = [F.trim(f"_c{i}") for i in range(len(required))]
    usual = reduce(and_, [F.coalesce(c == name, F.lit(False)) for c, name in zip(cells, required)])
    names = sum(F.when(c.isin(*required), 1).otherwise(0) for c in cells)
    foreign = F.raise_error(F.concat(F.lit("not filed by the ingestion, and its columns are in another order: "), "file_path"))
    rows = plain.where(F.when(usual, False).when(names * 2 >= len(required), foreign.isNull()).otherwise(True))
    placed = F.split(F.regexp_extract("file_path", "/disposition=([0-9-]+)/", 1), "-").cast("array<int>")
    elsewhere = scan_by_position(spark, folder, WIDEST, True, breaks).where(other)
    return with_origin(rows.select(*_required(lambda i: F.col(f"_c{i}")), "file_path").unionByName(
        elsewhere.select(*_taken(placed), "file_path")), "file_path")


def read_sales(spark: SparkSession, folder: str, by_name: bool = True) -> DataFrame:
    """All CSV lots of a folder, also those laid down by hand, columns taken by name.

    Spark binds the columns of several CSV files by position. Each lot's header is therefore read by a task and met with its
    rows in a join by file; the driver learns how many lots there are, and how far their required columns reach: cells beyond are
    not parsed. The headers of not too many lots are sent to the rows. A required column that a lot lacks is null.

    Without ``by_name`` no task opens a file by itself: every lot must have the required columns
    in their order, and one that has not fails the scan.
    """
    required = S.REQUIRED_FIELDS["ventes"]
    if not by_name:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in required])
        return with_origin(
            spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]")
            .option("multiLine", True).option("escape", '"').csv(folder).select("*", "_metadata.file_path"), "file_path")
    places = F.array(*(F.nullif(F.array_position("header", name) - 1, F.lit(-1)).cast("int") for name in required))
    headers = csv_headers(spark, folder).where(F.size("header") > 0).select("file_path", places.alias("places"))
    lots, last = headers.agg(F.count(F.lit(1)), F.max(F.array_max("places"))).first()
    columns = min(WIDEST, 1 + (last or 0))
    rows = scan_by_position(spark, folder, columns, True, True)
    met = rows.join(F.broadcast(headers), "file_path") if lots <= HEADERS_SENT else lookup(rows, headers, "file_path", "inner")
    return with_origin(met.select(*_taken(F.col("places"), columns), "file_path"), "file_path")


def read_customers(spark: SparkSession, folder: str) -> DataFrame:
    return with_origin(
        spark.read.schema(S.text_schema("clients")).option("multiLine", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][sS][oO][nN]").json(folder))


def read_products(spark: SparkSession, folder: str) -> DataFrame:
    return with_origin(
        spark.read.format("xml").schema(S.text_schema("produits")).option("rowTag", "produit")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[xX][mM][lL]").load(folder))


def read_stores(spark: SparkSession, folder: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.[xX][lL][sS][xX]").load(folder))
    return with_origin(workbook_rows(files), "path")


READERS = {
    "ventes": read_filed_sales,
    "clients": read_customers,
    "produits": read_products,
    "magasins": read_stores,
}


def read_raw(spark: SparkSession, raw: str, breaks: bool = True) -> dict[str, DataFrame]:
    """The four sources by name, each from its folder of the raw zone. `breaks`: see `read_filed_sales`."""
    own = {"ventes": {"breaks": breaks}}
    return {source: reader(spark, f"{raw}/{source}", **own.get(source, {})) for source, reader in READERS.items()}


__all__ = ["read_customers", "read_filed_sales", "read_products", "read_raw", "read_sales", "read_stores", "read_table"]
