"""Control of arriving files: extension, readable structure, required fields, data rows.

A file has to be read front to back to be fingerprinted and parsed, so the unit of work is one
file and Spark spreads the files over the tasks. A task opens the files it is given: contents
are in no row and cross no shuffle. Files of every size take the same way: CSV, XML and XLSX are
read as streams, a JSON lot as the one text that its reader takes it for, item by item.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import json
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.schemas import EXTENSIONS, REQUIRED_FIELDS
from comptoir.sources.files import CHUNK, open_input
from comptoir.sources.workbook import sheet_rows

# Reasons as they are written to the journal.
EMPTY_FILE = "fichier vide"
JSON_SHAPE = "JSON inattendu : une liste d'objets est attendue"
XML_SHAPE = "XML sans enregistrement"
NO_HEADER = "aucune ligne d'en-tête"
NO_EXTENSION = "(aucune)"
NO_ROWS = "aucune ligne de données"
BAD_EXTENSION = "extension %s inattendue pour %s (attendu : %s)"
UNREADABLE = "fichier corrompu ou format illisible ({}: {})"
FIELDS_MISSING = "champs obligatoires absents : "
ERROR_CHARACTERS = 80

FINDINGS = "sha256 string, champs array<string>, lignes bigint, defaut string, disposition string, coupures boolean"
#: A reader takes the columns it needs from so many first columns of a lot.
WIDEST = 256


class Unsuitable(Exception):
    """The content is not what the source delivers; says why."""


class Held(io.BytesIO):
    """A file whose content came with its row: it is in memory as a whole."""


def _lines(stream) -> Iterator[str]:
    """Lines of a UTF-8 file. A content at hand is decoded at once; one that cannot be, by the way that tells the place."""
    if isinstance(stream, Held):
        try:
            return io.StringIO(stream.getvalue().decode("utf-8-sig"))
        except UnicodeDecodeError:
            pass
    return _decoded_lines(stream)


def _decoded_lines(stream) -> Iterator[str]:
    """Lines of a UTF-8 file read in pieces; an undecodable byte is reported with its place in the file."""
    decoder, rest, at = codecs.getincrementaldecoder("utf-8-sig")(), "", 0
    while True:
        piece = stream.read(CHUNK)
        try:
            text = rest + decoder.decode(piece, final=not piece)
        except UnicodeDecodeError as error:
            place = at + len(piece) - len(error.object) + error.start
            what = f"'utf-8' codec can't decode byte 0x{error.object[error.start]:02x} in position {place}: {error.reason}"
            raise Unsuitable(UNREADABLE.format(type(error).__name__, what[:ERROR_CHARACTERS])) from None
        at += len(piece)
        *lines, rest = text.split("\n")
        for line in lines:
            yield line + "\n"
        if not piece:
            break
    if rest:
        yield rest


def _header(rows: Iterator) -> list:
    """First row."""
    for row in rows:
        return row
    raise Unsuitable(NO_HEADER)


def _inspect_csv(stream) -> tuple[list, int, bool]:
    """Names in order, records, and whether one of these goes over several lines."""
    records = csv.reader(_lines(stream))
    header = _header(records)
    rows = sum(1 for _ in records)
    return [name.strip() for name in header], rows, records.line_num > rows + 1


def layout(names: list[str]) -> str | None:
    """Where a sales lot has the required columns, '1-0-2-…'; null if it begins with them in their order."""
    required = REQUIRED_FIELDS["ventes"]
    if names[:len(required)] == required or not set(required) <= set(names):
        return None
    places = [names.index(name) for name in required]
    if max(places) >= WIDEST:
        raise Unsuitable(UNREADABLE.format("TooManyColumns", f"a required column after the {WIDEST}th"))
    return "-".join(map(str, places))


_SPACE = re.compile(r"[ \t\n\r]*")


def _items(text: str) -> Iterator:
    """Items of a JSON list, one at a time; ValueError if the text is no sound list."""
    decode, space, at = json.JSONDecoder().raw_decode, _SPACE.match, _SPACE.match(text).end()
    if text[at:at + 1] != "[":
        raise ValueError
    at = space(text, at + 1).end()
    while True:
        item, at = decode(text, at)
        yield item
        at = space(text, at).end()
        if text[at:at + 1] != ",":
            break
        at = space(text, at + 1).end()
    if text[at:at + 1] != "]" or space(text, at + 1).end() != len(text):
        raise ValueError


def _inspect_json(stream) -> tuple[set, int]:
    """A lot is read as one document by its reader: one item that is no object would empty it. Here its items are not held.

    A text that is no sound list, an empty one too, is loaded whole: what is wrong with it is told as ever.
    """
    text, fields, count, objects = io.TextIOWrapper(stream, "utf-8-sig").read(), set(), 0, True
    try:
        for item in _items(text):
            count += 1
            objects = objects and isinstance(item, dict)
            if objects:
                fields.update(item)
    except ValueError:
        items = json.loads(text)
        objects = isinstance(items, list) and bool(items) and all(isinstance(item, dict) for item in items)
        if objects:
            fields, count = set().union(*items), len(items)
    if not objects:
        raise Unsuitable(JSON_SHAPE)
    return fields, count


def _inspect_xml(stream) -> tuple[set, int]:
    fields, count, depth, root = set(), 0, 0, None
    for event, node in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            root = node if root is None else root
            depth += 1
            continue
        depth -= 1
        if depth == 1:
            if count == 0:
                fields = {child.tag for child in node}
            count += 1
            root.clear()  # records seen need not stay in memory
    if count == 0:
        raise Unsuitable(XML_SHAPE)
    return fields, count


def _inspect_xlsx(stream) -> tuple[set, int]:
    rows = sheet_rows(stream, active=True)
    header = _header(rows)
    return {cell.strip() for cell in header if cell is not None}, sum(1 for _ in rows)


INSPECTORS = {
    ".csv": _inspect_csv,
    ".json": _inspect_json,
    ".xml": _inspect_xml,
    ".xlsx": _inspect_xlsx,
}


def _inspect(stream, extension: str) -> tuple[list[str] | None, int | None, str | None, str | None, bool | None]:
    """(fields, data rows, defect, layout, records over several lines) of one opened file."""
    solid = False
    while not solid and (piece := stream.read(CHUNK)):
        solid = bool(piece.strip())
    if not solid:
        return None, None, EMPTY_FILE, None, None
    stream.seek(0)
    try:
        fields, rows, *breaks = INSPECTORS[extension](stream)
        return sorted(set(fields)), rows, None, *((layout(fields), *breaks) if breaks else (None, None))
    except Unsuitable as reason:
        return None, None, str(reason), None, None
    except Exception as error:  # whatever the parser of a damaged file raises
        return None, None, UNREADABLE.format(type(error).__name__, str(error)[:ERROR_CHARACTERS]), None, None


def _examine(path: str, extension: str | None, content: bytes | None) -> tuple:
    """(fingerprint, fields, data rows, defect, layout, breaks); a file with a foreign extension is not parsed."""
    with open_input(path) if content is None else Held(content) as stream:
        digest = (hashlib.file_digest(stream, "sha256") if content is None else hashlib.sha256(content)).hexdigest()
        if not extension:
            return digest, None, None, None, None, None
        stream.seek(0)
        return digest, *_inspect(stream, extension)


def suffix(name: Column) -> Column:
    """'.csv' of 'a.csv'; empty without one, also for a name that is only a suffix."""
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def accepted_extensions(source: Column) -> Column:
    """Extensions a source delivers, as configured; null for a folder that is no source."""
    return F.create_map(*[part for name, extensions in EXTENSIONS.items()
                          for part in (F.lit(name), F.array(*map(F.lit, extensions)))])[source]


def required_fields(source: Column) -> Column:
    return F.create_map(*[part for name, fields in REQUIRED_FIELDS.items()
                          for part in (F.lit(name), F.array(*map(F.lit, fields)))])[source]


def inspect_files(files: DataFrame) -> DataFrame:
    """Fingerprint, fields, data rows and defect of every file.

    ``files`` holds source, fichier, chemin and taille. A column ``content`` takes the place of
    opening ``chemin`` and is left behind.
    """
    extension = F.lower(suffix(F.col("fichier")))
    readable = F.array_contains(accepted_extensions(F.col("source")), extension)
    kept = [field for field in files.schema if field.name != "content"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], FINDINGS])

    names = [field.name for field in kept]

    def inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_types = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        found_names = ["sha256", "champs", "lignes", "defaut", "disposition", "coupures"]
        for batch in batches:
            contents = batch["content"].to_pylist() if "content" in batch.schema.names else [None] * len(batch)
            found = [_examine(*file) for file in zip(batch["chemin"].to_pylist(), batch["extension"].to_pylist(), contents)]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(found_types)]
            yield pa.RecordBatch.from_arrays([*(batch[name] for name in names), *columns], names=[*names, *found_names])

    return (files.withColumn("extension", F.when(readable, extension))
            .mapInArrow(inspect, schema))


def control_reason(inspected: DataFrame) -> Column:
    """Why a file is refused, null if it is not. The first reason that applies is the one given."""
    source, name = F.col("source"), F.col("fichier")
    expected = accepted_extensions(source)
    shown = F.coalesce(F.nullif(suffix(name), F.lit("")), F.lit(NO_EXTENSION))
    absent = F.array_sort(F.array_except(required_fields(source), F.col("champs")))
    return (F.when(~F.array_contains(expected, F.lower(suffix(name))),
                   F.format_string(BAD_EXTENSION, shown, source, F.array_join(expected, ", ")))
            .when(F.col("defaut").isNotNull(), F.col("defaut"))
            .when(F.size(absent) > 0, F.concat(F.lit(FIELDS_MISSING), F.array_join(absent, ", ")))
            .when(F.col("lignes") <= 0, F.lit(NO_ROWS)))


def control_files(files: DataFrame) -> DataFrame:
    """One row per file with ``sha256``, ``lignes`` and the ``motif`` of a refusal.

    Of a sales lot also the ``disposition`` of its columns, null for the usual one, and whether records go over
    several lines (``coupures``).
    """
    inspected = inspect_files(files)
    return inspected.withColumn("motif", control_reason(inspected)).drop("champs", "defaut")
