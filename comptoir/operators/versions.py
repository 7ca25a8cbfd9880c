"""One row per identifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comptoir.functions import identifier
from comptoir.schemas import INGEST_DATE, SOURCE_FILE


def latest_version(rows: DataFrame, key: str, ties: Sequence[str] | None = None) -> DataFrame:
    """Keep the whole row of the most recently ingested lot for every identifier.

    Identifiers are compared without case and surrounding spaces, and rows without one form a
    single group. Inside one file the columns `ties` decide, the greatest value first, by default all that remain, so that a
    re-run task picks the same row. Name only what tells rows apart (nothing, if no file has two rows of an
    identifier): columns that neither decide nor are used later are not read. The rank filter becomes a group limit in front of the shuffle: however many
    versions a hot identifier has, each task sends one row of it.
    """
    recency = [INGEST_DATE, SOURCE_FILE]
    tie_breakers = [name for name in (rows.columns if ties is None else ties) if name not in recency]
    newest_first = Window.partitionBy(identifier(key)).orderBy(
        *[F.col(name).desc_nulls_last() for name in recency + tie_breakers])
    return (rows.select("*", F.row_number().over(newest_first).alias("_version"))
            .where(F.col("_version") == 1)
            .drop("_version"))


def parts_by_key(rows: DataFrame, key: str, parts: int) -> list[DataFrame]:
    """The rows in parts, each with all rows of its identifiers, so that a part can be versioned by itself.

    Every part scans the rows again, but only its own are shuffled: written one after the other, the parts need the disk of one shuffle
    of theirs, not of all rows.
    """
    if parts < 2:
        return [rows]
    place = F.pmod(F.xxhash64(identifier(key)), F.lit(parts))
    return [rows.where(place == part) for part in range(parts)]


def drop_duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keep any one row per key as it is written: ' V1' and 'V1' are two keys."""
    return rows.dropDuplicates([key])
