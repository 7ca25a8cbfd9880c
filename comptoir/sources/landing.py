"""Arriving files: visible files that lie directly in the folder of a source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.schemas import EXTENSIONS
from comptoir.sources.files import direct_children

LISTED = "source string, fichier string, chemin string, taille bigint, modifie_le bigint"
BATCH_ROWS = 10_000
OPENING_BYTES = 4 * 1024 * 1024  # what opening a file costs, in bytes read meanwhile


def landing_files(spark: SparkSession, landing: str) -> DataFrame:
    """(source, fichier, chemin, taille, modifie_le) from the listing; no content is read.

    Deeper folders, folders of no source and names starting with a dot are left out. Spark's own
    listing would also leave out empty files and names starting with an underscore, so a task
    lists each source's folder.
    """

    def list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["source", "fichier", "chemin", "taille", "modifie_le"]
        for batch in batches:
            for source, folder in zip(batch["source"], batch["dossier"]):
                found = ((source, *entry) for entry in direct_children(folder) if not entry[0].startswith("."))
                for rows in batched(found, BATCH_ROWS):
                    yield pd.DataFrame(rows, columns=columns)

    folders = spark.createDataFrame(
        [(source, f"{landing.rstrip('/')}/{source}") for source in EXTENSIONS],
        "source string, dossier string")
    return folders.repartition(len(EXTENSIONS), "source").mapInPandas(list_folders, LISTED)


def spread(files: DataFrame, bytes_per_task: int = 256 * 1024 * 1024) -> DataFrame:
    """Files over tasks by the bytes they hold, since their listing says little of the work.

    The total comes from the listing. Left to itself a listing of a million files is one task.
    """
    work = files.agg(F.sum(F.col("taille") + OPENING_BYTES)).first()[0] or 0
    return files.repartition(max(1, math.ceil(work / bytes_per_task)))
