"""What lies in the lake: listings only, file contents are never read."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import batched

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.session import work_folder
from comptoir.sinks import write_new
from comptoir.sources.files import tree

BATCH_ROWS = 10_000

# Fixed value: the source of objects that lie directly in a zone.
ROOT_SOURCE = "(racine)"


def list_objects(spark: SparkSession, lake: str, levels: int = 1) -> DataFrame:
    """(cle, taille, modifie_le) of every object under the lake, keys relative to it.

    Empty objects and names with an underscore count too, which Spark's own listing leaves out. The first
    `levels` are listed level by level, the folders of a level dealt evenly over tasks, and then each folder that is left with all
    below it by one task: with enough levels a zone with nearly all objects is listed by many.
    """
    schema = "cle string, taille bigint, modifie_le bigint"

    def listed(batches: Iterator[pd.DataFrame], depth: int | None) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for prefix in batch["cle"]:
                found = ((f"{prefix}{key}", size, at) for key, size, at in tree(f"{lake.rstrip('/')}/{prefix}", depth))
                for rows in batched(found, BATCH_ROWS):
                    yield pd.DataFrame(rows, columns=["cle", "taille", "modifie_le"]).astype({"taille": "Int64"})

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders, files = spark.createDataFrame([("",)], "cle string"), []
    for level in range(levels):
        found = folders.mapInPandas(lambda b: listed(b, 1), schema)
        if levels > 1:  # each level is listed once
            path = f"{work_folder(spark)}/niveau={level}"
            write_new(found, path)
            found = spark.read.schema(schema).parquet(path)
        files.append(found.where("taille is not null"))
        folders = found.where("taille is null").select(F.concat("cle", F.lit("/")).alias("cle"))
        folders = folders.repartition(tasks) if levels > 1 else folders.repartition("cle")
    files.append(folders.mapInPandas(lambda b: listed(b, None), schema))
    return reduce(DataFrame.unionByName, files).withColumn("modifie_le", F.timestamp_micros("modifie_le"))


def list_folders(spark: SparkSession, path: str) -> DataFrame:
    """(cle) of the folders that lie directly in a folder."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["chemin"]:
                for rows in batched((key for key, size, _ in tree(folder, 1) if size is None), BATCH_ROWS):
                    yield pd.DataFrame({"cle": rows})

    return spark.createDataFrame([(path,)], "chemin string").mapInPandas(listed, "cle string")


def zone_and_source(key: Column) -> tuple[Column, Column]:
    parts = F.split(key, "/")
    return parts[0], F.when(F.size(parts) > 2, parts[1]).otherwise(ROOT_SOURCE)


def lake_inventory(objects: DataFrame) -> DataFrame:
    """Objects and bytes per zone and source."""
    zone, source = zone_and_source(F.col("cle"))
    return (objects.groupBy(zone.alias("zone"), source.alias("source"))
            .agg(F.count(F.lit(1)).alias("objets"), F.sum("taille").alias("octets"))
            .orderBy("zone", "source"))


def text_preview(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First lines of one text file."""
    return spark.read.text(path).limit(n)


def data_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per text file its lines without the header; large files are counted in parts."""
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .groupBy(F.col("_metadata.file_path").alias("fichier"))
            .agg((F.count(F.lit(1)) - 1).alias("lignes")))
