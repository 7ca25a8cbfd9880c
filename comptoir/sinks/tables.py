"""Writes that can be repeated: the second run leaves what the first one did."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.operators.joins import lookup
from comptoir.session import exists, qualified, remove
from comptoir.sources.files import open_input, tree, write_file

#: Folder of a table's versions, and the file that names the one that counts.
VERSIONS, POINTER = "_versions", "_courante"
#: Buckets of a keyed table.
BUCKETS = 64


def write_new(rows: DataFrame, path: str) -> None:
    """A table that only this run writes; after a lost attempt it is written again.

    Fingerprints and paths are much of such tables; this codec halves what the usual one leaves of them.
    """
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def replace_table(rows: DataFrame | Sequence[DataFrame], path: str, files: int | None = None,
                  partition_by: str | None = None) -> None:
    """Replace a Parquet table. ``files`` is for small results only: it narrows the last stage.

    Rows given in pieces are written one piece after the other, so that the shuffles of one lie on the disks at once.

    The rows become a version of their own, and the pointer to it is switched last: until then, and if the job is lost, readers
    have the old table (`read_table`). The version before stays for readers that have begun; older ones go.
    """
    pieces = [rows] if isinstance(rows, DataFrame) else rows
    spark = pieces[0].sparkSession
    path = qualified(spark, path)
    before, version = _current(spark, path), uuid.uuid4().hex
    for piece in pieces:
        if files is not None:
            piece = piece.coalesce(files)
        writer = piece.write.mode("append").option("compression", "zstd")
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{path}/{VERSIONS}/{version}")
    write_file(f"{path}/{POINTER}", version.encode())
    for old, size, _ in tree(f"{path}/{VERSIONS}", 1):
        if size is None and old not in (version, before):
            remove(spark, f"{path}/{VERSIONS}/{old}")


def _current(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, f"{path}/{POINTER}"):
        return None
    with open_input(f"{path}/{POINTER}") as pointer:
        return pointer.read().decode()


def _folder(spark: SparkSession, path: str) -> str:
    path = qualified(spark, path)
    version = _current(spark, path)
    return path if version is None else f"{path}/{VERSIONS}/{version}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table, or the files of a folder that has no versions."""
    return spark.read.parquet(_folder(spark, path))


def read_pieces(spark: SparkSession, path: str, most: int) -> list[DataFrame]:
    """A table without partitions in pieces of whole files, of about `most` bytes each; every file is in one of them."""
    folder = _folder(spark, path)
    files = sorted((size, key) for key, size, _ in tree(folder) if not any(name.startswith("_") for name in key.split("/")))
    pieces = min(-(-sum(size for size, _ in files) // most), len(files))
    if pieces < 2:
        return [spark.read.parquet(folder)]
    dealt = [files[first::pieces] for first in range(pieces)]  # by size, so that all weigh about the same
    return [spark.read.parquet(*(f"{folder}/{key}" for _, key in piece)) for piece in dealt]


def replace_partition(rows: DataFrame, path: str, column: str, file_format: str = "parquet") -> None:
    """Replace only the partitions that the rows belong to, and leave the others."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).format(file_format).save(path))


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _generations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, seau int, generation bigint").parquet(path)


def read_keyed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A keyed table: of each bucket its last generation; empty before the first write."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = _generations(spark, path, schema)
    last = rows.groupBy("seau").agg(F.max("generation").alias("derniere"))
    return lookup(rows, last, "seau", "inner").where("generation = derniere").drop("seau", "generation", "derniere")


def upsert(changed: DataFrame, path: str, key: str, schema: str) -> None:
    """Rows take the place of those with their key, or are added; one row per key.

    Only buckets that hold a changed key are written, each as a new generation, so what is written follows the changed keys. The
    generation before stays until the next one. Written again, the same rows change nothing.
    """
    spark = changed.sparkSession
    placed = changed.withColumn("seau", _bucket(key))
    touched = [r[0] for r in placed.select("seau").distinct().collect()]  # BUCKETS at most
    if not touched:
        return
    rows, generation = placed, 0
    if exists(spark, path):
        held = _generations(spark, path, schema).where(F.col("seau").isin(touched))
        last = held.groupBy("seau").agg(F.max("generation").alias("derniere"))
        generation = (last.agg(F.max("derniere")).first()[0] or 0) + 1
        mine = held.join(last, "seau").where("generation = derniere").drop("generation", "derniere")
        new = placed.select(F.col(key).alias("_cle"))
        kept = mine.join(new, mine[key].eqNullSafe(new["_cle"]), "left_anti")
        rows = kept.unionByName(placed)
    (rows.withColumn("generation", F.lit(generation).cast("bigint")).repartition("seau").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("seau", "generation").parquet(path))
    here = qualified(spark, path)
    for bucket in touched:
        found = sorted(int(name.removeprefix("generation=")) for name, size, _ in tree(f"{here}/seau={bucket}", 1) if size is None)
        for old in found[:-2]:
            remove(spark, f"{here}/seau={bucket}/generation={old}")


def run(rows: DataFrame) -> None:
    """Run a job for what its tasks write; the rows themselves are not kept."""
    rows.write.format("noop").mode("overwrite").save()
