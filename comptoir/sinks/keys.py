"""Keys that runs have used, kept so that a run looks up its own and reads no history.

One Parquet table per lake, partitioned by kind of key and by a prefix of the key's hash, and bucketed by the key. A lookup
scans only the partitions whose prefixes it asks for, and a join on the key shuffles only what is asked for:
the table lies as the join wants it. Each row names its run; rows of a run that was lost are never seen.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.session import exists

#: Kinds of keys: fingerprints of contents, arrived files as they were, names used when filing.
CONTENT, FILE, FILED = "contenu", "arrivee", "rangement"
PREFIX, BUCKETS = 2, 8
COLUMNS = ["cle", "fichier", "source", "destination", "taille", "lignes", "date", "lot", "genre", "seau"]


def prefix(key: Column) -> Column:
    """Even for any kind of key."""
    return F.left(F.md5(key.cast("binary")), F.lit(PREFIX))


def key_table(spark: SparkSession, lake: str) -> str:
    """The table's name in the catalogue of this session, with the partitions it has by now: once for each run."""
    path = f"{lake}/_ingestion/cles"
    name = f"comptoir_cles_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (cle string, fichier string, source string, destination string, taille bigint, "
        "lignes bigint, date string, lot string, genre string, seau string) USING parquet PARTITIONED BY (genre, seau) "
        f"CLUSTERED BY (cle) SORTED BY (cle) INTO {BUCKETS} BUCKETS LOCATION '{place}'")
    if exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
    return name


def add_keys(keys: DataFrame, table: str) -> None:
    """Append keys (all of COLUMNS but `seau`). They count as soon as their run has recorded its outcomes."""
    rows = keys.withColumn("seau", prefix(F.col("cle"))).select(*COLUMNS)
    rows.repartition("genre", "seau").write.insertInto(table)


def known_keys(asked: DataFrame, table: str, kind: str, runs: DataFrame) -> DataFrame:
    """Rows of the keys of a kind that are among `asked` (cle), from the recorded `runs` (lot).

    The driver learns the prefixes asked for, 256 at most.
    """
    prefixes = [r[0] for r in asked.select(prefix(F.col("cle"))).distinct().collect() if r[0] is not None]
    held = asked.sparkSession.table(table).where((F.col("genre") == kind) & F.col("seau").isin(prefixes))
    return held.join(asked.select("cle").distinct(), "cle", "left_semi").join(runs, "lot", "left_semi")
