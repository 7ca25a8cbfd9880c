"""Ingestion of a landing zone into the raw zone."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.operators import control, ingestion
from comptoir.operators.joins import all_of
from comptoir.schemas import EXTENSIONS
from comptoir.session import exists, qualified
from comptoir.sinks import keys, replace_partition, run, write_new
from comptoir.sources.files import copy_file
from comptoir.sources.inventory import list_folders, list_objects
from comptoir.sources.landing import LISTED, landing_files, spread

OUTCOME_SCHEMA = (
    "source string, fichier string, chemin string, taille bigint, modifie_le bigint, "
    "sha256 string, lignes bigint, statut string, motif string, destination string, "
    "rangement string, date string, disposition string, coupures boolean, lot string")


@dataclass(frozen=True)
class Intake:
    """What one run decided, and the state of the lake after it."""

    outcomes: DataFrame
    manifest: DataFrame
    journal: DataFrame
    code: int


def read_outcomes(spark: SparkSession, lake: str) -> DataFrame:
    """Outcome of every file of every run; empty before the first."""
    path = f"{lake}/_ingestion/resultats"
    if not exists(spark, path):
        return spark.createDataFrame([], OUTCOME_SCHEMA)
    return spark.read.schema(OUTCOME_SCHEMA).parquet(path)


def recorded_runs(spark: SparkSession, lake: str) -> DataFrame:
    """(lot) of the runs that have recorded their outcomes, from the names of their folders."""
    path = f"{lake}/_ingestion/resultats"
    if not exists(spark, path):
        return spark.createDataFrame([], "lot string")
    return list_folders(spark, path).where(F.col("cle").startswith("lot=")).select(
        F.substring_index("cle", "=", -1).alias("lot"))


def arrival_key() -> Column:
    """A file as the listing shows it: judged again only if it changes."""
    return F.concat_ws("|", "chemin", "modifie_le", "taille")


def pending_files(files: DataFrame, table: str, runs: DataFrame) -> DataFrame:
    """Files no run has judged yet, or changed since. Judged by the listing alone."""
    named = files.withColumn("cle", arrival_key())
    return named.join(keys.known_keys(named, table, keys.FILE, runs).select("cle"), "cle", "left_anti").drop("cle")


def known_contents(controlled: DataFrame, table: str, runs: DataFrame) -> DataFrame:
    """The part of the manifest that holds the controlled contents."""
    asked = controlled.where(F.col("motif").isNull()).select(F.col("sha256").alias("cle"))
    return keys.known_keys(asked, table, keys.CONTENT, runs).select(
        F.col("cle").alias("sha256"), "fichier", "source", "destination", "taille", "lignes", "date")


def names_filed(controlled: DataFrame, table: str, runs: DataFrame) -> DataFrame:
    """(rangement) in use, of those that the controlled files could get."""
    folders = F.explode(F.array(F.lit(ingestion.ARCHIVE_FOLDER), F.lit(ingestion.REJECTED_FOLDER)))
    asked = controlled.select("source", "fichier", folders.alias("dossier")).select(
        F.concat_ws("/", "dossier", "source", "fichier").alias("cle"))
    return keys.known_keys(asked, table, keys.FILED, runs).select(F.col("cle").alias("rangement"))


def keys_of(outcome: DataFrame) -> DataFrame:
    """What later runs will ask for."""
    def of(kind: str, key: Column, rows: DataFrame) -> DataFrame:
        return rows.select(key.alias("cle"), "fichier", "source", "destination", "taille", "lignes", "date", "lot",
                           F.lit(kind).alias("genre"))

    accepted = outcome.where(F.col("statut") == ingestion.SUCCESS)
    return all_of([of(keys.CONTENT, F.col("sha256"), accepted), of(keys.FILE, arrival_key(), outcome),
                   of(keys.FILED, F.col("rangement"), outcome)])


def land(accepted: DataFrame, lake: str) -> DataFrame:
    """Copy accepted files, byte for byte, to their destination.

    The copy is fingerprinted on the way: what lies in the raw zone is what was controlled.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch.itertuples():
                if copy_file(file.chemin, f"{lake}/{file.destination}") != file.sha256:
                    raise RuntimeError(f"{file.chemin} changed while it was ingested")
            yield batch[["destination"]]

    return accepted.select("chemin", "destination", "sha256").mapInPandas(copy, "destination string")


def taken_keys(spark: SparkSession, lake: str, day: str, runs: DataFrame) -> DataFrame:
    """Keys of the raw zone that a lot of this day could run into.

    Copies of a run that was lost before it recorded its outcomes are not among them: the next
    run writes the same keys again instead of adding copies under other names. Only runs of this day, whose names begin with it,
    have written such keys; no other partition is read.
    """
    folders = [f"raw/{source}/ingest_date={day}" for source in EXTENSIONS]
    listings = [list_objects(spark, f"{lake}/{folder}").select(
        F.concat(F.lit(f"{folder}/"), "cle").alias("destination"))
        for folder in folders if exists(spark, f"{lake}/{folder}")]
    found = all_of([spark.createDataFrame([], "destination string"), *listings])
    decisions = f"{lake}/_ingestion/decisions"
    if not listings or not exists(spark, decisions):
        return found
    decided = (spark.read.schema("statut string, destination string, lot string").parquet(decisions)
               .where(F.col("lot").startswith(day.replace("-", "")) & (F.col("statut") == ingestion.SUCCESS)))
    kept = decided.join(runs, "lot", "left_semi").select("destination")
    lost = decided.join(runs, "lot", "left_anti").join(kept, "destination", "left_anti")
    return found.join(lost.select("destination"), "destination", "left_anti")


def ingest(spark: SparkSession, landing: str, lake: str, at: datetime | None = None) -> Intake:
    """Control, fingerprint, de-duplicate, land and journal the files of a landing zone.

    Contents are read by the tasks that control them, whose findings are stored before anything
    depends on them, and once more for the copy of accepted files. What earlier runs know is looked up by
    key (`sinks/keys.py`); their history is not read. The outcomes of a run are one
    partition of one table, written last: a run that is lost is simply started again. Arrived
    files stay where they are; ``rangement`` says where they belong.
    """
    landing, lake = qualified(spark, landing), qualified(spark, lake)
    moment = at or datetime.now()
    lot = f"{moment:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"  # runs may share their moment
    runs = recorded_runs(spark, lake)
    listing = f"{lake}/_ingestion/listes/lot={lot}"
    write_new(landing_files(spark, landing), listing)
    table = keys.key_table(spark, lake)
    files = pending_files(spark.read.schema(LISTED).parquet(listing), table, runs)

    findings = f"{lake}/_ingestion/controles/lot={lot}"
    write_new(control.control_files(spread(files)), findings)
    controlled = spark.read.parquet(findings)

    taken = taken_keys(spark, lake, f"{moment:%Y-%m-%d}", runs)
    decided = ingestion.decide(controlled, known_contents(controlled, table, runs), taken,
                               names_filed(controlled, table, runs), moment.strftime("%Y-%m-%d %H:%M:%S"))
    decisions = f"{lake}/_ingestion/decisions/lot={lot}"
    write_new(decided, decisions)
    outcome = spark.read.parquet(decisions).withColumn("lot", F.lit(lot))

    accepted = outcome.where(F.col("statut") == ingestion.SUCCESS)
    run(land(spread(accepted), lake))
    keys.add_keys(keys_of(outcome), table)
    replace_partition(ingestion.journal_of(outcome).withColumn("lot", F.lit(lot)),
                      f"{lake}/_ingestion/journal", "lot", "json")
    replace_partition(outcome, f"{lake}/_ingestion/resultats", "lot")

    after = read_outcomes(spark, lake)
    rejected = outcome.where(F.col("statut") == ingestion.REJECTED)
    return Intake(after.where(F.col("lot") == lot), ingestion.manifest_of(after),
                  ingestion.journal_of(after), 0 if rejected.isEmpty() else 1)
