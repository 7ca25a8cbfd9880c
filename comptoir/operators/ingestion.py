"""From controlled files to their outcome: status, reason, destination, filing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.operators.control import suffix
from comptoir.operators.joins import lookup
from comptoir.schemas import EXTENSIONS

# Statuses, folders and reasons as they are written to the journal.
SUCCESS = "SUCCESS"
DUPLICATE = "DUPLICATE"
REJECTED = "REJECTED"
ARCHIVE_FOLDER = "_archive"
REJECTED_FOLDER = "_rejected"
ROWS_TAKEN = "%d enregistrement(s)"
ALREADY_TAKEN = "contenu identique déjà ingéré le %s (%s)"

#: So many keys in use are sent to the tasks that ask for them; with more, files and keys meet in a shuffle.
KEYS_SENT = 100_000

MANIFEST_SCHEMA = ("sha256 string, fichier string, source string, destination string, "
                   "taille bigint, lignes bigint, date string")


def source_rank(source: Column) -> Column:
    """Position of a source in the processing order."""
    return F.array_position(F.array(*map(F.lit, EXTENSIONS)), source)


def with_inserted(name: Column, insertion: Column) -> Column:
    """'a.csv' with an insertion before its suffix."""
    extension = suffix(name)
    stem = F.substr(name, F.lit(1), F.length(name) - F.length(extension))
    return F.concat(stem, insertion, extension)


def destination(day: str) -> Column:
    """Key in the raw zone. A name that readers would not see, for its underscore, gets another begin.

    A sales lot with another order of columns gets a folder that says where they are, so that readers need not open it to know.
    """
    return F.concat_ws("/", F.lit("raw"), "source", F.lit(f"ingest_date={day}"),
                       F.concat(F.lit("disposition="), "disposition"), F.regexp_replace("fichier", "^_", "lot_"))


def _count_of(rows: DataFrame) -> int:
    """Rows, counted as far as it matters whether they can be sent."""
    return rows.limit(KEYS_SENT + 1).count()


def _with_use(rows: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Rows with `_pris`, true if their key is among those in use. Files are shuffled only for keys that are too many to send."""
    held = _count_of(used)
    if held == 0:
        return rows.withColumn("_pris", F.lit(None).cast("boolean"))
    in_use = used.select(key, F.lit(True).alias("_pris")).distinct()
    return rows.join(F.broadcast(in_use), key, "left") if held <= KEYS_SENT else lookup(rows, in_use, key)


def decide(controlled: DataFrame, manifest: DataFrame, taken: DataFrame, filed: DataFrame,
           at: str) -> DataFrame:
    """Outcome of every file.

    ``manifest`` lists the contents taken so far, ``taken`` (destination) the keys in use in the
    raw zone, ``filed`` (rangement) the names used when filing, ``at`` is 'yyyy-MM-dd HH:mm:ss'.
    Refusals come first, then known contents; of equal contents inside one run the first in
    source and name order is taken. That first one is found by an aggregation and joined back,
    so many copies of one content meet in no single task. Only these two steps shuffle the files, by the bytes of
    the fingerprint; what earlier runs know is sent to the tasks as long as it is small.
    """
    kept = [name for name in controlled.columns if name != "motif"]
    refused = controlled.where(F.col("motif").isNotNull()).select(
        *kept, F.lit(REJECTED).alias("statut"), "motif", F.lit("").alias("destination"))

    sound = controlled.where(F.col("motif").isNull()).withColumn("rang", source_rank(F.col("source")))
    if _count_of(manifest) > KEYS_SENT:  # only the part that this run asks for goes on
        manifest = manifest.join(sound.select("sha256").distinct(), "sha256", "left_semi")
    known = manifest.select(
        F.unhex("sha256").alias("_empreinte"),
        F.struct(F.lit(0).cast("bigint").alias("rang"), "fichier", "source", "destination", "date")
        .alias("premier"))
    plain = sound.select("*", destination(at[:10]).alias("destination"))
    free = (_with_use(plain, taken, "destination")
            .withColumn("destination", F.when(F.col("_pris"), with_inserted(
                F.col("destination"), F.concat(F.lit("__"), F.left("sha256", F.lit(8)))))
                .otherwise(F.col("destination")))
            .withColumn("_empreinte", F.unhex("sha256")).drop("_pris", "sha256"))
    candidates = free.select("_empreinte", F.struct(
        "rang", "fichier", "source", "destination", F.lit(at).alias("date")).alias("premier"))
    # Rank 0 puts what the manifest knows before anything of this run.
    firsts = (known.unionByName(candidates).groupBy("_empreinte")
              .agg(F.min("premier").alias("premier")))

    first = F.col("premier")
    is_first = ((first["rang"] == F.col("rang")) & (first["fichier"] == F.col("fichier")))
    judged = lookup(free, firsts, "_empreinte").withColumn("sha256", F.lower(F.hex("_empreinte"))).select(
        *kept,
        F.when(is_first, SUCCESS).otherwise(DUPLICATE).alias("statut"),
        F.when(is_first, F.format_string(ROWS_TAKEN, "lignes"))
        .otherwise(F.format_string(ALREADY_TAKEN, first["date"], first["fichier"])).alias("motif"),
        first["destination"].alias("destination"))
    return _file_away(refused.unionByName(judged), filed, at)


def _file_away(outcome: DataFrame, filed: DataFrame, at: str) -> DataFrame:
    """Where the arrived file belongs afterwards; a name already used there gets a time suffix."""
    folder = F.when(F.col("statut") == REJECTED, REJECTED_FOLDER).otherwise(ARCHIVE_FOLDER)
    stamp = "_" + "".join(c for c in at if c.isdigit())
    placed = outcome.withColumn("rangement", F.concat_ws("/", folder, "source", "fichier"))
    return (_with_use(placed, filed, "rangement")
            .withColumn("rangement", F.when(F.col("_pris"), with_inserted(
                F.col("rangement"), F.lit(stamp))).otherwise(F.col("rangement")))
            .withColumn("date", F.lit(at))
            .drop("_pris"))


def manifest_of(outcomes: DataFrame) -> DataFrame:
    """Contents taken, one row per fingerprint."""
    return outcomes.where(F.col("statut") == SUCCESS).select(
        "sha256", "fichier", "source", "destination", "taille", "lignes", "date")


def journal_of(outcomes: DataFrame) -> DataFrame:
    """One line per arrived file."""
    return outcomes.select(
        "date", "source", "fichier", "destination", F.col("taille").alias("taille_octets"),
        "statut", "motif")


def summary_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("statut").agg(F.count(F.lit(1)).alias("fichiers"))
