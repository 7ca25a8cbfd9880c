"""Raw to processed to curated, and the chain that starts with the ingestion."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from comptoir.operators import enrichment
from comptoir.operators.cleaning import CLEANERS
from comptoir.operators.revenue import revenue_by_axes, revenue_of_axis
from comptoir.operators.versions import parts_by_key
from comptoir.plans.intake import Intake, ingest, read_outcomes
from comptoir.schemas import ENRICHED_COLUMNS, KEYS
from comptoir.session import SHUFFLES_FREED, at_once, settings, stored_bytes
from comptoir.sinks import read_pieces, replace_table
from comptoir.sources.lots import read_raw, read_table

CURATED = {"ca_par_ville": "ville", "ca_par_categorie": "categorie"}

#: Matched sales are not sorted to be written to two partitions: a task holds both files open.
TWO_FILES_OPEN = {"spark.sql.optimizer.plannedWrite.enabled": "false", "spark.sql.maxConcurrentOutputFileWriters": "2"}

#: Bytes of sales lots, and of the cleaned sales, that are shuffled at once. More are taken in parts, one after the other.
RAW_BYTES, CLEAN_BYTES = 8 << 30, 384 << 20


def processed(lake: str, table: str) -> str:
    return f"{lake}/processed/{table}"


def _matched(spark: SparkSession, lake: str, exploitable: str) -> DataFrame:
    """One of the two partitions; the other one is not scanned."""
    matched = read_table(spark, processed(lake, "ventes_rapprochees"))
    return matched.where(matched["exploitable"] == exploitable).drop("exploitable")


def read_enriched(spark: SparkSession, lake: str) -> DataFrame:
    return _matched(spark, lake, "true").select(*ENRICHED_COLUMNS)


def read_rejected(spark: SparkSession, lake: str) -> DataFrame:
    return _matched(spark, lake, "false").distinct()


def has_breaks(spark: SparkSession, lake: str, by_hand: bool) -> bool:
    """Whether a sales lot may have records over several lines: by the findings of the ingestion, or if lots came by hand."""
    return by_hand or not read_outcomes(spark, lake).where("source = 'ventes' AND coalesce(coupures, false)").isEmpty()


def clean_zone(spark: SparkSession, raw: str, lake: str, cleaners: dict = CLEANERS, by_hand: bool = True) -> None:
    """The sales, by far the largest source, are cleaned in parts if they are many: a cleaner sees all rows of an identifier at once."""
    sources = read_raw(spark, raw, has_breaks(spark, lake, by_hand))
    parts = {source: [rows] for source, rows in sources.items()}
    parts["ventes"] = parts_by_key(sources["ventes"], KEYS["ventes"], -(-stored_bytes(spark, f"{raw}/ventes") // RAW_BYTES))
    at_once(spark, [partial(replace_table, [cleaners[source](rows) for rows in parts[source]], processed(lake, source))
                    for source in sources])


def match_zone(spark: SparkSession, lake: str) -> None:
    """Join once; usable and rejected sales become the two partitions of one table. Many sales are joined in parts."""
    references = [read_table(spark, processed(lake, source)) for source in ("clients", "produits", "magasins")]
    matched = [enrichment.match_sales(sales, *references).withColumn("exploitable", enrichment.usable())
               for sales in read_pieces(spark, processed(lake, "ventes"), CLEAN_BYTES)]
    with settings(spark, TWO_FILES_OPEN):
        replace_table(matched, processed(lake, "ventes_rapprochees"), partition_by="exploitable")


def enriched_zone(spark: SparkSession, lake: str) -> None:
    """The usable sales once more, as ``ventes_enrichies``, the 17 columns that readers know."""
    replace_table(read_enriched(spark, lake), processed(lake, "ventes_enrichies"))


def write_curated(totals: DataFrame, folder: str) -> None:
    """The curated tables, one row per key: a single file is right here, and only here."""
    totals = totals.persist()
    try:
        for table, key in CURATED.items():
            replace_table(revenue_of_axis(totals, table, key), f"{folder}/{table}", files=1)
    finally:
        totals.unpersist()


def curate_zone(spark: SparkSession, lake: str) -> None:
    write_curated(revenue_by_axes(read_enriched(spark, lake), CURATED), f"{lake}/curated")


def run_batch(spark: SparkSession, lake: str, raw: str | None = None,
              cleaners: dict = CLEANERS, by_hand: bool = True) -> None:
    """Each step reads the tables the one before has written, so no lineage spans the job. The last two need the same table only.

    Say ``by_hand=False`` if the ingestion has filed every lot: what it found tells how lots can be read.
    """
    with settings(spark, SHUFFLES_FREED):
        clean_zone(spark, raw or f"{lake}/raw", lake, cleaners, by_hand)
        match_zone(spark, lake)
        at_once(spark, [partial(zone, spark, lake) for zone in (enriched_zone, curate_zone)])


def run_all(spark: SparkSession, landing: str, lake: str, at: datetime | None = None) -> Intake:
    """Ingestion, then the batch, which runs also when files were rejected."""
    intake = ingest(spark, landing, lake, at)
    run_batch(spark, lake, by_hand=False)
    return intake
