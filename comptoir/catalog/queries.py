"""One query per operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.catalog import files as W
from comptoir.catalog import landing
from comptoir.catalog.inputs import source
from comptoir.functions import city_standard
from comptoir.operators import cleaning, control, enrichment, ingestion, versions
from comptoir.operators import profiling as P
from comptoir.operators.joins import all_of, lookup
from comptoir.operators.revenue import revenue_by
from comptoir.plans.batch import CURATED, has_breaks, run_batch
from comptoir.schemas import KEYS
from comptoir.session import SHUFFLES_FREED, at_once, settings, work_folder
from comptoir.sinks import replace_table, write_new
from comptoir.sources import lots
from comptoir.sources.inventory import data_line_counts, lake_inventory, list_objects
from comptoir.sources.messages import file_messages
from comptoir.sources.workbook import workbook_rows
from comptoir.streaming import events
from comptoir.streaming.job import AVAILABLE_NOW, FILE_ROWS, read_history, read_revenue, start_sales_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
AT = "2026-10-02 08:30:00"
#: Sales that are versioned at once to write source files.
SALES_AT_ONCE = 120_000_000


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def over(name: str, source_name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    """Register an operator of one source."""
    REGISTRY[name] = lambda spark, sf_dir: operator(source(spark, sf_dir, source_name))


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.match_sales(*[
        cleaning.CLEANERS[name](source(spark, sf_dir, name))
        for name in ("ventes", "clients", "produits", "magasins")])


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable sales as revenue needs them: the customer adds nothing and is not joined."""
    sales = cleaning.clean_sales(source(spark, sf_dir, "ventes"))
    # no file has a product or a store twice, so no other column need decide
    products = cleaning.clean_products(source(spark, sf_dir, "produits"), ties=())
    stores = cleaning.clean_stores(source(spark, sf_dir, "magasins"), ties=())
    joined = lookup(lookup(sales, products, "id_produit"), stores, "id_magasin")
    return (enrichment.fill_references(joined).where(enrichment.usable())
            .withColumn("montant", enrichment.amount()))


# Cleaning and versions
over("latest_version", "ventes", lambda rows: versions.latest_version(rows, "id_vente"))
over("drop_duplicate_keys", "ventes",
     lambda rows: versions.drop_duplicate_keys(rows, "id_vente").select("id_vente"))
over("clean_sales", "ventes", lambda rows: cleaning.clean_sales(rows).drop("anomalies"))
over("sales_anomalies", "ventes",
     lambda rows: cleaning.clean_sales(rows).select("id_vente", "anomalies"))
over("clean_customers", "clients", cleaning.clean_customers)
over("clean_products", "produits", cleaning.clean_products)
over("clean_stores", "magasins", cleaning.clean_stores)
over("city_standard", "magasins", lambda rows: rows.select(
    "ville", city_standard(F.col("ville")).alias("ville_standard")).distinct())


# Enrichment and revenue
@query
def reference_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).select("id_vente", "anomalies")


@query
def line_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).select("id_vente", "quantite", "prix_unitaire", "montant")


@query
def enrich_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.usable_sales(matched(spark, sf_dir))


@query
def usable_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced(spark, sf_dir).agg(F.count(F.lit(1)).alias("exploitables"))


@query
def rejected_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.rejected_sales(matched(spark, sf_dir))


@query
def revenue_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(priced(spark, sf_dir), "ville")


@query
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by(priced(spark, sf_dir), "categorie")


# Profiling
over("missing_values", "ventes", P.missing_values)
over("key_duplicates", "ventes", lambda rows: P.key_duplicates(rows, "id_vente"))
over("repeated_keys", "ventes", lambda rows: P.repeated_keys(rows, "id_vente"))
over("duplicate_rows", "ventes", lambda rows: P.duplicate_rows(rows, "id_vente"))
over("segment_counts", "clients", lambda rows: P.value_counts(rows, "segment"))
over("category_counts", "produits", lambda rows: P.value_counts(rows, "categorie"))
over("invalid_dates", "ventes", P.invalid_dates)
over("suspicious_quantities", "ventes", P.suspicious_quantities)
over("suspicious_prices", "produits", P.suspicious_prices)
over("source_file_count", "ventes", lambda rows: P.source_file_count(rows, "_fichier_source"))
over("row_count", "ventes", P.row_count)
over("row_preview", "magasins", lambda rows: P.preview(
    rows.select("id_magasin", "nom_magasin", "ville"), ["id_magasin", "nom_magasin", "ville"]))


@query
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table with the lines of some stores twice."""
    sales = source(spark, sf_dir, "ventes")
    return P.exact_duplicates(sales.unionByName(sales.where(F.col("id_magasin").endswith("0"))))


def orphans_of(name: str) -> Query:
    return lambda spark, sf_dir: P.orphan_keys(
        source(spark, sf_dir, "ventes"), source(spark, sf_dir, name), KEYS[name])


REGISTRY["orphan_customers"] = orphans_of("clients")
REGISTRY["orphan_products"] = orphans_of("produits")
REGISTRY["orphan_stores"] = orphans_of("magasins")


@query
def orphan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.orphan_sales(source(spark, sf_dir, "ventes"), source(spark, sf_dir, "produits"), "id_produit")


@query
def city_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_of([P.city_drift(n, source(spark, sf_dir, n)) for n in ("clients", "magasins")])


@query
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_of([P.source_profile(n, source(spark, sf_dir, n), KEYS[n]) for n in KEYS])


# Sources
@query
def sales_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/ventes"
    W.write_sales_csv(source(spark, sf_dir, "ventes"), folder)
    return W.without_origin(lots.read_sales(spark, folder))


@query
def text_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/ventes"
    W.write_sales_csv(source(spark, sf_dir, "ventes"), folder)
    return data_line_counts(spark, folder).agg(F.sum("lignes").alias("lignes"))


@query
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone table, written twice: the second write replaces the first."""
    path = f"{work_folder(spark)}/processed/produits"
    products = cleaning.clean_products(source(spark, sf_dir, "produits"))
    replace_table(products, path)
    replace_table(products, path, files=1)
    return lots.read_table(spark, path)


@query
def customers_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/clients"
    W.write_lots(source(spark, sf_dir, "clients"), folder, W.write_json_arrays)
    return W.without_origin(lots.read_customers(spark, folder))


@query
def products_xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/produits"
    W.write_lots(source(spark, sf_dir, "produits"), folder, W.write_products_xml)
    return W.without_origin(lots.read_products(spark, folder))


@query
def stores_xlsx_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook_rows(W.as_workbooks(source(spark, sf_dir, "magasins"))).drop("path")


@query
def batch_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job: files of the four sources to the two curated tables."""
    lake = work_folder(spark)
    # One row per sale: the parts of one lot carry no order that the versions could follow.
    sold, customers, products, stores = (source(spark, sf_dir, name) for name in ("ventes", "clients", "produits", "magasins"))
    with settings(spark, SHUFFLES_FREED):
        sales = [versions.latest_version(part, "id_vente")
                 for part in versions.parts_by_key(sold, "id_vente", -(-sold.count() // SALES_AT_ONCE))]
        at_once(spark, [
            lambda: W.write_sales_csv(sales, f"{lake}/raw/ventes"),
            lambda: W.write_lots(customers, f"{lake}/raw/clients", W.write_json_arrays),
            lambda: W.write_lots(products, f"{lake}/raw/produits", W.write_products_xml),
            lambda: W.write_workbooks(stores, f"{lake}/raw/magasins")])
    run_batch(spark, lake)
    return both_axes(spark, f"{lake}/curated")


def both_axes(spark: SparkSession, curated: str) -> DataFrame:
    return all_of([
        lots.read_table(spark, f"{curated}/{name}").select(
            F.lit(name).alias("axe"), F.col(key).alias("cle"),
            "nb_ventes", "quantite_totale", "chiffre_affaires")
        for name, key in CURATED.items()])


# File ingestion
def arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.encode("texte", "UTF-8")
    return source(spark, sf_dir, "fichiers").select(
        "source", "fichier", F.col("fichier").alias("chemin"),
        F.length(content).cast("bigint").alias("taille"), content.alias("content"))


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = f"{work_folder(spark)}/controles"
    write_new(control.control_files(arrived(spark, sf_dir)), findings)
    nothing = spark.createDataFrame([], f"{ingestion.MANIFEST_SCHEMA}, rangement string")
    return ingestion.decide(spark.read.parquet(findings), nothing, nothing, nothing, AT)


@query
def file_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.control_files(arrived(spark, sf_dir)).drop("chemin", "disposition", "coupures")


@query
def file_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrived(spark, sf_dir).select("source", "fichier", F.sha2("content", 256).alias("sha256"))


@query
def ingest_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome(spark, sf_dir).drop("chemin", "lignes", "date", "disposition", "coupures")


@query
def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.manifest_of(outcome(spark, sf_dir))


@query
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.summary_of(outcome(spark, sf_dir))


def second_runs(spark: SparkSession, sf_dir: str) -> tuple[str, list]:
    folder = work_folder(spark)
    return f"{folder}/lake", landing.two_runs(spark, sf_dir, folder)


@query
def ingest_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a run that meets contents, keys and names of an earlier one, and files that came again."""
    return second_runs(spark, sf_dir)[1][1].outcomes.select(
        "source", "fichier", "sha256", "taille", "lignes", "statut", "motif", "destination", "rangement")


@query
def ingest_known_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as it has grown over two runs."""
    return second_runs(spark, sf_dir)[1][1].manifest


@query
def ingest_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal of two runs, as it is stored."""
    lake, _ = second_runs(spark, sf_dir)
    return spark.read.schema("date string, source string, fichier string, destination string, taille_octets bigint, "
                             "statut string, motif string").json(f"{lake}/_ingestion/journal").drop("lot")


@query
def ingest_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run returns: 1 if it has refused a file."""
    return spark.createDataFrame([(n, run.code) for n, run in enumerate(second_runs(spark, sf_dir)[1], 1)], "tour int, code int")


@query
def ingest_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that the accepted files hold by their control, and those that the readers of the raw zone find."""
    lake, runs = second_runs(spark, sf_dir)
    held = runs[1].manifest.groupBy("source").agg(F.sum("lignes").alias("lignes"))
    raw = {"ventes": lots.read_filed_sales(spark, f"{lake}/raw/ventes", has_breaks(spark, lake, by_hand=False)),
           "clients": lots.read_customers(spark, f"{lake}/raw/clients"),
           "produits": lots.read_products(spark, f"{lake}/raw/produits")}
    read = all_of([rows.agg(F.count(F.lit(1)).alias("lues")).select(F.lit(name).alias("source"), "lues")
                   for name, rows in raw.items()])
    return held.join(read, "source", "full")


def laid_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of a lake with the landed lots in it: empty ones and underscore names too, copies directly in the zone."""
    lake = work_folder(spark)
    place = F.when(F.col("fichier").startswith("copie"), F.lit("raw")).otherwise(
        F.concat(F.lit("raw/"), "source", F.lit("/ingest_date=2026-10-02")))
    landing.arrive(landing.landed(spark, sf_dir).where("tour = 1 OR fichier LIKE 'copie%'").withColumn("source", place), lake)
    return list_objects(spark, lake, levels=3)


@query
def inventory_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_inventory(laid_down(spark, sf_dir))


@query
def object_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and size of every object, and whether its modification lies in this run."""
    recent = F.col("modifie_le").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp() + F.expr("INTERVAL 1 DAY"))
    return laid_down(spark, sf_dir).select("cle", "taille", recent.alias("recent"))


REGISTRY["lake_inventory"] = lambda spark, sf_dir: lake_inventory(arrived(spark, sf_dir).select(
    F.when(F.length("fichier") > 19, F.concat_ws("/", F.lit("raw"), "source", "fichier"))
    .otherwise(F.concat_ws("/", F.lit("raw"), "fichier")).alias("cle"), "taille"))


# Events, as a batch and as a stream
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "messages").select(
        F.col("message").cast("binary").alias("value"), "partition", "offset",
        F.col("timestamp").cast("timestamp").alias("timestamp"))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.judge_events(messages(spark, sf_dir))


def shown(typed: DataFrame) -> DataFrame:
    """Event time as text: it reads the same in any session time zone."""
    return typed.withColumn("horodatage", F.date_format("horodatage", "yyyy-MM-dd HH:mm:ss"))


def streamed(spark: SparkSession, sf_dir: str) -> str:
    """Lake that a stream over all messages has filled."""
    folder = work_folder(spark)
    messages(spark, sf_dir).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/messages")
    stream = start_sales_stream(file_messages(spark, f"{folder}/messages"), f"{folder}/lake",
                                f"{folder}/checkpoint", AVAILABLE_NOW)
    stream.wait()
    return f"{folder}/lake"


@query
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.parse_events(messages(spark, sf_dir)).drop("kafka_timestamp")


@query
def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.valid_events(judged(spark, sf_dir))


@query
def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.rejected_events(judged(spark, sf_dir))


@query
def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(events.typed_events(events.valid_events(judged(spark, sf_dir))))


@query
def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.batch_statistics(judged(spark, sf_dir)).orderBy("partition")


@query
def stream_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_axes(spark, streamed(spark, sf_dir))


def revenue_axes(spark: SparkSession, lake: str) -> DataFrame:
    return all_of([read_revenue(spark, lake, name).select(
        F.lit(name).alias("axe"), F.col(key).alias("cle"), "nb_ventes", "quantite_totale", "chiffre_affaires")
        for name, key in CURATED.items()])


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of a stream that ran on its trigger over a part of the messages, was stopped, and started again from its
    checkpoint when the others had come."""
    folder = work_folder(spark)
    sent = messages(spark, sf_dir)
    for part in (0, 1):
        sent.where((F.col("offset") % 3 == 0) == (part == 0)).write.mode("append").option(
            "maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/messages")
        trigger = {"processingTime": "1 second"} if part == 0 else AVAILABLE_NOW
        stream = start_sales_stream(file_messages(spark, f"{folder}/messages"), f"{folder}/lake", f"{folder}/checkpoint", trigger)
        if part == 0:
            for started in (stream.batches, stream.revenue):
                started.processAllAvailable()
            stream.stop()
        else:
            stream.wait()
    return revenue_axes(spark, f"{folder}/lake")


@query
def stream_valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(read_history(spark, streamed(spark, sf_dir)).drop("micro_batch"))


@query
def stream_rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("message string, partition int, offset bigint").json(
        f"{streamed(spark, sf_dir)}/raw/rejets_stream").drop("micro_batch")


@query
def stream_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("message string, partition int, offset bigint").json(
        f"{streamed(spark, sf_dir)}/raw/ventes_stream").drop("micro_batch")


@query
def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source partition over all micro-batches."""
    per_batch = spark.read.parquet(f"{streamed(spark, sf_dir)}/processed/statistiques_stream")
    return per_batch.groupBy("partition").agg(
        F.min("premier_offset").alias("premier_offset"),
        F.max("dernier_offset").alias("dernier_offset"),
        *[F.sum(name).alias(name) for name in ("recus", "valides", "rejetes")])
