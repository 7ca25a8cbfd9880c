"""Plans: what must hold on a large cluster, seen on small rows."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from comptoir.catalog.inputs import source
from comptoir.catalog.queries import REGISTRY
from comptoir.operators import cleaning, enrichment, profiling, versions
from comptoir.operators.joins import lookup
from comptoir.sources.landing import spread
from comptoir.streaming import events

SF_DIR = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
}


@contextmanager
def settings(spark, values):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    """Final plan of a frame that collects to one row."""
    frame.collect()
    return plan(frame).split("Initial Plan")[0]


def digest(frame):
    """One row that needs every column."""
    return frame.agg(F.max(F.xxhash64(*frame.columns)), F.count(F.lit(1)))


@pytest.fixture(scope="module")
def hot_sales(spark):
    """A third of the sales has one customer, another third none, and the rest many."""
    return spark.range(0, 90_000, 1, 12).select(
        F.concat(F.lit("V"), "id").alias("id_vente"),
        F.sha2(F.col("id").cast("string"), 256).alias("date_vente_source"),
        F.when(F.col("id") % 3 == 0, "C0").when(F.col("id") % 3 == 1, F.concat(F.lit("C"), F.col("id") % 500))
        .alias("id_client"))


@pytest.fixture(scope="module")
def customers(spark):
    """One row per key, clustered by it, as an aggregation leaves them."""
    rows = spark.range(1000).select(F.concat(F.lit("C"), F.col("id") % 400).alias("id_client"))
    return rows.groupBy("id_client").agg(
        F.max(F.lit("x")).alias("nom_client"), F.max(F.lit("y")).alias("ville_client"),
        F.max(F.lit("z")).alias("segment"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_hot_key_of_a_lookup_is_split(spark, hot_sales, customers, how):
    with settings(spark, NO_BROADCAST):
        split = executed(digest(lookup(hot_sales, customers, "id_client", how)))
        assert "skew=true" in split
        whole = executed(digest(hot_sales.join(customers, "id_client", how)))
        assert "skew=true" not in whole  # what lookup is there for
    matched = lookup(hot_sales, customers, "id_client", how)
    counts = {"left": 90_000, "inner": 54_000, "left_anti": 36_000}
    assert matched.count() == counts[how]


def test_hot_key_of_duplicate_rows_is_split(spark, hot_sales):
    with settings(spark, NO_BROADCAST):
        rows = profiling.duplicate_rows(hot_sales, "id_client")
        assert "skew=true" in executed(digest(rows))
        assert rows.count() == 60_000


def test_rejects_do_not_inherit_the_clustering_of_a_join(spark, hot_sales, customers):
    products = spark.createDataFrame([], "id_produit string, nom_produit string, categorie string, prix_unitaire double")
    stores = spark.createDataFrame([], "id_magasin string, nom_magasin string, ville string, region string")
    sales = hot_sales.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in (
        ("date_vente", "date"), ("id_produit", "string"), ("id_magasin", "string"), ("quantite", "int"),
        ("ingest_date", "string"), ("anomalies", "string"))])
    with settings(spark, NO_BROADCAST):
        rejected = enrichment.rejected_sales(enrichment.match_sales(sales, customers, products, stores))
        assert "skew=true" in executed(digest(rejected))
    assert rejected.count() == 90_000


def test_versions_are_limited_before_the_shuffle(spark):
    rows = source(spark, SF_DIR, "ventes")
    text = plan(versions.latest_version(rows, "id_vente"))
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_cleaning_shuffles_once(spark):
    for name, clean in cleaning.CLEANERS.items():
        assert plan(clean(source(spark, SF_DIR, name))).count("Exchange hashpartitioning") == 1, name


def test_aggregations_combine_before_the_shuffle(spark):
    for name in ("revenue_by_city", "key_duplicates", "exact_duplicates", "orphan_customers",
                 "source_file_count", "segment_counts", "source_profile"):
        text = plan(REGISTRY[name](spark, SF_DIR))
        assert "partial_count" in text or "partial_sum" in text, name


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - {"batch_revenue"} - {
    n for n in REGISTRY if n.startswith("stream_") or n.startswith("ingest_") or n.endswith("_scan")}))
def test_no_query_multiplies_or_gathers_rows(spark, name):
    text = plan(REGISTRY[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set",
                     "BatchEvalPython"):
        assert operator not in text
    # A single partition only ever takes aggregated rows, or the few of a top-n.
    for part in re.split(r"Exchange SinglePartition", text)[1:]:
        assert "partial_" in part or "TakeOrdered" in part


def test_only_needed_columns_are_read(spark):
    text = plan(REGISTRY["suspicious_prices"](spark, SF_DIR))
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in text
    assert "p_name" not in text
    text = plan(REGISTRY["revenue_by_city"](spark, SF_DIR))
    assert "customer.parquet" not in text


def test_small_dimensions_are_broadcast_by_size_alone(spark):
    text = plan(REGISTRY["enrich_sales"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 3
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(REGISTRY["enrich_sales"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 0 and text.count("SortMergeJoin") == 3


def test_events_are_parsed_once(spark):
    judged = events.judge_events(spark.createDataFrame([], "value binary, partition int, offset bigint, timestamp timestamp"))
    assert plan(events.typed_events(events.valid_events(judged))).count("from_json") == 1


def test_files_are_spread_by_their_bytes(spark):
    files = spark.createDataFrame([(f"f{i}", 10 << 20) for i in range(100)], "chemin string, taille bigint")
    assert spread(files, 100 << 20).rdd.getNumPartitions() == 14
    assert spread(files.limit(0)).rdd.getNumPartitions() == 1
