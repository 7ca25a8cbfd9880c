"""Keys of earlier runs: lookups that prune and do not shuffle history, and lots of several layouts."""

from datetime import datetime

import pytest
from lake_files import put, sales_csv
from pyspark.sql import functions as F

from comptoir.operators.control import layout
from comptoir.plans.batch import has_breaks
from comptoir.plans.intake import ingest
from comptoir.sinks import keys
from comptoir.sources import lots

AT = datetime(2026, 10, 2, 8, 30)


def rows_of(spark, numbers, run, kind=keys.CONTENT):
    return spark.range(numbers).select(
        F.concat(F.lit("k"), "id").alias("cle"), F.lit("f").alias("fichier"), F.lit("s").alias("source"),
        F.lit("d").alias("destination"), F.col("id").alias("taille"), F.col("id").alias("lignes"), F.lit("t").alias("date"),
        F.lit(run).alias("lot"), F.lit(kind).alias("genre"))


def test_lookup_prunes_and_leaves_history_where_it_is(spark, tmp_path):
    lake = f"file:{tmp_path}/lake"
    table = keys.key_table(spark, lake)
    keys.add_keys(rows_of(spark, 2000, "r1"), table)
    keys.add_keys(rows_of(spark, 50, "lost"), table)
    keys.add_keys(rows_of(spark, 30, "r1", keys.FILE), table)
    runs = spark.createDataFrame([("r1",)], "lot string")
    asked = spark.createDataFrame([("k7",), ("k7",), ("k1999",), ("none",), (None,)], "cle string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", before):  # whether what is asked for is small or not
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            found = keys.known_keys(asked, table, keys.CONTENT, runs)
            assert sorted((r.cle, r.taille) for r in found.collect()) == [("k1999", 1999), ("k7", 7)]
            plan = found._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
        assert "seau" in scan and "genre" in scan and "PartitionFilters: []" not in scan
        if threshold == "-1":  # the history meets what is asked for without an exchange of its own
            above = plan[:plan.index(scan)].splitlines()[::-1]
            join = next(i for i, line in enumerate(above) if "Join" in line)
            assert not any("Exchange" in line for line in above[:join])
    held = spark.table(table).where("genre = 'contenu'").select("seau").distinct().count()
    assert held > 200  # spread over most prefixes


def test_another_session_finds_the_table(spark, tmp_path):
    lake = f"file:{tmp_path}/lake"
    keys.add_keys(rows_of(spark, 100, "r1"), keys.key_table(spark, lake))
    spark.sql(f"DROP TABLE {keys.key_table(spark, lake)}")
    again = keys.key_table(spark, lake)
    asked = spark.createDataFrame([("k3",)], "cle string")
    assert keys.known_keys(asked, again, keys.CONTENT, spark.createDataFrame([("r1",)], "lot string")).count() == 1


def test_layout_of_columns():
    usual = ["id_vente", "date_vente", "id_client", "id_produit", "id_magasin", "quantite"]
    assert layout(usual) is None and layout([*usual, "autre"]) is None
    assert layout(["autre", *usual]) == "1-2-3-4-5-6"
    assert layout(usual[::-1]) == "5-4-3-2-1-0"
    assert layout(usual[1:]) is None  # refused for what it lacks
    with pytest.raises(Exception, match="TooManyColumns"):
        layout([f"c{i}" for i in range(300)] + usual)


def test_lots_of_two_layouts(spark, tmp_path):
    """Many lots, half of them with another order of columns; one scan for each kind, and no lot in the plan by name."""
    for i in range(300):
        if i % 2:
            put(tmp_path / f"in/ventes/a{i}.csv", sales_csv(f"V{i},2026-01-01,C{i},P1,M1,{i}"))
        else:
            put(tmp_path / f"in/ventes/b{i}.csv", sales_csv(f"{i},x,M1,P1,C{i},2026-01-01,V{i}",
                                                            header=" quantite,extra,id_magasin,id_produit,id_client,date_vente,id_vente "))
    lake = str(tmp_path / "lake")
    intake = ingest(spark, str(tmp_path / "in"), lake, AT)
    assert intake.code == 0
    filed = {r.fichier: r.destination for r in intake.manifest.collect()}
    assert filed["a1.csv"] == "raw/ventes/ingest_date=2026-10-02/a1.csv"
    assert filed["b0.csv"] == "raw/ventes/ingest_date=2026-10-02/disposition=6-5-4-3-2-0/b0.csv"
    breaks = has_breaks(spark, lake, by_hand=False)
    assert breaks is False
    sales = lots.read_filed_sales(spark, f"{lake}/raw/ventes", breaks)
    assert {(r.id_vente, r.id_client, r.quantite, r.id_magasin, r.date_vente) for r in sales.collect()} == {
        (f"V{i}", f"C{i}", str(i), "M1", "2026-01-01") for i in range(300)}
    plan = sales._jdf.queryExecution().toString()
    assert plan.count("FileScan csv") == 2 and "a1.csv" not in plan and "b0.csv" not in plan and "Join" not in plan


def test_lots_that_came_by_hand(spark, tmp_path):
    put(tmp_path / "raw/ventes/a.csv", sales_csv("V1,2026-01-01,C1,P1,M1,1", bom=True, header="id_vente, date_vente,id_client,id_produit,id_magasin,quantite"))
    assert [r.id_vente for r in lots.read_filed_sales(spark, f"{tmp_path}/raw/ventes").collect()] == ["V1"]
    put(tmp_path / "raw/ventes/b.csv", sales_csv("1,V2,2026-01-01,C1,P1,M1", header="quantite,id_vente,date_vente,id_client,id_produit,id_magasin"))
    with pytest.raises(Exception, match="not filed by the ingestion"):
        lots.read_filed_sales(spark, f"{tmp_path}/raw/ventes").collect()
    assert {r.id_vente for r in lots.read_sales(spark, f"{tmp_path}/raw/ventes").collect()} == {"V1", "V2"}


@pytest.mark.parametrize("breaks", [True, False])
def test_large_lots_are_split_without_breaks(spark, tmp_path, breaks):
    put(tmp_path / "a.csv", sales_csv(*(f"V{i},2026-01-01,C1,P1,M1,1" for i in range(60_000))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = lots.read_filed_sales(spark, str(tmp_path), breaks)
        assert rows.count() == 60_000
        assert rows.where("id_vente = 'id_vente'").isEmpty()
        assert (rows.rdd.getNumPartitions() > 4) is not breaks
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
