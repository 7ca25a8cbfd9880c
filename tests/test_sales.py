"""Cleaning, versions, enrichment and revenue on small dirty rows."""

import random

import pytest

from comptoir.operators import cleaning, enrichment, versions
from comptoir.operators.revenue import revenue_by

RAW_SALES = ("id_vente string, date_vente string, id_client string, id_produit string, "
             "id_magasin string, quantite string, _fichier_source string, _ingest_date string")
CLEAN_SALES = ("id_vente string, date_vente date, date_vente_source string, id_client string, "
               "id_produit string, id_magasin string, quantite int, ingest_date string, anomalies string")


def sale(id_vente="V1", date="2026-03-01", client="C1", product="P1", store="M1", quantity="2",
         file="a.csv", day="1970-01-01"):
    return (id_vente, date, client, product, store, quantity, file, day)


def cleaned(spark, *rows):
    frame = cleaning.clean_sales(spark.createDataFrame(list(rows), RAW_SALES))
    return {row.id_vente: row for row in frame.collect()}


def test_newest_lot_wins_with_its_nulls(spark):
    rows = cleaned(spark,
                   sale("v1 ", quantity="9", day="2026-10-02"),
                   sale("V1", quantity="1", day="2026-10-01"),
                   sale("V2", quantity="1", file="a.csv"), sale("V2", quantity=None, file="b.csv"))
    assert rows["v1"].quantite == 9  # output keeps the case, the comparison ignores it
    assert rows["V2"].quantite is None


def test_rows_without_id_are_one_group(spark):
    rows = cleaned(spark, sale(None, day="2026-10-01"), sale(None, day="2026-10-02"), sale("V1"))
    assert set(rows) == {None, "V1"}
    assert rows[None].ingest_date == "2026-10-02"


def test_latest_version_ignores_row_order(spark):
    rows = [sale(f"V{i % 20}", quantity=str(i % 7), client=f"C{i % 5}") for i in range(400)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, RAW_SALES).repartition(5)
        found.add(tuple(sorted(map(tuple, versions.latest_version(frame, "id_vente").collect()))))
    assert len(found) == 1


def test_drop_duplicate_keys_compares_as_written(spark):
    frame = spark.createDataFrame([sale(" V1"), sale("V1"), sale("V1")], RAW_SALES)
    kept = versions.drop_duplicate_keys(frame, "id_vente")
    assert sorted(r.id_vente for r in kept.collect()) == [" V1", "V1"]


def test_cleaning_without_origin_columns(spark):
    frame = spark.createDataFrame([sale()], RAW_SALES).drop("_fichier_source", "_ingest_date")
    typed = cleaning.label_sales(cleaning.type_sales(frame))
    assert "ingest_date" not in typed.columns and typed.first().quantite == 2


@pytest.mark.parametrize("row, labels", [
    (sale(), None),
    (sale(date=None), "date absente"),
    (sale(date="  "), "date invalide"),
    (sale(date="2026-02-30"), "date invalide"),
    (sale(quantity="10000000000"), "quantite absente"),
    (sale(date=None, quantity="x"), "date absente, quantite absente"),
    (sale(quantity="0.0"), "quantite nulle"),
    (sale(date="1/2/26", quantity="-3"), "date invalide, quantite negative"),
])
def test_sales_labels(spark, row, labels):
    assert cleaned(spark, row)["V1"].anomalies == labels


def test_dimension_defaults(spark):
    origin = ", _fichier_source string, _ingest_date string"
    customers = spark.createDataFrame(
        [(" c1", " Ada ", " PARIS", None, "f", "1"), ("C2", None, "", "", "f", "1"),
         ("C3", "x", None, "grand COMPTE", "f", "1"), ("c3", "y", "lyon", "b", "f", "2")],
        "id_client string, nom string, ville string, segment string" + origin)
    assert sorted(map(tuple, cleaning.clean_customers(customers).collect())) == [
        ("C1", "Ada", "Paris", "Non renseigné"), ("C2", None, None, ""), ("C3", "y", "Lyon", "B")]
    products = spark.createDataFrame(
        [("p1", "a", "", "1.5", "f", "1"), ("P2", "b", None, "abc", "f", "1"),
         ("P3", "c", " Audio ", "-1", "f", "1")],
        "id_produit string, nom_produit string, categorie string, prix_unitaire string" + origin)
    assert sorted(map(tuple, cleaning.clean_products(products).collect())) == [
        ("P1", "a", "Non renseignée", 1.5), ("P2", "b", "Non renseignée", None), ("P3", "c", "Audio", -1.0)]
    stores = spark.createDataFrame(
        [(" m1 ", " Halles ", "  ", " Sud ", "f", "1")],
        "id_magasin string, nom_magasin string, ville string, region string" + origin)
    assert list(map(tuple, cleaning.clean_stores(stores).collect())) == [("M1", "Halles", None, "Sud")]


@pytest.fixture(scope="module")
def dimensions(spark):
    return (
        spark.createDataFrame([("C1", "Ada", "Paris", "Pro"), ("C2", None, None, None)],
                              "id_client string, nom_client string, ville_client string, segment string"),
        spark.createDataFrame([("P1", "Clavier", "Info", 10.0), ("P2", "Rare", "Info", None)],
                              "id_produit string, nom_produit string, categorie string, prix_unitaire double"),
        spark.createDataFrame([("M1", "Halles", "Lyon", "Sud"), ("M2", "Gare", None, None)],
                              "id_magasin string, nom_magasin string, ville string, region string"))


def matched(spark, dimensions, *rows):
    return enrichment.match_sales(spark.createDataFrame(list(rows), CLEAN_SALES), *dimensions)


def clean(id_vente, client="C1", product="P1", store="M1", quantity=2, labels=None):
    return (id_vente, None, None, client, product, store, quantity, "1970-01-01", labels)


def test_unknown_references(spark, dimensions):
    rows = {r.id_vente: r for r in matched(
        spark, dimensions, clean("ok"), clean("c", client="C9"), clean("nameless", client="C2"),
        clean("s", store=None), clean("cityless", store="M2"),
        clean("p", product="P9", labels="date absente")).collect()}
    assert rows["ok"].anomalies is None and rows["ok"].montant == 20.0
    assert (rows["c"].nom_client, rows["c"].segment, rows["c"].anomalies) == (
        "Client inconnu", "Inconnu", "client inconnu")
    assert rows["c"].ville_client is None
    assert (rows["nameless"].anomalies, rows["nameless"].segment) == ("client inconnu", "Inconnu")
    assert (rows["s"].nom_magasin, rows["s"].ville, rows["s"].region, rows["s"].anomalies) == (
        "Magasin inconnu", "Inconnue", "Inconnue", "magasin inconnu")
    assert (rows["cityless"].ville, rows["cityless"].region, rows["cityless"].anomalies) == (
        "Inconnue", "Inconnue", None)
    assert rows["p"].anomalies == "date absente, produit inconnu" and rows["p"].categorie is None


def test_usable_and_rejected_split_all_sales(spark, dimensions):
    everything = matched(
        spark, dimensions, clean("ok", labels="date absente"), clean("zero", quantity=0),
        clean("none", quantity=None), clean("minus", quantity=-1), clean("price", product="P2"),
        clean("unknown", product="P9"), clean("price", product="P2"))
    usable = enrichment.usable_sales(everything)
    assert usable.columns[:3] == ["id_vente", "date_vente", "id_client"] and len(usable.columns) == 17
    assert [r.id_vente for r in usable.collect()] == ["ok"]
    # Equal rejected rows are kept once.
    assert sorted(r.id_vente for r in enrichment.rejected_sales(everything).collect()) == [
        "minus", "none", "price", "unknown", "zero"]


def test_revenue_counts_ids_and_keeps_the_null_key(spark):
    sales = spark.createDataFrame(
        [("V1", "Lyon", 2, 20.0), (None, "Lyon", 1, 0.1), ("V3", None, 5, 50.05), ("V4", "Nice", 1, 1.0)],
        "id_vente string, ville string, quantite int, montant double")
    assert list(map(tuple, revenue_by(sales, "ville").collect())) == [
        (None, 1, 5, 50.05), ("Lyon", 1, 3, 20.1), ("Nice", 1, 1, 1.0)]
