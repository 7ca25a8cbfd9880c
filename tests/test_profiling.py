"""Profiling reports on small rows."""

import pytest

from comptoir.operators import profiling as P
from comptoir.plans.profiling import profile_sources


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [("V1", "2026-01-01", "C1", "3"), ("V1", "2026-01-01", "C1", "3"), ("V1", "2026-13-01", "C9", " "),
         (None, None, None, "2.5"), (None, "", "C9", "-1"), ("V4", "2026-1-1", "c1", "1e30"),
         ("V5", "2026-01-05", "C1", "NaN")],
        "id_vente string, date_vente string, id_client string, quantite string")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("C1", " PARIS", "a"), ("C2", "Paris", None), ("C1", " PARIS", "a"),
                                  ("C3", None, "a")],
                                 "id_client string, ville string, segment string")


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_missing_values(sales):
    assert P.missing_values(sales).first().asDict() == {
        "id_vente": 2, "date_vente": 2, "id_client": 1, "quantite": 1}


def test_duplicates(sales):
    assert rows(P.exact_duplicates(sales)) == [(7, 6, 1)]
    assert rows(P.key_duplicates(sales, "id_vente")) == [(7, 4, 3)]  # null is one key
    assert rows(P.repeated_keys(sales, "id_vente")) == [("V1", 3), (None, 2)]
    assert [r.id_vente for r in P.duplicate_rows(sales, "id_vente").collect()] == ["V1"] * 3


def test_orphans(sales, customers):
    assert rows(P.orphan_keys(sales, customers, "id_client")) == [("C9", 2), ("c1", 1), (None, 1)]
    assert P.orphan_sales(sales, customers, "id_client").count() == 4


def test_suspicious_values(spark, sales):
    assert [r.date_vente for r in P.invalid_dates(sales).collect()] == ["2026-13-01", None, "", "2026-1-1"]
    assert [r.quantite for r in P.suspicious_quantities(sales).collect()] == [" ", "2.5", "-1", "1e30", "NaN"]
    products = spark.createDataFrame([("P1", "1.5"), ("P2", "0"), ("P3", "abc"), ("P4", None), ("P5", "-2")],
                                     "id_produit string, prix_unitaire string")
    assert [r.id_produit for r in P.suspicious_prices(products).collect()] == ["P2", "P3", "P4", "P5"]


def test_city_drift_is_distinct(customers):
    assert [tuple(r) for r in P.city_drift("clients", customers).collect()] == [
        ("clients", None, None, None), ("clients", " PARIS", 6, True), ("clients", "Paris", 5, False)]


def test_source_profile(sales):
    found = {r.colonne: r for r in P.source_profile("ventes", sales, "id_vente").collect()}
    assert {c: r.manquants for c, r in found.items()} == P.missing_values(sales).first().asDict()
    any_row = found["quantite"]
    assert (any_row.lignes, any_row.doublons, any_row.cle, any_row.doublons_cle, any_row.type) == (
        7, 1, "id_vente", 3, "string")


def test_profile_of_an_empty_source(sales):
    found = P.source_profile("ventes", sales.limit(0), "id_vente").collect()
    assert [(r.lignes, r.doublons, r.doublons_cle, r.manquants) for r in found] == [(0, 0, 0, 0)] * 4


def test_every_report_of_the_profile(spark, customers):
    raw = {
        "ventes": spark.createDataFrame([("V1", "x", "C9", "P1", "M1", "0")],
                                        "id_vente string, date_vente string, id_client string, "
                                        "id_produit string, id_magasin string, quantite string"),
        "clients": customers,
        "produits": spark.createDataFrame([("P1", "a", "b", "0")], "id_produit string, nom_produit string, "
                                          "categorie string, prix_unitaire string"),
        "magasins": spark.createDataFrame([("M1", "a", "nice", "b")], "id_magasin string, nom_magasin string, "
                                          "ville string, region string"),
    }
    counts = {name: report.count() for name, report in profile_sources(raw).items()}
    assert counts == {"profil": 17, "dates": 1, "quantites": 1, "doublons": 0, "villes": 4, "segments": 2,
                      "categories": 1, "prix": 1, "orphelins_clients": 1, "orphelins_produits": 0,
                      "orphelins_magasins": 0}
