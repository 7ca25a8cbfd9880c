"""Ingestion and batch end to end: a first deposit, then a lot of corrections."""

from datetime import datetime

import pytest
from lake_files import customers_json, products_xml, put, sales_csv, stores_xlsx

from comptoir.operators.cleaning import SINGLE_DEPOSIT_CLEANERS
from comptoir.plans.batch import read_enriched, read_rejected, run_all, run_batch
from comptoir.sources.lots import read_table


@pytest.fixture
def deposited(tmp_path):
    """Sources laid down by hand, before there was an ingestion."""
    raw = tmp_path / "lake/raw"
    put(raw / "ventes/ventes.csv", sales_csv(
        "V1,2026-03-23,C1,P1,M1,3.0",
        "V2,2026-02-30,C2,P1,M1,1.0",
        "V3,,c3,P2,M2,2.0",
        "V4,2026-03-01,C9,P1,M9,1",
        "V5,2026-03-01,C1,P9,M1,1",
        "V6,2026-03-01,C1,P1,M1,-2",
        "V7,2026-03-01,C1,P1,M1,",
        "V1,2026-03-23,C1,P1,M1,3.0", bom=True))
    put(raw / "clients/clients.json", customers_json(
        ("C1", "Ada", " PARIS ", "particulier"), ("C2", "Bob", "", None), ("C3", "Cy", "nantes", "")))
    put(raw / "produits/produits.xml", products_xml(("P1", "Clavier", "Info", "10.1"), ("P2", "Lampe", "", "5")))
    put(raw / "magasins/magasins.xlsx", stores_xlsx(("M1", "Halles", "lyon", "Sud"), ("M2", "Gare", None, "Nord")))
    return tmp_path


def curated(spark, root, name):
    return {row[0]: tuple(row)[1:] for row in read_table(spark, f"{root}/lake/curated/{name}").collect()}


def test_two_lots(spark, deposited):
    lake = f"{deposited}/lake"
    run_batch(spark, lake)
    sales = {r.id_vente: r for r in read_enriched(spark, lake).collect()}
    assert set(sales) == {"V1", "V2", "V3", "V4"}
    assert sales["V1"].montant == 30.3 and sales["V1"].anomalies is None and sales["V1"].ville_client == "Paris"
    assert sales["V2"].anomalies == "date invalide" and sales["V2"].segment == "Non renseigné"
    assert sales["V3"].anomalies == "date absente" and sales["V3"].ville == "Inconnue"
    assert sales["V4"].anomalies == "client inconnu, magasin inconnu"
    rejected = {r.id_vente: r.anomalies for r in read_rejected(spark, lake).collect()}
    assert rejected == {"V5": "produit inconnu", "V6": "quantite negative", "V7": "quantite absente"}
    assert curated(spark, deposited, "ca_par_ville") == {"Lyon": (2, 4, 40.4), "Inconnue": (2, 3, 20.1)}
    assert curated(spark, deposited, "ca_par_categorie") == {
        "Info": (3, 5, 50.5), "Non renseignée": (1, 2, 10.0)}

    incoming = deposited / "incoming"
    put(incoming / "ventes/v.csv", sales_csv("V8,2026-10-02,C4,P3,M1,2", "v6,2026-10-02,C1,P1,M1,2"))
    put(incoming / "clients/c.json", customers_json(("C4", "Di", "Nice", "Pro"), ("C2", "Bob", "Lyon", None)))
    put(incoming / "clients/incomplet.json", '[{"id_client": "C5", "nom": "x", "ville": "y"}]')
    put(incoming / "produits/p.xml", products_xml(("p2", "Lampe", "Accessoires", "6"), ("P3", "Casque", "Audio", "79.0")))
    intake = run_all(spark, str(incoming), lake, datetime(2026, 10, 2, 8, 30))
    assert intake.code == 1
    assert sorted(r.statut for r in intake.outcomes.collect()) == ["REJECTED", "SUCCESS", "SUCCESS", "SUCCESS"]
    sales = {r.id_vente: r for r in read_enriched(spark, lake).collect()}
    assert set(sales) == {"V1", "V2", "V3", "V4", "V8", "v6"}  # corrected, no longer rejected
    assert sales["V2"].ville_client == "Lyon"
    assert (sales["V3"].categorie, sales["V3"].montant) == ("Accessoires", 12.0)
    assert sales["V8"].nom_client == "Di" and sales["V8"].montant == 158.0
    assert curated(spark, deposited, "ca_par_categorie") == {
        "Info": (4, 7, 70.7), "Accessoires": (1, 2, 12.0), "Audio": (1, 2, 158.0)}

    before = curated(spark, deposited, "ca_par_ville")
    run_batch(spark, lake)
    assert curated(spark, deposited, "ca_par_ville") == before


def test_single_deposit(spark, deposited):
    """Without lots: any row of a key, sale ids compared as written."""
    put(deposited / "lake/raw/ventes/more.csv", sales_csv(" V1,2026-03-23,C1,P1,M1,3.0"))
    run_batch(spark, f"{deposited}/lake", cleaners=SINGLE_DEPOSIT_CLEANERS)
    assert sorted(r.id_vente for r in read_enriched(spark, f"{deposited}/lake").collect()) == [
        "V1", "V1", "V2", "V3", "V4"]
    assert read_table(spark, f"{deposited}/lake/processed/clients").count() == 3
