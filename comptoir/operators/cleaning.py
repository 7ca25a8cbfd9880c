"""Raw text rows to typed, standardised rows. Nothing is dropped: defects become labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir import schemas as S
from comptoir.functions import (
    blank,
    city_standard,
    identifier,
    joined_labels,
    strict_date,
    whole_number,
)
from comptoir.operators.versions import drop_duplicate_keys, latest_version


def type_sales(rows: DataFrame) -> DataFrame:
    """Typed columns next to the date as it was written. The sale id keeps its case."""
    columns = {
        "id_vente": F.trim("id_vente"),
        "date_vente": strict_date(F.trim("date_vente")),
        "date_vente_source": F.col("date_vente"),
        "id_client": identifier("id_client"),
        "id_produit": identifier("id_produit"),
        "id_magasin": identifier("id_magasin"),
        "quantite": whole_number(F.col("quantite")),
    }
    if S.INGEST_DATE in rows.columns:
        columns["ingest_date"] = F.col(S.INGEST_DATE)
    return rows.select(*[value.alias(name) for name, value in columns.items()])


def label_sales(sales: DataFrame) -> DataFrame:
    written, parsed, quantity = (F.col(c) for c in ("date_vente_source", "date_vente", "quantite"))
    return sales.withColumn("anomalies", joined_labels([
        (written.isNull(), S.DATE_MISSING),
        (written.isNotNull() & parsed.isNull(), S.DATE_INVALID),
        (quantity.isNull(), S.QUANTITY_MISSING),
        (quantity == 0, S.QUANTITY_ZERO),
        (quantity < 0, S.QUANTITY_NEGATIVE),
    ]))


def clean_sales(rows: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    return label_sales(type_sales(latest_version(rows, "id_vente", ties)))


def type_customers(rows: DataFrame) -> DataFrame:
    segment = F.initcap(F.trim("segment"))
    return rows.select(
        identifier("id_client").alias("id_client"),
        F.trim("nom").alias("nom_client"),
        city_standard(F.col("ville")).alias("ville_client"),
        F.coalesce(segment, F.lit(S.SEGMENT_DEFAULT)).alias("segment"))


def type_products(rows: DataFrame) -> DataFrame:
    category = F.col("categorie")
    known = category.isNotNull() & ~blank(category)
    return rows.select(
        identifier("id_produit").alias("id_produit"),
        F.trim("nom_produit").alias("nom_produit"),
        F.when(known, F.trim(category)).otherwise(S.CATEGORY_DEFAULT).alias("categorie"),
        F.col("prix_unitaire").try_cast("double").alias("prix_unitaire"))


def type_stores(rows: DataFrame) -> DataFrame:
    return rows.select(
        identifier("id_magasin").alias("id_magasin"),
        F.trim("nom_magasin").alias("nom_magasin"),
        city_standard(F.col("ville")).alias("ville"),
        F.trim("region").alias("region"))


# A dimension is unique by identifier once it is versioned: versions are grouped by exactly the
# identifier that is output, so a second de-duplication would only add a shuffle.

def clean_customers(rows: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    return type_customers(latest_version(rows, "id_client", ties))


def clean_products(rows: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    return type_products(latest_version(rows, "id_produit", ties))


def clean_stores(rows: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    return type_stores(latest_version(rows, "id_magasin", ties))


CLEANERS = {
    "ventes": clean_sales,
    "clients": clean_customers,
    "produits": clean_products,
    "magasins": clean_stores,
}

# Cleaning of a deposit without lots, where any one of the rows of a key will do. Sales are
# compared by the id as it is written, dimensions by the cleaned one.
SINGLE_DEPOSIT_CLEANERS = {
    "ventes": lambda rows: label_sales(type_sales(drop_duplicate_keys(rows, "id_vente"))),
    "clients": lambda rows: drop_duplicate_keys(type_customers(rows), "id_client"),
    "produits": lambda rows: drop_duplicate_keys(type_products(rows), "id_produit"),
    "magasins": lambda rows: drop_duplicate_keys(type_stores(rows), "id_magasin"),
}
