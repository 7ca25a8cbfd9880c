"""Sales joined with customers, products and stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir import schemas as S
from comptoir.functions import joined_labels, line_amount
from comptoir.operators.joins import lookup, unclustered


STAND_INS = {
    "nom_client": S.CUSTOMER_LABEL,
    "segment": S.UNKNOWN_MASCULINE,
    "ville": S.UNKNOWN_FEMININE,
    "region": S.UNKNOWN_FEMININE,
    "nom_magasin": S.STORE_LABEL,
}


def attach_references(sales: DataFrame, customers: DataFrame, products: DataFrame,
                      stores: DataFrame) -> DataFrame:
    """Every sale with what is known of its customer, product and store.

    Stores are the fewest, so they are met last: sent to the tasks, they do not widen the rows that are shuffled for the others.
    """
    matched = sales
    for key, dimension in (("id_produit", products), ("id_client", customers), ("id_magasin", stores)):
        matched = lookup(matched, dimension, key)
    keys = ["id_client", "id_magasin", "id_produit"]
    return matched.select(*keys, *[name for table in (sales, products, stores, customers) for name in table.columns if name not in keys])


def label_references(matched: DataFrame) -> DataFrame:
    """Append a label per reference without a name to the labels of the sale."""
    return matched.withColumn("anomalies", joined_labels([
        (F.col("nom_client").isNull(), S.CUSTOMER_UNKNOWN),
        (F.col("nom_produit").isNull(), S.PRODUCT_UNKNOWN),
        (F.col("nom_magasin").isNull(), S.STORE_UNKNOWN),
    ], before=F.col("anomalies")))


def fill_references(matched: DataFrame) -> DataFrame:
    """Stand-ins for unknown customers and stores. A product has none: its sale is rejected."""
    return matched.fillna({name: label for name, label in STAND_INS.items()
                           if name in matched.columns})


def amount() -> Column:
    return line_amount(F.col("quantite"), F.col("prix_unitaire"))


def usable() -> Column:
    """A sale counts when its quantity is positive and its price known; never null."""
    return F.coalesce(F.col("quantite") > 0, F.lit(False)) & F.col("prix_unitaire").isNotNull()


def match_sales(sales: DataFrame, customers: DataFrame, products: DataFrame,
                stores: DataFrame) -> DataFrame:
    """All sales, usable or not, labelled, filled and priced."""
    matched = fill_references(label_references(
        attach_references(sales, customers, products, stores)))
    return matched.withColumn("montant", amount())


def usable_sales(matched: DataFrame) -> DataFrame:
    return matched.where(usable()).select(*S.ENRICHED_COLUMNS)


def rejected_sales(matched: DataFrame) -> DataFrame:
    """The other sales, with rows equal in every column kept once."""
    return unclustered(matched.where(~usable())).distinct()


def enrich_sales(sales: DataFrame, customers: DataFrame, products: DataFrame,
                 stores: DataFrame) -> DataFrame:
    return usable_sales(match_sales(sales, customers, products, stores))
