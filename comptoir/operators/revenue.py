"""Revenue per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions import total_amount

MEASURES = ["nb_ventes", "quantite_totale", "chiffre_affaires"]


def revenue_measures() -> list:
    return [
        F.count("id_vente").alias("nb_ventes"),
        F.sum("quantite").alias("quantite_totale"),
        total_amount(F.col("montant")).alias("chiffre_affaires"),
    ]


def revenue_by(sales: DataFrame, key: str) -> DataFrame:
    """Sales, quantity and amount per key, highest amount first.

    Each task sends one row per key to the shuffle, so a key holding most of the sales costs no
    more than any other, and only the aggregated rows are sorted.
    """
    return sales.groupBy(key).agg(*revenue_measures()).orderBy(F.desc("chiffre_affaires"))


def revenue_by_axes(sales: DataFrame, axes: dict[str, str]) -> DataFrame:
    """Revenue per key of several columns, from one scan: (axe, cle) and the measures.

    ``axes`` names the column of each axis. A sale becomes one row per axis, which the map side
    aggregates at once.
    """
    keys = F.array(*[F.struct(F.lit(axis).alias("axe"), F.col(column).alias("cle"))
                     for axis, column in axes.items()])
    keyed = sales.select("id_vente", "quantite", "montant", F.inline(keys))
    return keyed.groupBy("axe", "cle").agg(*revenue_measures())


def revenue_of_axis(totals: DataFrame, axis: str, column: str) -> DataFrame:
    of_axis = totals.where(F.col("axe") == axis)
    return of_axis.select(F.col("cle").alias(column), *MEASURES).orderBy(F.desc("chiffre_affaires"))
