"""What is wrong with a source, before anything is corrected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions import missing, strict_date
from comptoir.operators.joins import lookup


def missing_values(rows: DataFrame) -> DataFrame:
    """One row: per column the number of null or blank values."""
    return rows.agg(*[
        F.count_if(missing(name, data_type)).alias(name) for name, data_type in rows.dtypes])


def exact_duplicates(rows: DataFrame) -> DataFrame:
    """Rows in total, distinct rows and the surplus, from one scan."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return _surplus(counted, "lignes_distinctes", "doublons")


def key_duplicates(rows: DataFrame, key: str) -> DataFrame:
    """Rows in total, distinct keys (null is one of them) and the surplus."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    return _surplus(counted, "cles_distinctes", "doublons_cle")


def _surplus(counted: DataFrame, distinct_name: str, surplus_name: str) -> DataFrame:
    total = F.coalesce(F.sum("_copies"), F.lit(0))
    return counted.agg(
        total.alias("lignes"),
        F.count(F.lit(1)).alias(distinct_name),
        (total - F.count(F.lit(1))).alias(surplus_name))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys found more than once, with their number of rows; null is a key here."""
    return rows.groupBy(key).count().where(F.col("count") > 1)


def duplicate_rows(rows: DataFrame, key: str) -> DataFrame:
    """Every row whose key is repeated, with the number of rows of that key.

    Joined rather than counted in a window: a window would bring all rows of a hot key into one
    task, whereas the join can split them.
    """
    return lookup(rows, repeated_keys(rows.where(F.col(key).isNotNull()), key), key, "inner")


def orphan_sales(sales: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Sales whose key is not in the reference table; a sale without key is one."""
    return lookup(sales, reference.select(key).distinct(), key, "left_anti")


def orphan_keys(sales: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """The unknown keys and their number of sales.

    Sales are counted per key before the join, so the join sees each key once.
    """
    counted = sales.groupBy(key).agg(F.count(F.lit(1)).alias("nb_ventes"))
    return counted.join(reference.select(key).distinct(), key, "left_anti")


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("nombre"))


def invalid_dates(sales: DataFrame) -> DataFrame:
    """Sales whose date is missing or not written yyyy-MM-dd."""
    return sales.where(strict_date(F.col("date_vente")).isNull()).select("id_vente", "date_vente")


def suspicious_quantities(sales: DataFrame) -> DataFrame:
    """Sales whose quantity is missing, not a number, not positive or not whole."""
    number = F.col("quantite").try_cast("double")
    sound = (number > 0) & (number == F.floor(number))
    return sales.where(~F.coalesce(sound, F.lit(False))).select("id_vente", "quantite")


def suspicious_prices(products: DataFrame) -> DataFrame:
    price = F.col("prix_unitaire").try_cast("double")
    return (products.where(~F.coalesce(price > 0, F.lit(False)))
            .select("id_produit", "prix_unitaire"))


def city_drift(source: str, rows: DataFrame) -> DataFrame:
    """Spellings of cities: length and whether standardising would change them."""
    city = F.col("ville")
    return rows.select(
        F.lit(source).alias("source"),
        "ville",
        F.length(city).alias("longueur"),
        (F.initcap(F.trim(city)) != city).alias("a_standardiser")).distinct().orderBy("ville")


def source_file_count(rows: DataFrame, column: str) -> DataFrame:
    files = rows.select(column).distinct()
    return files.agg(F.count(F.lit(1)).alias("nb_fichiers"))


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("lignes"))


def preview(rows: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first n rows in a given order: a top-n, never a sort of the whole table."""
    return rows.orderBy(*order).limit(n)


def source_profile(source: str, rows: DataFrame, key: str) -> DataFrame:
    """Per column of a source: type, missing values, and the source's row and duplicate counts.

    One scan. Equal rows are folded into one with a count, those fold into one row per key, and
    the totals follow: both steps combine on the map side, so neither many copies of a row nor a
    hot key gathers anywhere.
    """
    gaps = {name: f"_vide_{i}" for i, name in enumerate(rows.columns)}
    distinct_rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = distinct_rows.groupBy(F.col(key).alias("_cle")).agg(
        F.sum("_copies").alias("_copies"),
        F.count(F.lit(1)).alias("_distinctes"),
        *[F.sum(F.when(missing(name, data_type), F.col("_copies")).otherwise(0)).alias(gaps[name])
          for name, data_type in rows.dtypes])
    totals = per_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("lignes"),
        F.coalesce(F.sum("_distinctes"), F.lit(0)).alias("_distinctes"),
        F.count(F.lit(1)).alias("_cles"),
        *[F.coalesce(F.sum(gap), F.lit(0)).alias(gap) for gap in gaps.values()])
    columns = F.array(*[
        F.struct(F.lit(name).alias("colonne"), F.lit(data_type).alias("type"),
                 F.col(gaps[name]).alias("manquants"))
        for name, data_type in rows.dtypes])
    return totals.select(
        F.lit(source).alias("source"),
        "lignes",
        (F.col("lignes") - F.col("_distinctes")).alias("doublons"),
        F.lit(key).alias("cle"),
        (F.col("lignes") - F.col("_cles")).alias("doublons_cle"),
        F.inline(columns))
