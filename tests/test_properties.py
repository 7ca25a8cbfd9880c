"""Properties that hold for any rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from comptoir.operators import cleaning, enrichment
from comptoir.operators.profiling import source_profile
from comptoir.operators.revenue import revenue_by

FIELDS = "id_vente string, date_vente string, id_client string, id_produit string, id_magasin string, quantite string"
ORIGIN = ", _fichier_source string, _ingest_date string"
key = st.sampled_from(["1", "2", " 1", "1 ", "a", "A", "", None])
date = st.sampled_from(["2026-03-01", "2026-02-30", "2026-3-1", " 2026-03-01 ", "", None])
quantity = st.sampled_from(["1", "2.0", "-1", "0", "2.5", "x", "", " 3 ", "1e1", "99999999999", None])
sales_rows = st.lists(st.tuples(key, date, key, key, key, quantity, st.sampled_from("ab"), st.sampled_from("12")),
                      max_size=25)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def dimensions(spark):
    return (
        spark.createDataFrame([("1", "a", "b", "c"), ("A", None, None, None)],
                              "id_client string, nom_client string, ville_client string, segment string"),
        spark.createDataFrame([("1", "a", "b", 1.5), ("2", "a", "c", None)],
                              "id_produit string, nom_produit string, categorie string, prix_unitaire double"),
        spark.createDataFrame([("1", "a", "b", "c"), ("2", "b", None, None)],
                              "id_magasin string, nom_magasin string, ville string, region string"))


@few
@given(sales_rows)
def test_cleaned_sales_split_into_usable_and_rejected(spark, rows):
    sales = cleaning.clean_sales(spark.createDataFrame(rows, FIELDS + ORIGIN)).cache()
    ids = [None if r.id_vente is None else r.id_vente.upper() for r in sales.collect()]
    expected = {None if r[0] is None else r[0].strip(" ").upper() for r in rows}
    assert len(ids) == len(expected) and set(ids) == expected
    matched = enrichment.match_sales(sales, *dimensions(spark))
    usable, rejected = enrichment.usable_sales(matched), enrichment.rejected_sales(matched)
    assert usable.count() + rejected.count() == len(ids)
    assert sum(r.quantite_totale for r in revenue_by(usable, "ville").collect()) == sum(
        r.quantite for r in usable.collect())
    sales.unpersist()


@few
@given(sales_rows)
def test_cleaning_again_changes_nothing(spark, rows):
    once = cleaning.type_sales(spark.createDataFrame(rows, FIELDS + ORIGIN))
    text = once.selectExpr("id_vente", "CAST(date_vente AS string) AS date_vente", "id_client", "id_produit",
                           "id_magasin", "CAST(quantite AS string) AS quantite")
    again = cleaning.type_sales(text)
    columns = ["id_vente", "date_vente", "id_client", "id_produit", "id_magasin", "quantite"]
    assert sorted(map(repr, once.select(columns).collect())) == sorted(map(repr, again.select(columns).collect()))


@few
@given(sales_rows)
def test_profile_counts(spark, rows):
    found = source_profile("ventes", spark.createDataFrame(rows, FIELDS + ORIGIN), "id_vente").collect()
    for position, column in enumerate(found):
        blank = sum(1 for r in rows if r[position] is None or not r[position].strip(" "))
        assert (column.lignes, column.doublons, column.doublons_cle, column.manquants) == (
            len(rows), len(rows) - len(set(rows)), len(rows) - len({r[0] for r in rows}), blank)
