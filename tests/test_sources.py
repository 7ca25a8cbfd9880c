"""Readers of the raw zone."""

import io

import pytest
from lake_files import customers_json, products_xml, put, sales_csv, stores_xlsx, workbook_of

from comptoir.sources import lots
from comptoir.sources.inventory import data_line_counts, lake_inventory, list_objects, text_preview
from comptoir.sources.workbook import sheet_rows, workbook_rows

FIELDS = ["id_vente", "date_vente", "id_client", "id_produit", "id_magasin", "quantite"]
NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def by_id(frame, key):
    return {row[key]: row for row in frame.collect()}


def test_sales_lots_are_read_by_column_name(spark, tmp_path):
    put(tmp_path / "ventes.csv", sales_csv("V1,2026-01-01,C1,P1,M1,3.0", bom=True))
    put(tmp_path / "ingest_date=2026-10-02/b.csv", sales_csv("V2,2026-01-02,C2,P2,M2,", bom=True))
    put(tmp_path / "ingest_date=2026-10-04/d e.csv", sales_csv(header="quantite,id_vente") + "7,V5\n")
    put(tmp_path / "empty.csv", "")
    put(tmp_path / "ingest_date=2026-10-03/c [1]{x}*.csv",
        sales_csv("4,V3,x,M3,C3,P3,2026-01-03", "5,V4,x,M4,C4,P4,",
                  header=" quantite,id_vente,extra,id_magasin,id_client,id_produit ,date_vente"))
    put(tmp_path / "ignored.txt", "not a lot")
    rows = by_id(lots.read_sales(spark, str(tmp_path)), "id_vente")
    assert [list(rows[v][f] for f in FIELDS) for v in sorted(rows)] == [
        ["V1", "2026-01-01", "C1", "P1", "M1", "3.0"],
        ["V2", "2026-01-02", "C2", "P2", "M2", None],
        ["V3", "2026-01-03", "C3", "P3", "M3", "4"],
        ["V4", None, "C4", "P4", "M4", "5"],
        ["V5", None, None, None, None, "7"]]
    assert [rows[v]["_ingest_date"] for v in sorted(rows)] == [
        "1970-01-01", "2026-10-02", "2026-10-03", "2026-10-03", "2026-10-04"]
    assert rows["V2"]["_fichier_source"].endswith("ingest_date=2026-10-02/b.csv")


def test_sales_by_position_accept_one_layout_only(spark, tmp_path):
    put(tmp_path / "a.csv", sales_csv("V1,2026-01-01,C1,P1,M1,1", bom=True))
    assert lots.read_sales(spark, str(tmp_path), by_name=False).first().id_magasin == "M1"
    put(tmp_path / "b.csv", sales_csv("1,2,3,4,5,6", header="quantite,date_vente,id_client,id_produit,id_magasin,id_vente"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        lots.read_sales(spark, str(tmp_path), by_name=False).collect()


def test_customers_without_a_column_anywhere(spark, tmp_path):
    put(tmp_path / "a.json", '[{"id_client": "C1", "nom": "Ada", "ville": null}, {"id_client": "C2"}]')
    rows = by_id(lots.read_customers(spark, str(tmp_path)), "id_client")
    assert rows["C1"].nom == "Ada" and rows["C1"].segment is None and rows["C2"].nom is None


def test_products(spark, tmp_path):
    put(tmp_path / "a.xml", products_xml(("P1", "a &amp; b", "", "1.5")))
    put(tmp_path / "ingest_date=2026-10-02/b.xml", products_xml(("P2", "c", "d", "x")))
    rows = by_id(lots.read_products(spark, str(tmp_path)), "id_produit")
    assert rows["P1"].nom_produit == "a & b" and rows["P1"].categorie == ""
    assert rows["P2"].prix_unitaire == "x" and rows["P2"]["_ingest_date"] == "2026-10-02"


def test_stores(spark, tmp_path):
    put(tmp_path / "a.xlsx", stores_xlsx(("M1", "Halles", "N/A", 75), (None,) * 4, ("M2", " Gare ", None, 7.5),
                                         (None, "", None, None)))
    put(tmp_path / "ingest_date=2026-10-02/b.XLSX", stores_xlsx(("M3", "Port", "Nice", "Sud")))
    rows = by_id(lots.read_stores(spark, str(tmp_path)), "id_magasin")
    # A blank row between others stays, trailing ones do not.
    assert set(rows) == {"M1", None, "M2", "M3"}
    assert rows["M1"].ville is None and rows["M1"].region == "75"
    assert rows["M2"].nom_magasin == " Gare " and rows["M2"].region == "7.5"
    assert rows["M3"]["_ingest_date"] == "2026-10-02"


def test_workbook_cell_kinds():
    sheet = (f'<worksheet {NS}><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
             '<row r="3"><c r="A3" t="b"><v>1</v></c><c r="B3"><v>3.0</v></c><c r="C3"><v>2.25</v></c>'
             '<c r="AA3" t="str"><f>A1</f><v>calc</v></c></row></sheetData></worksheet>')
    shared = (f'<sst {NS}><si><t>simple</t></si>'
              '<si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>')
    rows = list(sheet_rows(io.BytesIO(workbook_of(
        {"xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": shared}))))
    assert rows[0] == ["simple", None, "rich"]
    assert rows[1] == []
    assert rows[2][:3] == ["True", "3", "2.25"] and rows[2][26] == "calc"


def test_many_workbook_rows_come_in_batches(spark):
    content = stores_xlsx(*[(f"M{i}", "n", "v", "r") for i in range(25_000)])
    files = spark.createDataFrame([("a.xlsx", content)], "path string, content binary")
    assert workbook_rows(files).select("id_magasin").distinct().count() == 25_000


def test_all_sources_by_name(spark, tmp_path):
    put(tmp_path / "ventes/a.csv", sales_csv("V1,2026-01-01,C1,P1,M1,1"))
    put(tmp_path / "clients/a.json", customers_json(("C1", "Ada", "Lyon", "Pro")))
    put(tmp_path / "produits/a.xml", products_xml(("P1", "a", "b", "1")))
    put(tmp_path / "magasins/a.xlsx", stores_xlsx(("M1", "a", "b", "c")))
    raw = lots.read_raw(spark, str(tmp_path))
    assert {name: rows.count() for name, rows in raw.items()} == dict.fromkeys(
        ["ventes", "clients", "produits", "magasins"], 1)
    assert all({"_fichier_source", "_ingest_date"} <= set(rows.columns) for rows in raw.values())


def test_inventory(spark, tmp_path):
    put(tmp_path / "raw/ventes/a.csv", "12345")
    put(tmp_path / "raw/ventes/ingest_date=2026-10-02/b.csv", "123")
    put(tmp_path / "raw/notes.txt", "1")
    put(tmp_path / "curated/ca/part 0.parquet", "12")
    put(tmp_path / "curated/ca/_SUCCESS", "")
    put(tmp_path / "_ingestion/manifest.json", "{}")
    put(tmp_path / "raw/ventes/.a.csv.crc", "x")
    objects = list_objects(spark, str(tmp_path))
    assert {r.cle for r in objects.collect()} == {
        "raw/ventes/a.csv", "raw/ventes/ingest_date=2026-10-02/b.csv", "raw/notes.txt", "curated/ca/part 0.parquet",
        "curated/ca/_SUCCESS", "_ingestion/manifest.json"}
    assert [tuple(r) for r in lake_inventory(objects).collect()] == [
        ("_ingestion", "(racine)", 1, 2), ("curated", "ca", 2, 2), ("raw", "(racine)", 1, 1), ("raw", "ventes", 2, 8)]


def test_text_preview(spark, tmp_path):
    path = str(put(tmp_path / "a.csv", "h\n" + "x\n" * 9))
    assert [r.value for r in text_preview(spark, path).collect()] == ["h", "x", "x", "x", "x"]
    put(tmp_path / "deep/b.csv", "h\n")
    assert {r.fichier.rsplit("/", 1)[-1]: r.lignes for r in data_line_counts(spark, str(tmp_path)).collect()} == {
        "a.csv": 9, "b.csv": 0}
