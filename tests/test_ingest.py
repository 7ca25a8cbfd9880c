"""Control of files and ingestion runs."""

import json
from datetime import datetime

import pytest
from lake_files import SALES_HEADER, customers_json, products_xml, put, sales_csv, stores_xlsx, workbook_of

from comptoir.operators.control import control_files
from comptoir.operators.ingestion import summary_of
from comptoir.plans.intake import ingest
from comptoir.sources.landing import landing_files

DAY_ONE = datetime(2026, 10, 2, 8, 30)
DAY_ONE_LATER = datetime(2026, 10, 2, 9, 0)
GOOD_CSV = sales_csv("V1,2026-01-01,C1,P1,M1,1", "", '"V\n2",,,,,')
GOOD_JSON = customers_json(("C1", "Ada", None, "Pro"), ("C2", "Bob", "Lyon", None))
GOOD_XML = products_xml(("P1", "a", "", "1"), ("P2", "", "", ""))
GOOD_XLSX = stores_xlsx(("M1", "a", "b", "c"))

CONTROL_CASES = [
    ("ventes", "good.csv", GOOD_CSV, None, 3),
    ("ventes", "bom.CSV", "﻿" + GOOD_CSV.replace("quantite", " quantite "), None, 3),
    ("ventes", "extra.csv", sales_csv("1,2,3,4,5,6,7", header=SALES_HEADER + ",autre"), None, 1),
    ("ventes", "other.txt", GOOD_CSV, "extension .txt inattendue pour ventes (attendu : .csv)", None),
    ("ventes", "none", GOOD_CSV, "extension (aucune) inattendue pour ventes (attendu : .csv)", None),
    ("clients", "Upper.XML", GOOD_XML, "extension .XML inattendue pour clients (attendu : .json)", None),
    ("ventes", "empty.csv", "", "fichier vide", None),
    ("ventes", "blank.csv", " \r\n\t\n", "fichier vide", None),
    ("ventes", "header.csv", SALES_HEADER + "\n", "aucune ligne de données", 0),
    ("ventes", "fields.csv", "id_vente,quantite\n", "champs obligatoires absents : "
     "date_vente, id_client, id_magasin, id_produit", 0),
    ("ventes", "latin.csv", SALES_HEADER.encode() + b"\nV\xe9", "fichier corrompu ou format illisible "
     "(UnicodeDecodeError: 'utf-8' codec can't decode byte 0xe9 in position 62: unexpected end of data)", None),
    ("ventes", "bom_only.csv", b"\xef\xbb\xbf", "aucune ligne d'en-tête", None),
    ("clients", "good.json", GOOD_JSON, None, 2),
    ("clients", "union.json", json.dumps([{"id_client": 1, "nom": None}, 5, {"ville": 1, "segment": {}}]),
     "JSON inattendu : une liste d'objets est attendue", None),
    ("clients", "object.json", '{"id_client": 1}', "JSON inattendu : une liste d'objets est attendue", None),
    ("clients", "list.json", "[]", "JSON inattendu : une liste d'objets est attendue", None),
    ("clients", "numbers.json", "[1, {}]", "JSON inattendu : une liste d'objets est attendue", None),
    ("clients", "broken.json", '[{"id_client": 1}, {', "fichier corrompu ou format illisible (JSONDecodeError: ", None),
    ("clients", "trailing.json", GOOD_JSON + " x", "fichier corrompu ou format illisible (JSONDecodeError: ", None),
    ("clients", "lacking.json", '[{"id_client": "C1", "nom": "x", "ville": "y"}]',
     "champs obligatoires absents : segment", 1),
    ("produits", "good.xml", GOOD_XML, None, 2),
    ("produits", "first.xml", "<p><produit><id_produit/></produit>" + GOOD_XML.split("<produits>")[1].replace(
        "</produits>", "</p>"), "champs obligatoires absents : categorie, nom_produit, prix_unitaire", 3),
    ("produits", "none.xml", "<produits/>", "XML sans enregistrement", None),
    ("produits", "broken.xml", "<produits><a>", "fichier corrompu ou format illisible (ParseError: ", None),
    ("magasins", "good.xlsx", GOOD_XLSX, None, 1),
    ("magasins", "text.xlsx", "no zip", "fichier corrompu ou format illisible (BadZipFile: File is not a zip file)", None),
    ("magasins", "parts.xlsx", workbook_of({}), "fichier corrompu ou format illisible (KeyError: ", None),
    ("magasins", "nothing.xlsx", workbook_of({"xl/worksheets/sheet1.xml": "<worksheet/>"}),
     "aucune ligne d'en-tête", None),
    ("magasins", "header.xlsx", stores_xlsx(), "aucune ligne de données", 0),
]


def test_control(spark, tmp_path):
    for source, name, content, _, _ in CONTROL_CASES:
        put(tmp_path / source / name, content)
    found = {r.fichier: r for r in control_files(landing_files(spark, str(tmp_path))).collect()}
    assert len(found) == len(CONTROL_CASES)
    for _, name, _, reason, rows in CONTROL_CASES:
        motif = found[name].motif
        if reason is None or not reason.endswith(": "):
            assert motif == reason, name
        else:
            assert motif.startswith(reason), (name, motif)
        assert found[name].lignes == rows, name


@pytest.mark.parametrize("size", [1, 3, 64, 1 << 20])
def test_damage_has_one_reason_however_it_is_read(monkeypatch, size):
    import io

    from comptoir.operators import control
    monkeypatch.setattr(control, "CHUNK", size)
    content = "é,b\n".encode() * 20 + b"x\xe9y\n"
    assert control._inspect(io.BytesIO(content), ".csv")[:3] == (None, None, (
        "fichier corrompu ou format illisible (UnicodeDecodeError: 'utf-8' codec can't decode byte 0xe9 "
        "in position 101: invalid continuation byte)"))
    fields, rows, defect, layout, breaks = control._inspect(io.BytesIO("\ufeffa,b\r\n1,\"x\ny\"\n2,é".encode()), ".csv")
    assert layout is None and breaks
    assert (fields, rows, defect) == (["a", "b"], 2, None)


def test_no_accepted_file_vanishes(spark, tmp_path):
    put(tmp_path / "in/ventes/a.csv", sales_csv("V1,2026-01-01,C1,P1,M1,1", '"V\n2",2026-01-01,"C""2",P1,M1,1'))
    put(tmp_path / "in/ventes/b.CSV", sales_csv("V3,2026-01-01,C1,P1,M1,1"))
    put(tmp_path / "in/ventes/_c.csv", sales_csv("V4,2026-01-01,C1,P1,M1,1"))
    put(tmp_path / "in/clients/k.JSON", customers_json(("C1", "Ada", "Lyon", "Pro")))
    put(tmp_path / "in/clients/mixed.json", '[{"id_client": "1", "nom": "", "ville": "", "segment": ""}, 5]')
    put(tmp_path / "in/produits/p.Xml", products_xml(("P1", "a", "b", "1")))
    taken = ingest(spark, str(tmp_path / "in"), str(tmp_path / "lake"), DAY_ONE).outcomes.where("statut = 'SUCCESS'").collect()
    assert {r.fichier for r in taken} == {"a.csv", "b.CSV", "_c.csv", "k.JSON", "p.Xml"}
    from comptoir.sources import lots
    sales = lots.read_sales(spark, str(tmp_path / "lake/raw/ventes"))
    assert {r.id_vente for r in sales.collect()} == {"V1", "V\n2", "V3", "V4"}
    assert {r.id_client for r in sales.collect()} == {"C1", 'C"2'}
    read = sales.count() + lots.read_customers(spark, str(tmp_path / "lake/raw/clients")).count()
    read += lots.read_products(spark, str(tmp_path / "lake/raw/produits")).count()
    assert read == sum(r.lignes for r in taken)


def test_runs_of_one_moment_keep_each_other(spark, tmp_path):
    for name in ("a", "b"):
        put(tmp_path / f"in/ventes/{name}.csv", sales_csv(f"{name},2026-01-01,C1,P1,M1,1"))
        last = ingest(spark, str(tmp_path / "in"), str(tmp_path / "lake"), DAY_ONE)
    assert {r.fichier for r in last.manifest.collect()} == {"a.csv", "b.csv"}
    assert last.journal.count() == 2


def test_arrow_streams_are_files(tmp_path, monkeypatch):
    """What tasks open on a shared filesystem, here Arrow's view of the local one."""
    from pyarrow import fs

    from comptoir.operators.control import _examine
    from comptoir.sources import files

    local = fs.LocalFileSystem()
    monkeypatch.setattr(files, "_locate", lambda path: (local, path))
    for source, name, content, _, rows in CONTROL_CASES:
        path = put(tmp_path / source / name, content)
        extension = path.suffix.lower() if path.suffix.lower() in (".csv", ".json", ".xml", ".xlsx") else None
        raw = path.read_bytes()
        streamed = _examine(str(path), extension, None)
        assert streamed == _examine(str(path), extension, raw), name
        assert files.copy_file(str(path), str(tmp_path / "copy")) == streamed[0]
        assert (tmp_path / "copy").read_bytes() == raw
    found = {entry[0]: entry[2] for entry in files.direct_children(str(tmp_path / "ventes"))}
    assert found["empty.csv"] == 0 and found["good.csv"] == len(GOOD_CSV.encode())
    assert list(files.direct_children(str(tmp_path / "nowhere"))) == []


def test_landing_takes_visible_direct_children_of_sources(spark, tmp_path):
    put(tmp_path / "ventes/a.csv", "x")
    for other in ("ventes/.hidden.csv", "ventes/deep/b.csv", "autre/c.csv",
                  "_archive/ventes/d.csv", "e.csv"):
        put(tmp_path / other, "x")
    assert [(r.source, r.fichier, r.taille) for r in landing_files(spark, str(tmp_path)).collect()] == [
        ("ventes", "a.csv", 1)]


def outcomes(intake):
    return {(r.source, r.fichier): r for r in intake.outcomes.collect()}


def test_ingestion_runs(spark, tmp_path):
    landing, lake = tmp_path / "incoming", tmp_path / "lake"
    put(landing / "ventes/b.csv", GOOD_CSV)
    put(landing / "ventes/a.csv", GOOD_CSV)
    put(landing / "clients/c.json", GOOD_JSON)
    put(landing / "clients/bad.json", "[]")
    first = ingest(spark, str(landing), str(lake), DAY_ONE)
    found = outcomes(first)
    assert first.code == 1
    assert {key: r.statut for key, r in found.items()} == {
        ("ventes", "a.csv"): "SUCCESS", ("ventes", "b.csv"): "DUPLICATE",
        ("clients", "c.json"): "SUCCESS", ("clients", "bad.json"): "REJECTED"}
    taken = found["ventes", "a.csv"]
    assert taken.destination == "raw/ventes/ingest_date=2026-10-02/a.csv" and taken.motif == "3 enregistrement(s)"
    assert taken.rangement == "_archive/ventes/a.csv"
    copy = found["ventes", "b.csv"]
    assert copy.destination == taken.destination
    assert copy.motif == "contenu identique déjà ingéré le 2026-10-02 08:30:00 (a.csv)"
    assert found["clients", "bad.json"].rangement == "_rejected/clients/bad.json"
    assert found["clients", "bad.json"].destination == ""
    assert (lake / taken.destination).read_text() == GOOD_CSV
    assert sorted(p.name for p in (lake / "raw").rglob("*.*")) == ["a.csv", "c.json"]
    assert {r.statut: r.fichiers for r in summary_of(first.outcomes).collect()} == {
        "SUCCESS": 2, "DUPLICATE": 1, "REJECTED": 1}

    # Nothing new: nothing is judged again.
    again = ingest(spark, str(landing), str(lake), DAY_ONE_LATER)
    assert again.code == 0 and again.outcomes.isEmpty()

    # Same name with other content, known content under another name and as a rejected file.
    put(landing / "ventes/a.csv", GOOD_CSV + "V9,,,,,\n")
    put(landing / "ventes/z.csv", GOOD_CSV)
    put(landing / "clients/bad2.json", "[]")
    second = ingest(spark, str(landing), str(lake), datetime(2026, 10, 2, 10, 0))
    found = outcomes(second)
    assert {key: r.statut for key, r in found.items()} == {
        ("ventes", "a.csv"): "SUCCESS", ("ventes", "z.csv"): "DUPLICATE", ("clients", "bad2.json"): "REJECTED"}
    renamed = found["ventes", "a.csv"]
    assert renamed.destination == f"raw/ventes/ingest_date=2026-10-02/a__{renamed.sha256[:8]}.csv"
    assert renamed.rangement == "_archive/ventes/a_20261002100000.csv"
    assert (lake / taken.destination).read_text() == GOOD_CSV
    assert (lake / renamed.destination).read_text() == GOOD_CSV + "V9,,,,,\n"
    assert found["ventes", "z.csv"].motif == "contenu identique déjà ingéré le 2026-10-02 08:30:00 (a.csv)"
    assert second.manifest.count() == 3 and second.manifest.select("sha256").distinct().count() == 3
    assert second.journal.count() == 7
    stored = spark.read.json(f"{lake}/_ingestion/journal")
    assert {"date", "source", "fichier", "destination", "taille_octets", "statut", "motif"} <= set(stored.columns)
    assert stored.count() == 7


def test_same_content_in_two_sources(spark, tmp_path):
    """The earlier source in processing order takes it, whatever the names."""
    both = ('[{"id_client": 1, "nom": 1, "ville": 1, "segment": 1}]')
    put(tmp_path / "in/clients/z.json", both)
    put(tmp_path / "in/clients/a.json", both)
    put(tmp_path / "in/ventes/0.csv", both)
    found = outcomes(ingest(spark, str(tmp_path / "in"), str(tmp_path / "lake"), DAY_ONE))
    assert found["clients", "a.json"].statut == "SUCCESS"
    assert found["clients", "z.json"].statut == "DUPLICATE"
    assert found["ventes", "0.csv"].statut == "REJECTED"


def test_prefix_is_no_collision(spark, tmp_path):
    put(tmp_path / "lake/raw/ventes/ingest_date=2026-10-02/a.csv.old", "x")
    put(tmp_path / "in/ventes/a.csv", GOOD_CSV)
    found = outcomes(ingest(spark, str(tmp_path / "in"), str(tmp_path / "lake"), DAY_ONE))
    assert found["ventes", "a.csv"].destination.endswith("/a.csv")


def test_lost_run_is_started_again(spark, tmp_path, monkeypatch):
    """A run lost between its copies and its record leaves nothing that the next one trips over."""
    from comptoir.plans import intake

    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    put(tmp_path / "in/ventes/a.csv", GOOD_CSV)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(intake, "replace_partition", lost)
        with pytest.raises(RuntimeError):
            ingest(spark, landing, lake, DAY_ONE)
    assert (tmp_path / "lake/raw/ventes/ingest_date=2026-10-02/a.csv").exists()
    found = outcomes(ingest(spark, landing, lake, DAY_ONE_LATER))
    assert found["ventes", "a.csv"].statut == "SUCCESS"
    assert [p.name for p in (tmp_path / "lake/raw").rglob("*.csv")] == ["a.csv"]
    # From here on the key is taken.
    put(tmp_path / "in/ventes/a.csv", GOOD_CSV + "V8,,,,,\n")
    found = outcomes(ingest(spark, landing, lake, datetime(2026, 10, 2, 11, 0)))
    assert "/a__" in found["ventes", "a.csv"].destination
    assert (tmp_path / "lake/raw/ventes/ingest_date=2026-10-02/a.csv").read_text() == GOOD_CSV


def test_changed_file_is_not_landed(spark, tmp_path, monkeypatch):
    """A file that changes between its control and its copy ends the run; the next one judges it anew."""
    from comptoir.plans import intake

    changing = put(tmp_path / "in/ventes/a.csv", GOOD_CSV)
    decide = intake.ingestion.decide

    def change_then_decide(*arguments):
        changing.write_text(GOOD_CSV + "V7,,,,,\n")
        return decide(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(intake.ingestion, "decide", change_then_decide)
        with pytest.raises(Exception, match="changed while it was ingested"):
            ingest(spark, str(tmp_path / "in"), str(tmp_path / "lake"), DAY_ONE)
    found = outcomes(ingest(spark, str(tmp_path / "in"), str(tmp_path / "lake"), DAY_ONE_LATER))
    assert found["ventes", "a.csv"].motif == "4 enregistrement(s)"
    assert [p.read_text()[-8:] for p in (tmp_path / "lake/raw").rglob("*.csv")] == ["V7,,,,,\n"]


def test_nothing_has_arrived(spark, tmp_path):
    intake = ingest(spark, str(tmp_path / "nowhere"), str(tmp_path / "lake"), DAY_ONE)
    assert intake.code == 0 and intake.outcomes.isEmpty() and intake.manifest.isEmpty()
