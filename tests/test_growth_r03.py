"""What must not grow with the input: widths parsed, rows sent to Python, files shuffled, micro-batches."""

import json
import random
import threading
import time

import pytest
from lake_files import put
from pyspark.sql import functions as F

from comptoir import session
from comptoir.catalog import files as W
from comptoir.catalog import landing, queries
from comptoir.functions import strict_date
from comptoir.operators import control, ingestion
from comptoir.operators.cleaning import CLEANERS
from comptoir.plans import batch
from comptoir.schemas import REQUIRED_FIELDS
from comptoir.sinks import replace_table
from comptoir.sources import lots, messages
from comptoir.streaming import job

REQUIRED = "id_vente,date_vente,id_client,id_produit,id_magasin,quantite"
AT = "2026-10-02 08:30:00"


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_lots_are_parsed_as_far_as_their_columns_reach(spark, tmp_path, monkeypatch):
    put(tmp_path / "a.csv", f"{REQUIRED}\nV1,,,,,1\n")
    put(tmp_path / "b.csv", "x,y,id_vente,quantite\n0,0,V2,2\n")
    put(tmp_path / "empty.csv", "")
    for sent in (lots.HEADERS_SENT, 0):
        monkeypatch.setattr(lots, "HEADERS_SENT", sent)
        rows = lots.read_sales(spark, str(tmp_path))
        assert "_c5" in plan_of(rows) and "_c6" not in plan_of(rows)
        assert {(r.id_vente, r.quantite) for r in rows.collect()} == {("V1", "1"), ("V2", "2")}
    monkeypatch.undo()
    put(tmp_path / "wide.csv", ",".join(f"x{i}" for i in range(300)) + ",id_vente\n" + "," * 300 + "V3\n")
    assert [r.id_vente for r in lots.read_sales(spark, str(tmp_path)).where("_fichier_source LIKE '%wide%'").collect()] == [None]


def odd_contents() -> list[bytes]:
    random.seed(3)
    pieces = [REQUIRED, "quantite,id_vente,id_magasin,id_client,id_produit,date_vente", " id_vente ,x", "é,b", "\t", "\n", "\n\n", "\r\n",
              "\r", '"a\nb"', '"', ",", "1,2,3", " ", "﻿", "x\x00y", " id_vente", "\x0b", "\x1c", " "]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 7))).encode() for _ in range(1500)]
    return texts + [b"\xe9", b"a,b\n\xe9", b"a\xff\n1", b"a,b\n" + b"x" * 200_000, b"a,b\n\n\n", ",".join(map(str, range(300))).encode(),
                    (",".join(f"c{i}" for i in range(250)) + "," + REQUIRED).encode(), (REQUIRED + "," + REQUIRED + "\n1").encode()]


def test_contents_in_rows_are_inspected_like_files(spark):
    cases = [("ventes", f"f{i}.{end}", content) for i, content in enumerate(odd_contents()) for end in ("csv", "txt")]
    rows = spark.createDataFrame([(s, n, n, len(c), c) for s, n, c in cases],
                                 "source string, fichier string, chemin string, taille bigint, content binary")
    names = ["sha256", "champs", "lignes", "defaut", "disposition", "coupures"]
    found = {r.fichier: tuple(r[n] for n in names) for r in control.inspect_files(rows).collect()}
    assert len(found) == len(cases)
    for _, name, content in cases:
        assert found[name] == control._examine(name, ".csv" if name.endswith("csv") else None, content), content[:80]


def test_held_contents_and_streams_have_the_same_lines():
    for content in odd_contents():
        import io
        assert control._inspect(control.Held(content), ".csv") == control._inspect(io.BytesIO(content), ".csv"), content[:80]


def test_first_run_shuffles_files_for_nothing_but_their_contents(spark, monkeypatch):
    controlled = spark.createDataFrame(
        [("ventes", f"{n}.csv", f"{n}.csv", 1, f"{n % 2:064x}", 1, None, False, None) for n in range(4)],
        "source string, fichier string, chemin string, taille bigint, sha256 string, lignes bigint, disposition string, "
        "coupures boolean, motif string")
    nothing = spark.createDataFrame([], f"{ingestion.MANIFEST_SCHEMA}, rangement string")
    first = ingestion.decide(controlled, nothing, nothing, nothing, AT)
    assert "destination" not in " ".join(x for x in plan_of(first).split("\n") if "Exchange hashpartitioning" in x)
    assert plan_of(first).count("Exchange hashpartitioning") == 3  # contents, and both sides of their join
    assert {(r.fichier, r.statut, r.sha256) for r in first.collect()} == {
        (f"{n}.csv", "SUCCESS" if n < 2 else "DUPLICATE", f"{n % 2:064x}") for n in range(4)}
    # keys in use, sent to the tasks or met in a shuffle
    manifest = first.where("fichier = '0.csv'").select("sha256", "fichier", "source", "destination", "taille", "lignes", "date")
    seen = []
    for sent in (ingestion.KEYS_SENT, 0):
        monkeypatch.setattr(ingestion, "KEYS_SENT", sent)
        second = ingestion.decide(controlled, manifest, first.select("destination"), first.select("rangement"), AT)
        seen.append(sorted(map(tuple, second.select("fichier", "statut", "destination", "rangement").collect())))
    assert seen[0] == seen[1] and [row[1] for row in seen[0]] == ["DUPLICATE", "SUCCESS", "DUPLICATE", "DUPLICATE"]
    assert all("_20261002083000" in row[3] for row in seen[0]) and "__00000000" in seen[0][1][2]


def test_files_arrive_in_batches_weighed_by_their_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "mapInPandas", None)  # batches of 10,000 rows, whatever they hold
    rows = spark.range(50).select(F.lit("ventes").alias("source"), F.concat("id", F.lit(".csv")).alias("fichier"),
                                  F.encode(F.repeat(F.lit("x"), 1000), "UTF-8").alias("contenu"))
    landing.arrive(rows, f"file://{tmp_path}/in")
    assert sorted(p.name for p in (tmp_path / "in/ventes").iterdir()) == sorted(f"{n}.csv" for n in range(50))


def test_archive_is_replayed_in_bounded_batches(spark, tmp_path, monkeypatch):
    rows = spark.range(400).select(F.lit("no json").cast("binary").alias("value"), F.lit(0).alias("partition"),
                                   F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"))
    rows.coalesce(1).write.option("maxRecordsPerFile", 100).parquet(f"{tmp_path}/messages")
    monkeypatch.setattr(messages, "BATCH_BYTES", 1, raising=False)
    job.start_sales_stream(messages.file_messages(spark, f"{tmp_path}/messages"), f"{tmp_path}/lake", f"{tmp_path}/checkpoint",
                           job.AVAILABLE_NOW).wait()
    raw = spark.read.json(f"{tmp_path}/lake/raw/ventes_stream")
    assert raw.count() == 400 and raw.select("micro_batch").distinct().count() == 4


def test_source_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "LOT_ROWS", 100, raising=False)
    rows = spark.range(0, 1000, 1, 1).selectExpr(*[f"CAST(id AS STRING) AS {n}" for n in (
        "id_vente", "date_vente", "id_client", "id_produit", "id_magasin", "quantite", "nom_produit", "categorie", "prix_unitaire")])
    W.write_sales_csv(rows, f"{tmp_path}/ventes")
    W.write_products_xml(rows, f"{tmp_path}/produits")
    for folder, ending in (("ventes", "csv"), ("produits", "xml")):
        assert len(list((tmp_path / folder).glob(f"part-*.{ending}"))) == 10 or ending == "xml" and len(list((tmp_path / folder).glob("part-*"))) == 10
    assert lots.read_sales(spark, f"{tmp_path}/ventes").count() == 1000


def test_outputs_of_a_micro_batch_are_dealt_by_what_their_tasks_read(spark, tmp_path, monkeypatch):
    sound = ('{"id_vente": "S1", "horodatage": "2026-03-01T10:00:00", "id_magasin": "M1", "ville": "v", "id_produit": "P1", '
             '"categorie": "c", "quantite": 1, "prix_unitaire": 2.0}')
    rows = spark.range(0, 800, 1, 8).select(F.when(F.col("id") % 8 == 0, "no json").otherwise(sound).cast("binary").alias("value"), F.lit(0).alias("partition"),
                                            F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"))
    for name, most in (("FILE_ROWS", 200), ("FILE_BYTES", 35_000)):  # four tasks, three
        monkeypatch.setattr(job, name, most, raising=False)
        job.write_batch(rows, 0, f"{tmp_path}/{name}")
        for table, count in (("raw/rejets_stream", 100), ("raw/ventes_stream", 800), ("processed/ventes_stream", 700)):
            assert len(list((tmp_path / name / table / "micro_batch=0").glob("part-*"))) >= 3
            assert spark.read.format("json" if "raw" in table else "parquet").load(f"{tmp_path}/{name}/{table}").count() == count
        monkeypatch.undo()


def test_files_arrive_by_the_workers_of_the_other_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "rdd", None)
    rows = spark.createDataFrame([("ventes", "a.csv", b"x"), ("ventes", "b.csv", None), ("clients", None, b"")], "source string, fichier string, contenu binary")
    before = spark.conf.get(landing.BATCH)
    landing.arrive(rows, f"file://{tmp_path}/in")
    assert spark.conf.get(landing.BATCH) == before
    assert {str(p.relative_to(tmp_path / "in")): p.read_bytes() for p in (tmp_path / "in").rglob("*") if p.is_file()} == {
        "ventes/a.csv": b"x", "ventes/b.csv": b"", "clients/None": b""}


def test_items_of_a_json_lot_are_not_held():
    import io
    import tracemalloc

    def whole(text):
        try:
            items = json.loads(text)
        except ValueError as error:
            return str(error)
        sound = isinstance(items, list) and items and all(isinstance(item, dict) for item in items)
        return (sorted(set().union(*items)), len(items)) if sound else control.JSON_SHAPE

    pieces = ["[", "]", "{", "}", '{"a": 1}', '{"b": [1, {"c": null}]}', ",", " ", "\n", "5", "null", '"x', "NaN", "\x00", '{"a": 1, "a": 2}', " "]
    random.seed(5)
    for text in ["[]", "", " [ ] ", "[5]", '[{"a": 1}, 5]', '[{"a": 1} , {"b": 2}]\n', '[{"a": 1},]', '[{"a": 1}] x', '[{"a": 1}, 5, {]',
                 *("[" * (k % 2) + "".join(random.choices(pieces, k=k % 7)) + "]" * (k % 3 > 0) for k in range(3000))]:
        try:
            fields, rows = control._inspect_json(io.BytesIO(text.encode()))
            found = sorted(fields), rows
        except (ValueError, control.Unsuitable) as error:
            found = str(error)
        assert found == whole(text), text
    lot = io.BytesIO(json.dumps([{"id_client": f"C{n}", "nom": None, "ville": "V", "segment": "HOUSEHOLD"} for n in range(20_000)]).encode())
    size = len(lot.getvalue())
    tracemalloc.start()
    assert control._inspect_json(lot) == ({"id_client", "nom", "ville", "segment"}, 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * size


def test_steps_that_do_not_need_each_other_run_side_by_side(spark, tmp_path, monkeypatch):
    """One after the other, they would wait for each other in vain."""
    met, written = threading.Barrier(4), []

    def meets(rows, path, *_, **__):
        if "ingest_date=" not in path:
            met.wait(30)
        written.append(path.split("/")[-1])

    for name in ("write_sales_csv", "write_json_arrays", "write_products_xml", "write_workbooks"):
        monkeypatch.setattr(W, name, meets)
    monkeypatch.setattr(queries, "run_batch", lambda *_: None)
    monkeypatch.setattr(queries, "both_axes", lambda *_: None)
    queries.batch_revenue(spark, "/root/testdata/sf0.001")
    assert sorted(written) == ["ingest_date=2026-10-02"] * 2 + ["initial"] * 2 + ["magasins", "ventes"]

    written.clear()
    for source in ("ventes", "clients", "produits", "magasins"):
        (tmp_path / "raw" / source).mkdir(parents=True)
    monkeypatch.setattr(batch, "replace_table", meets)
    batch.clean_zone(spark, f"{tmp_path}/raw", f"{tmp_path}/lake")
    assert sorted(written) == ["clients", "magasins", "produits", "ventes"]

    met, written = threading.Barrier(2), []
    for name in ("clean_zone", "match_zone"):
        monkeypatch.setattr(batch, name, lambda *_: None)
    for name in ("enriched_zone", "curate_zone"):
        monkeypatch.setattr(batch, name, lambda _, lake: meets(None, lake))
    batch.run_batch(spark, "lake")
    assert written == ["lake", "lake"]


def test_an_error_is_raised_when_the_other_steps_have_ended(spark):
    ended = []

    def fails():
        raise ValueError("lost")

    def lasts():
        time.sleep(0.2)
        ended.append(spark.range(3).count())

    with pytest.raises(ValueError, match="lost"):
        session.at_once(spark, [fails, lasts])
    assert ended == [3]


def test_matched_sales_are_not_sorted_to_be_written(spark, tmp_path, monkeypatch):
    tables = {name: clean(spark.createDataFrame([], ", ".join(f"{c} string" for c in [*REQUIRED_FIELDS[name], "_fichier_source", "_ingest_date"])))
              for name, clean in CLEANERS.items()}
    sales = tables["ventes"].unionByName(spark.range(40).selectExpr(
        "CAST(id AS STRING) AS id_vente", "CAST(NULL AS DATE) AS date_vente", "CAST(NULL AS STRING) AS date_vente_source",
        "'C1' AS id_client", "'P1' AS id_produit", "'M1' AS id_magasin", "CAST(id % 2 AS INT) AS quantite", "'' AS ingest_date",
        "CAST(NULL AS STRING) AS anomalies"))
    tables["ventes"] = sales.repartition(1, "quantite").sortWithinPartitions("id_vente")
    tables["produits"] = spark.createDataFrame([("P1", "p", "c", 2.0)], tables["produits"].schema)
    for name, rows in tables.items():
        replace_table(rows, batch.processed(str(tmp_path), name))
    names = [*batch.TWO_FILES_OPEN]
    before, seen = [spark.conf.get(n) for n in names], []
    write = batch.replace_table

    def watched(rows, path, **options):
        write(rows, path, **options)
        seen.append([spark.conf.get(n) for n in names])

    monkeypatch.setattr(batch, "replace_table", watched)
    batch.match_zone(spark, str(tmp_path))
    assert seen == [["false", "2"]] and [spark.conf.get(n) for n in names] == before
    assert batch.read_enriched(spark, str(tmp_path)).count() == 20
    assert batch.read_rejected(spark, str(tmp_path)).count() == 20


def test_dates_of_the_plain_form_are_cast_and_others_read_as_before(spark):
    texts = ["2026-03-01", "2026-02-30", "2026-02-29", "2024-02-29", "2026-13-01", "2026-00-10", "2026-3-1", "2026-03-1T", "2026-03-01\n",
             "2026-03-01 ", "2026-03-01T10", "+2026-03-01", "-2026-03-01", "0000-01-01", "0001-01-01", "0999-12-31", "1000-01-01", "1582-10-10",
             "1500-02-29", "1911-03-11", "9999-12-31", "10000-01-01", "+10000-01-01", "２０２６-03-01", "2026/03/01", "", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    for zone in ("UTC", "Europe/Paris", "America/Sao_Paulo"):
        with session.settings(spark, {"spark.sql.session.timeZone": zone}):
            found = rows.select("v", strict_date(F.col("v")).cast("string"), F.try_to_date("v", "yyyy-MM-dd").cast("string")).collect()
            assert [(r[0], r[1]) for r in found] == [(r[0], r[2]) for r in found]
    assert "cast(v" in plan_of(rows.select(strict_date(F.col("v")))).lower().replace("#", " ").replace("try_cast", "cast")
