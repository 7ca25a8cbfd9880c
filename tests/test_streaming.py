"""The stream: faults, several micro-batches, restart, replay."""

import json
from datetime import datetime

import pytest

from comptoir.schemas import ENVELOPE_SCHEMA, EVENT_REQUIRED
from comptoir.sources.messages import file_messages, topic_partition
from comptoir.streaming import events
from comptoir.streaming.job import (
    AVAILABLE_NOW,
    read_history,
    read_revenue,
    revenue_from_history,
    start_sales_stream,
    write_batch,
)

SOUND = {
    "schema_version": 1, "id_vente": "S1", "horodatage": "2026-03-01T10:00:00.123", "id_caisse": "M1-K1",
    "id_magasin": "M1", "ville": " PARIS ", "id_client": "C1", "id_produit": "P1", "nom_produit": "Clavier",
    "categorie": "Info", "quantite": 3, "prix_unitaire": 10.1,
}


def event(**changes):
    return json.dumps({**SOUND, **changes})


def without(name):
    return json.dumps({k: v for k, v in SOUND.items() if k != name})


FAULTS = [
    event(quantite="trois"), event(quantite="3"), event(quantite=3.0), event(quantite=0), event(quantite=-1),
    event(quantite=10**11), event(prix_unitaire=-10), event(prix_unitaire=0), event(prix_unitaire="5"),
    event(horodatage="hier"), event(horodatage=None), "no json", "[1, 2]", "", None, "{}",
    event(ID_VENTE="x", id_vente=None), *[without(name) for name in EVENT_REQUIRED],
]
TOLERATED = [
    event(), event(prix_unitaire=10), event(ville="  "), event(id_vente=17), event(extra={"a": 1}),
    event() + " trailing", without("id_client"), without("schema_version"),
]


def envelope(spark, texts, start=0):
    return spark.createDataFrame(
        [(None if t is None else bytearray(t.encode()), i % 3, start + i, datetime(2026, 3, 1, 10, 0, i % 60))
         for i, t in enumerate(texts)], ENVELOPE_SCHEMA)


@pytest.mark.parametrize("text", FAULTS)
def test_faults_are_rejected(spark, text):
    judged = events.judge_events(envelope(spark, [text])).first()
    assert judged.conforme is False and judged.message == text


def test_tolerated_messages(spark):
    judged = events.judge_events(envelope(spark, TOLERATED))
    assert [r.conforme for r in judged.collect()] == [True] * len(TOLERATED)
    typed = events.typed_events(events.valid_events(judged)).collect()
    assert typed[0].ville == "Paris" and typed[0].montant == 30.3
    assert str(typed[0].date_vente) == "2026-03-01" and typed[0].horodatage.microsecond == 123000
    assert typed[1].prix_unitaire == 10.0 and typed[2].ville is None and typed[3].id_vente == "17"
    assert "message" not in typed[0].asDict() and "kafka_timestamp" not in typed[0].asDict()


def test_statistics(spark):
    judged = events.judge_events(envelope(spark, [event(), "x", event(), event()], start=5))
    assert sorted(map(tuple, events.batch_statistics(judged).collect())) == [
        (0, 5, 8, 2, 2, 0), (1, 6, 6, 1, 0, 1), (2, 7, 7, 1, 1, 0)]


def test_messages_of_one_key_share_a_partition(spark):
    keys = spark.range(1000).selectExpr("concat('M', id % 40) AS cle")
    placed = keys.select("cle", topic_partition("cle", 3).alias("p")).distinct()
    assert placed.count() == 40 and {r.p for r in placed.collect()} == {0, 1, 2}


def append(spark, folder, texts, start):
    envelope(spark, texts, start).coalesce(1).write.mode("append").parquet(folder)


def run(spark, root):
    stream = start_sales_stream(file_messages(spark, f"{root}/messages", files_per_batch=1),
                                f"{root}/lake", f"{root}/checkpoint", AVAILABLE_NOW)
    stream.wait()


def curated(spark, root, name):
    return {row[0]: tuple(row)[1:]
            for row in read_revenue(spark, f"{root}/lake", name).collect()}


def test_batches_restart_and_cumulative_revenue(spark, tmp_path):
    root = str(tmp_path)
    # The first micro-batch holds nothing valid.
    append(spark, f"{root}/messages", ["no json"] * 3, 0)
    run(spark, root)
    assert read_history(spark, f"{root}/lake").isEmpty()
    assert curated(spark, root, "ca_par_ville") == {}

    append(spark, f"{root}/messages", [event(), event(ville="lyon", quantite=1), "x"], 3)
    append(spark, f"{root}/messages", [event(categorie="Audio"), event(ville=" ")], 6)
    run(spark, root)
    expected = {"Paris": (2, 6, 60.6), "Lyon": (1, 1, 10.1), None: (1, 3, 30.3)}
    assert curated(spark, root, "ca_par_ville") == expected
    assert curated(spark, root, "ca_par_categorie") == {"Info": (3, 7, 70.7), "Audio": (1, 3, 30.3)}

    # Starting again without new messages repeats nothing; with some, it goes on from there.
    run(spark, root)
    assert read_history(spark, f"{root}/lake").count() == 4
    assert curated(spark, root, "ca_par_ville") == expected
    append(spark, f"{root}/messages", [event(quantite=2)], 8)
    run(spark, root)
    assert curated(spark, root, "ca_par_ville")["Paris"] == (3, 8, 80.8)

    # What the state holds is what the stored events add up to.
    for name, key in (("ca_par_ville", "ville"), ("ca_par_categorie", "categorie")):
        again = {row[0]: tuple(row)[1:] for row in revenue_from_history(spark, f"{root}/lake", key).collect()}
        assert again == curated(spark, root, name)
    raw = spark.read.json(f"{root}/lake/raw/ventes_stream")
    assert raw.count() == 9 and raw.select("offset").distinct().count() == 9
    assert set(raw.columns) == {"message", "partition", "offset", "kafka_timestamp", "micro_batch"}
    assert spark.read.json(f"{root}/lake/raw/rejets_stream").count() == 4
    totals = spark.read.parquet(f"{root}/lake/processed/statistiques_stream").selectExpr(
        "sum(recus)", "sum(valides)", "sum(rejetes)", "count(DISTINCT micro_batch)").first()
    assert tuple(totals) == (9, 5, 4, 4)


def test_replayed_batch_replaces_itself(spark, tmp_path):
    lake = str(tmp_path)
    first, second = envelope(spark, [event(), "x", None]), envelope(spark, [event()], 3)
    for rows, number in ((first, 0), (second, 1), (first, 0), (first, 0), (second, 1)):
        write_batch(rows, number, lake)
    write_batch(first.limit(0), 2, lake)
    assert read_history(spark, lake).groupBy("micro_batch").count().orderBy("micro_batch").collect() == [(0, 1), (1, 1)]
    assert spark.read.json(f"{lake}/raw/ventes_stream").count() == 4
    assert spark.read.json(f"{lake}/raw/rejets_stream").count() == 2


def test_resent_event_counts_twice(spark, tmp_path):
    write_batch(envelope(spark, [event(), event()]), 0, str(tmp_path))
    assert revenue_from_history(spark, str(tmp_path), "ville").first().nb_ventes == 2


def test_stored_history_has_its_types(spark, tmp_path):
    write_batch(envelope(spark, [event()]), 7, str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/processed/ventes_stream")
    declared = dict(read_history(spark, f"{tmp_path}/none").dtypes)
    assert {k: v for k, v in stored.dtypes if k != "micro_batch"} == {
        k: v for k, v in declared.items() if k != "micro_batch"}
