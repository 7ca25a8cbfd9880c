"""A landing zone of whole lots, derived from the test tables, as it is before a first and a second run.

One SQL text that Spark and the checking engine both run, but for how a list of lines is joined. The lines of a
supplier are a sales lot, the customers of a nation a JSON lot, every fortieth part an XML lot. The key of a lot decides
what is wrong with it, if anything, and what comes of it for the second run.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.catalog.inputs import table
from comptoir.plans.intake import Intake, ingest
from comptoir.sinks import run
from comptoir.sources.files import write_file

AT = ("2026-10-02 08:30:00", "2026-10-02 09:00:00")
TABLES = ["lineitem", "customer", "part"]
#: Bytes that go to Python at once.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 * 1024 * 1024
_SPARK = "array_join(array_sort(collect_list(ligne)), {})"
_DUCKDB = "array_to_string(list_sort(list(ligne)), {})"

# (tour, source, fichier, texte, octet_final, lignes, motif): `octet_final` adds a byte that is no UTF-8.
LANDED = """
WITH l AS (
  SELECT l_suppkey AS k, l_suppkey % 16 AS m, {lines} AS corps, count(*) AS n
  FROM (SELECT l_suppkey, CASE WHEN l_suppkey % 16 = 1
      THEN CAST(CAST(l_quantity AS INT) AS STRING) || ',V' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
        || ',M' || CAST(l_suppkey AS STRING) || ',,P' || CAST(l_partkey AS STRING) || ',' || CAST(CAST(l_shipdate AS DATE) AS STRING)
      ELSE 'V' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || ',' || CAST(CAST(l_shipdate AS DATE) AS STRING)
        || ',,P' || CAST(l_partkey AS STRING) || ',M' || CAST(l_suppkey AS STRING) || ',' || CAST(CAST(l_quantity AS INT) AS STRING)
      END AS ligne FROM {lineitem})
  GROUP BY l_suppkey),
v AS (
  SELECT k, m, n, corps, 'id_vente,date_vente,id_client,id_produit,id_magasin,quantite' || chr(10) || corps || chr(10) AS usuel FROM l),
c AS (
  SELECT c_nationkey AS k, count(*) AS n, {objects} AS corps
  FROM (SELECT c_nationkey, '{{"id_client": "C' || CAST(c_custkey AS STRING) || '", "nom": null, "ville": "V", "segment": "'
    || c_mktsegment || '"}}' AS ligne FROM {customer}) GROUP BY c_nationkey),
p AS (
  SELECT k, count(*) AS n, {objects} AS corps
  FROM (SELECT p_partkey % 40 AS k, '<produit><id_produit>P' || CAST(p_partkey AS STRING)
    || '</id_produit><nom_produit>n</nom_produit><categorie/><prix_unitaire>1.5</prix_unitaire></produit>' AS ligne FROM {part})
  GROUP BY k)
SELECT 1 AS tour, 'ventes' AS source,
  CASE WHEN m = 4 THEN 'lot' || CAST(k AS STRING) || '.txt' WHEN m = 6 THEN '_lot' || CAST(k AS STRING) || '.csv'
       WHEN m = 10 THEN 'lot' || CAST(k AS STRING) || '.CSV' ELSE 'lot' || CAST(k AS STRING) || '.csv' END AS fichier,
  CASE WHEN m = 1 THEN 'quantite,id_vente, id_magasin,id_client,id_produit,date_vente' || chr(10) || corps || chr(10)
       WHEN m = 2 THEN 'id_vente,date_vente,id_client' || chr(10) || corps || chr(10)
       WHEN m = 3 THEN 'id_vente,date_vente,id_client,id_produit,id_magasin,quantite'
       WHEN m = 7 THEN usuel || '"V' || CAST(k AS STRING) || chr(10) || 'bis",,,,,2' || chr(10)
       WHEN m = 8 THEN '' ELSE usuel END AS texte,
  m = 5 AS octet_final,
  CASE WHEN m = 3 THEN 0 WHEN m = 7 THEN n + 1 WHEN m IN (4, 5, 8) THEN NULL ELSE n END AS lignes,
  CASE WHEN m = 2 THEN 'champs obligatoires absents : id_magasin, id_produit, quantite'
       WHEN m = 3 THEN 'aucune ligne de données'
       WHEN m = 4 THEN 'extension .txt inattendue pour ventes (attendu : .csv)'
       WHEN m = 5 THEN 'fichier corrompu ou format illisible (UnicodeDecodeError: ''utf-8'' codec can''t decode byte 0xe9 in position '
         || CAST(length(usuel) AS STRING) || ': unexpected end of data)'
       WHEN m = 8 THEN 'fichier vide' END AS motif
FROM v
UNION ALL
SELECT 2, 'ventes', 'copie' || CAST(k AS STRING) || '.csv', CASE WHEN m = 8 THEN '' ELSE usuel END, FALSE,
  CASE WHEN m <> 8 THEN n END, CASE WHEN m = 8 THEN 'fichier vide' END FROM v WHERE m IN (0, 4, 8, 12)
UNION ALL
SELECT 2, 'ventes', 'lot' || CAST(k AS STRING) || '.csv', usuel || 'V' || CAST(k AS STRING) || ',,,,,1' || chr(10), FALSE,
  n + 1, NULL FROM v WHERE m = 9
UNION ALL
SELECT 2, 'ventes', 'lot' || CAST(k AS STRING) || '.csv', 'id_vente' || chr(10) || corps || chr(10), FALSE, n,
  'champs obligatoires absents : date_vente, id_client, id_magasin, id_produit, quantite' FROM v WHERE m = 2
UNION ALL
SELECT 2, 'ventes', 'lot' || CAST(k AS STRING) || '.csv', usuel, FALSE, n, NULL FROM v WHERE m = 11
UNION ALL
SELECT 2, 'ventes', 'neuf' || CAST(k AS STRING) || suite || '.csv', usuel || 'neuf,,,,,1' || chr(10), FALSE, n + 1, NULL
FROM v CROSS JOIN (SELECT '' AS suite UNION ALL SELECT 'b' AS suite) s WHERE m = 13
UNION ALL
SELECT 1, 'clients', 'clients' || CAST(k AS STRING) || '.json',
  CASE WHEN k % 8 = 1 THEN '[' || corps WHEN k % 8 = 2 THEN '[5, ' || corps || ']' ELSE '[' || corps || ']' END, FALSE,
  CASE WHEN k % 8 NOT IN (1, 2) THEN n END,
  CASE WHEN k % 8 = 1 THEN 'fichier corrompu ou format illisible (JSONDecodeError: Expecting '','' delimiter: line 1 column '
         || CAST(length(corps) + 2 AS STRING) || ' (char ' || CAST(length(corps) + 1 AS STRING) || '))'
       WHEN k % 8 = 2 THEN 'JSON inattendu : une liste d''objets est attendue' END
FROM c
UNION ALL
SELECT 1, 'produits', 'produits' || CAST(k AS STRING) || '.xml',
  CASE WHEN k % 8 = 1 THEN '<produits>' || replace(corps, ', ', '') ELSE '<produits>' || replace(corps, ', ', '') || '</produits>' END, FALSE,
  CASE WHEN k % 8 <> 1 THEN n END,
  CASE WHEN k % 8 = 1 THEN 'fichier corrompu ou format illisible (ParseError: no element found: line 1, column '
         || CAST(length(replace(corps, ', ', '')) + 10 AS STRING) || ')' END
FROM p
"""


def _text(joined: str, **tables) -> str:
    return LANDED.format(lines=joined.format("chr(10)"), objects=joined.format("', '"), **tables)


def landed_sql() -> str:
    """(tour, source, fichier, contenu, lignes, motif) for the checking engine."""
    return (f"SELECT tour, source, fichier, lignes, motif, encode(texte) || CASE WHEN octet_final THEN '\\xE9'::BLOB "
            f"ELSE ''::BLOB END AS contenu FROM ({_text(_DUCKDB, **{t: t for t in TABLES})})")


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tour, source, fichier, contenu) of every file that arrives."""
    text = _text(_SPARK, **{t: f"{{{t}}}" for t in TABLES}).replace('{"', '{{"').replace('"}', '"}}')
    rows = spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES})
    content = F.encode("texte", "UTF-8")
    return rows.select("tour", "source", "fichier", F.when(F.col("octet_final"), F.concat(content, F.lit(b"\xe9")))
                       .otherwise(content).alias("contenu"))


def arrive(files: DataFrame, folder: str) -> None:
    """Files into their source's folder, from the tasks that hold them.

    Rows reach Python in batches of a few MB, whatever a file holds. The workers are those of the other steps: rows of an RDD would
    get a second set of them, idle ever after.
    """
    spark = files.sparkSession

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, name, content in zip(*batch.columns):
                write_file(f"{folder}/{source.as_py()}/{name.as_py()}", content.as_py())
            yield batch.select(["fichier"])

    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        run(files.select("source", "fichier", "contenu").mapInArrow(store, "fichier string"))
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def two_runs(spark: SparkSession, sf_dir: str, folder: str) -> list[Intake]:
    """Files arrive and are ingested, more arrive, and they are ingested later that day."""
    files, out = landed(spark, sf_dir), []
    for tour, at in enumerate(AT, 1):
        arrive(files.where(F.col("tour") == tour), f"{folder}/incoming")
        out.append(ingest(spark, f"{folder}/incoming", f"{folder}/lake", datetime.fromisoformat(at)))
    return out


def _inserted(name: str, what: str) -> str:
    """A name with an insertion before its suffix."""
    ending = f"regexp_extract({name}, '^.+(\\.[^.]+)$', 1)"
    return f"left({name}, length({name}) - length({ending})) || {what} || {ending}"


# The outcomes of both runs, by the rules.
OUTCOMES = f"""
WITH f AS (
  SELECT *, sha256(contenu) AS sha256, CAST(octet_length(contenu) AS BIGINT) AS taille,
    CASE source WHEN 'ventes' THEN 1 WHEN 'clients' THEN 2 ELSE 3 END AS rang,
    CASE WHEN motif IS NULL THEN '_archive/' ELSE '_rejected/' END || source || '/' || fichier AS range_en,
    'raw/' || source || '/ingest_date=2026-10-02/'
      || CASE WHEN starts_with(contenu::VARCHAR, 'quantite,') THEN 'disposition=1-5-3-4-2-0/' ELSE '' END
      || regexp_replace(fichier, '^_', 'lot_') AS place
  FROM ({landed_sql()})),
s AS (
  SELECT *, min(tour) OVER (PARTITION BY sha256) AS premier_tour,
    first_value(fichier) OVER (PARTITION BY sha256 ORDER BY tour, rang, fichier) AS premier,
    row_number() OVER (PARTITION BY sha256 ORDER BY tour, rang, fichier) = 1 AS est_premier
  FROM f WHERE motif IS NULL),
d AS (
  SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM s x WHERE x.tour < s.tour AND x.place = s.place)
    THEN {_inserted('s.place', "'__' || left(s.sha256, 8)")} ELSE s.place END AS destination FROM s),
o AS (
  SELECT tour, source, fichier, sha256, taille, lignes, range_en,
    CASE WHEN est_premier THEN 'SUCCESS' ELSE 'DUPLICATE' END AS statut,
    CASE WHEN est_premier THEN lignes || ' enregistrement(s)'
      ELSE 'contenu identique déjà ingéré le ' || CASE premier_tour WHEN 1 THEN '{AT[0]}' ELSE '{AT[1]}' END || ' (' || premier || ')' END AS motif,
    CASE WHEN est_premier THEN destination
      ELSE (SELECT x.destination FROM d x WHERE x.sha256 = d.sha256 AND x.est_premier) END AS destination
  FROM d
  UNION ALL SELECT tour, source, fichier, sha256, taille, lignes, range_en, 'REJECTED', motif, '' FROM f WHERE motif IS NOT NULL)
SELECT o.* EXCLUDE (range_en), CASE WHEN EXISTS (SELECT 1 FROM o x WHERE x.tour < o.tour AND x.range_en = o.range_en)
  THEN {_inserted('o.range_en', "'_20261002090000'")} ELSE o.range_en END AS rangement,
  CASE o.tour WHEN 1 THEN '{AT[0]}' ELSE '{AT[1]}' END AS date
FROM o"""

_LAID = f"""
SELECT source, fichier, CAST(octet_length(contenu) AS BIGINT) AS taille, starts_with(fichier, 'copie') AS en_zone
FROM ({landed_sql()}) WHERE tour = 1 OR starts_with(fichier, 'copie')"""

ORACLE = {
    "inventory_of_files": f"""
SELECT 'raw' AS zone, CASE WHEN en_zone THEN '(racine)' ELSE source END AS source, count(*) AS objets,
  CAST(sum(taille) AS BIGINT) AS octets FROM ({_LAID}) GROUP BY 1, 2""",
    "object_metadata": f"""
SELECT CASE WHEN en_zone THEN 'raw/' || fichier ELSE 'raw/' || source || '/ingest_date=2026-10-02/' || fichier END AS cle,
  taille, TRUE AS recent FROM ({_LAID})""",
    "ingest_second_run": f"""
SELECT source, fichier, sha256, taille, lignes, statut, motif, destination, rangement FROM ({OUTCOMES}) WHERE tour = 2""",
    "ingest_known_contents": f"""
SELECT sha256, fichier, source, destination, taille, lignes, date FROM ({OUTCOMES}) WHERE statut = 'SUCCESS'""",
    "ingest_journal": f"""
SELECT date, source, fichier, destination, taille AS taille_octets, statut, motif FROM ({OUTCOMES})""",
    "ingest_code": f"""
SELECT tour, CAST(max(CASE WHEN statut = 'REJECTED' THEN 1 ELSE 0 END) AS INT) AS code FROM ({OUTCOMES}) GROUP BY tour""",
    "ingest_then_read": f"""
SELECT source, CAST(sum(lignes) AS BIGINT) AS lignes, CAST(sum(lignes) AS BIGINT) AS lues
FROM ({OUTCOMES}) WHERE statut = 'SUCCESS' GROUP BY source""",
}
