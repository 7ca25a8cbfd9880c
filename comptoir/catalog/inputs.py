"""The retail sources, derived from the test tables.

One SQL text per source, which Spark and the checking engine both run. The test tables are
clean, so defects are put in by rules on the keys: every kind the operators look for occurs, in
whole tables and at every scale. A line of an order is a sale, a supplier a store, its nation a
city; ten consecutive orders belong to one customer, as the key ranges of the tables have it. No
source needs a join, so what a query measures is its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SALES = """
SELECT
  CASE WHEN l_partkey % 503 = 0 THEN NULL
       WHEN l_suppkey % 7 = 0
       THEN ' v' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || ' '
       ELSE 'V' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
  END AS id_vente,
  CASE WHEN l_partkey % 83 = 0 THEN '2026-02-30'
       WHEN l_partkey % 79 = 0 THEN NULL
       WHEN l_partkey % 73 = 0 THEN '  '
       WHEN l_partkey % 71 = 0 THEN '2001-3-1'
       WHEN l_partkey % 67 = 0 THEN ' ' || CAST(CAST(l_shipdate AS DATE) AS STRING) || ' '
       ELSE CAST(CAST(l_shipdate AS DATE) AS STRING)
  END AS date_vente,
  CASE WHEN l_orderkey % 97 = 0 THEN 'C99999999999'
       WHEN l_orderkey % 89 = 0 THEN NULL
       WHEN l_orderkey % 53 = 0 THEN ' c' || CAST(CAST(FLOOR(l_orderkey / 10) AS BIGINT) AS STRING)
       ELSE 'C' || CAST(CAST(FLOOR(l_orderkey / 10) AS BIGINT) AS STRING)
  END AS id_client,
  CASE WHEN l_partkey % 97 = 0 THEN 'P99999999999'
       WHEN l_orderkey % 101 = 0 THEN 'p' || CAST(l_partkey AS STRING) || ' '
       ELSE 'P' || CAST(l_partkey AS STRING)
  END AS id_produit,
  CASE WHEN l_orderkey % 103 = 0 THEN 'M99999999999'
       WHEN l_orderkey % 107 = 0 THEN NULL
       ELSE 'M' || CAST(l_suppkey AS STRING)
  END AS id_magasin,
  CASE WHEN l_partkey % 89 = 0 THEN 'abc'
       WHEN l_partkey % 43 = 0 THEN NULL
       WHEN l_partkey % 41 = 0 THEN '0'
       WHEN l_partkey % 37 = 0 THEN '-' || CAST(CAST(l_quantity AS INT) AS STRING)
       WHEN l_partkey % 31 = 0 THEN '2.5'
       WHEN l_partkey % 29 = 0 THEN '10000000000'
       WHEN l_partkey % 23 = 0 THEN ' ' || CAST(CAST(l_quantity AS INT) AS STRING) || ' '
       WHEN l_partkey % 19 = 0 THEN ''
       ELSE CAST(CAST(l_quantity AS INT) AS STRING) || '.0'
  END AS quantite,
  'raw/ventes/lot-' || CAST(l_suppkey AS STRING) || '.csv' AS _fichier_source,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS _ingest_date
FROM {lineitem}
"""

CUSTOMERS = """
SELECT 'C' || CAST(c_custkey AS STRING) AS id_client,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE ' ' || c_name END AS nom,
  CASE WHEN c_custkey % 19 = 0 THEN NULL
       WHEN c_custkey % 13 = 0 THEN '  '
       WHEN c_custkey % 3 = 0 THEN '  nation_' || CAST(c_nationkey AS STRING) || ' '
       ELSE 'NATION_' || CAST(c_nationkey AS STRING)
  END AS ville,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       WHEN c_custkey % 23 = 0 THEN ''
       ELSE c_mktsegment
  END AS segment,
  'raw/clients/clients.json' AS _fichier_source,
  '1970-01-01' AS _ingest_date
FROM {customer}
UNION ALL
SELECT ' c' || CAST(c_custkey AS STRING), c_name, 'corrigee', NULL,
  'raw/clients/ingest_date=2026-10-02/clients_0210.json', '2026-10-02'
FROM {customer} WHERE c_custkey % 10 = 0
"""

PRODUCTS = """
SELECT 'P' || CAST(p_partkey AS STRING) AS id_produit,
  CASE WHEN p_partkey % 47 = 0 THEN NULL ELSE p_name || ' ' END AS nom_produit,
  CASE WHEN p_partkey % 13 = 0 THEN NULL
       WHEN p_partkey % 11 = 0 THEN '  '
       WHEN p_partkey % 7 = 0 THEN ' ' || p_type || ' '
       ELSE p_type
  END AS categorie,
  CASE WHEN p_partkey % 59 = 0 THEN 'abc'
       WHEN p_partkey % 61 = 0 THEN NULL
       WHEN p_partkey % 109 = 0 THEN '-5.0'
       WHEN p_partkey % 113 = 0 THEN '0'
       ELSE CAST(p_retailprice AS STRING)
  END AS prix_unitaire,
  'raw/produits/produits.xml' AS _fichier_source,
  '1970-01-01' AS _ingest_date
FROM {part}
UNION ALL
SELECT 'p' || CAST(p_partkey AS STRING) || ' ', p_name, 'Accessoires', '21.5',
  'raw/produits/ingest_date=2026-10-02/produits_0210.xml', '2026-10-02'
FROM {part} WHERE p_partkey % 20 = 0
"""

STORES = """
SELECT 'M' || CAST(s_suppkey AS STRING) AS id_magasin,
  CASE WHEN s_suppkey % 29 = 0 THEN NULL ELSE s_name END AS nom_magasin,
  CASE WHEN s_suppkey % 19 = 0 THEN '   '
       WHEN s_suppkey % 23 = 0 THEN NULL
       WHEN s_suppkey % 3 = 0 THEN '  nation_' || CAST(s_nationkey AS STRING)
       ELSE 'NATION_' || CAST(s_nationkey AS STRING) || ' '
  END AS ville,
  CASE WHEN s_suppkey % 31 = 0 THEN NULL
       ELSE 'Region ' || CAST(s_nationkey % 5 AS STRING) || ' ' END AS region,
  'raw/magasins/magasins.xlsx' AS _fichier_source,
  '1970-01-01' AS _ingest_date
FROM {supplier}
"""

# The key of a message is the store, here the user: its events share a partition.
MESSAGES = """
SELECT
  CASE WHEN event_id % 37 = 0 THEN NULL
       WHEN event_id % 31 = 0 THEN '[1, 2]'
       WHEN event_id % 29 = 0 THEN 'not json'
       ELSE '{{"schema_version": 1, "id_vente": "S' || CAST(event_id AS STRING) || '", "horodatage": "'
         || CASE WHEN event_id % 19 = 0 THEN 'hier'
                 ELSE substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8) END
         || CASE WHEN event_id % 13 = 0 THEN '"'
                 ELSE '", "id_magasin": "M' || CAST(user_id AS STRING) || '", "ville": "'
                   || CASE WHEN event_id % 23 = 0 THEN '  '
                           WHEN event_id % 3 = 0 THEN ' VILLE-' || CAST(user_id % 40 AS STRING) || ' '
                           ELSE 'ville-' || CAST(user_id % 40 AS STRING) END || '"' END
         || ', "id_client": "C' || CAST(user_id AS STRING)
         || '", "id_produit": "P' || CAST(event_id % 200 AS STRING)
         || '", "nom_produit": "' || event_type || '", "categorie": "' || event_type
         || '", "quantite": '
         || CASE WHEN event_id % 11 = 0 THEN '"trois"'
                 WHEN event_id % 43 = 0 THEN '"3"'
                 WHEN event_id % 47 = 0 THEN '3.0'
                 WHEN event_id % 41 = 0 THEN '0'
                 ELSE CAST(event_id % 5 + 1 AS STRING) END
         || ', "prix_unitaire": '
         || CASE WHEN event_id % 17 = 0 THEN '-10' ELSE CAST(value AS STRING) END
         || ', "en_plus": true}}'
  END AS message,
  CAST(user_id % 3 AS INT) AS partition,
  event_id AS offset,
  ts AS timestamp
FROM {events}
"""

# Every line, customer and part as an arriving file of its own, most of them sound.
FILES = """
SELECT 'ventes' AS source,
  'v' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
    || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)
    || CASE WHEN l_partkey % 41 = 0 THEN '.txt' WHEN l_partkey % 43 = 0 THEN '' ELSE '.CSV' END
    AS fichier,
  CASE WHEN l_partkey % 37 = 0 THEN '  ' || chr(10)
       WHEN l_partkey % 31 = 0 THEN 'id_vente,id_client,id_magasin' || chr(10) || '1,2,3'
       WHEN l_partkey % 29 = 0 THEN 'id_vente, date_vente,id_client,id_produit,id_magasin,quantite'
       ELSE 'id_vente, date_vente,id_client,id_produit,id_magasin,quantite' || chr(10)
         || 'V' || CAST(l_suppkey AS STRING) || ',,,P' || CAST(l_partkey % 50 AS STRING) || ',,'
         || CASE WHEN l_partkey % 23 = 0 THEN chr(10) || chr(10) || '"a' || chr(10) || 'b",1' ELSE '' END
  END AS texte
FROM {lineitem}
UNION ALL
SELECT 'clients', 'c' || CAST(c_custkey AS STRING) || '.json',
  CASE WHEN c_custkey % 31 = 0 THEN '{{"id_client": 1}}'
       WHEN c_custkey % 29 = 0 THEN '[]'
       WHEN c_custkey % 23 = 0 THEN '[{{"id_client": "1", "nom": "a"}}, {{"ville": null}}]'
       ELSE '[{{"id_client": "' || CAST(c_custkey % 400 AS STRING)
         || '", "nom": null}}, {{"ville": "x", "segment": "' || c_mktsegment || '"}}]'
  END
FROM {customer}
UNION ALL
SELECT 'produits', 'p' || CAST(p_partkey AS STRING) || '.xml',
  CASE WHEN p_partkey % 31 = 0 THEN '<produits></produits>'
       WHEN p_partkey % 29 = 0 THEN '<produits><produit><id_produit/><categorie/></produit><produit/></produits>'
       ELSE '<produits><produit><id_produit>' || CAST(p_partkey AS STRING)
         || '</id_produit><nom_produit/><categorie/><prix_unitaire/></produit><produit/></produits>'
  END
FROM {part}
"""

SOURCES = {
    "ventes": (SALES, ["lineitem"]),
    "clients": (CUSTOMERS, ["customer"]),
    "produits": (PRODUCTS, ["part"]),
    "magasins": (STORES, ["supplier"]),
    "messages": (MESSAGES, ["events"]),
    "fichiers": (FILES, ["lineitem", "customer", "part"]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, tables = SOURCES[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in tables})


def source_sql(name: str) -> str:
    text, tables = SOURCES[name]
    return text.format(**{t: t for t in tables})
