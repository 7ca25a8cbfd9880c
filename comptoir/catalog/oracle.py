"""SQL for every query that SQL can express on whole tables, written apart from the operators."""

from __future__ import annotations

from comptoir.catalog import landing
from comptoir.catalog.inputs import source_sql
from comptoir.schemas import ENRICHED_COLUMNS

SALES_LATEST = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY upper(trim(id_vente))
    ORDER BY _ingest_date DESC NULLS LAST, _fichier_source DESC NULLS LAST,
             id_vente DESC NULLS LAST, date_vente DESC NULLS LAST, id_client DESC NULLS LAST,
             id_produit DESC NULLS LAST, id_magasin DESC NULLS LAST, quantite DESC NULLS LAST) AS rn
  FROM ventes) WHERE rn = 1"""


def latest(table: str, key: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY upper(trim({key}))
    ORDER BY _ingest_date DESC, _fichier_source DESC) AS rn FROM {table}) WHERE rn = 1"""


def city(column: str) -> str:
    """First letter of every word in capitals: the test cities are single words."""
    return (f"CASE WHEN trim({column}) = '' THEN NULL "
            f"ELSE upper(left(trim({column}), 1)) || lower(substr(trim({column}), 2)) END")


NUMBER = "TRY_CAST(trim({}) AS DOUBLE)"
DATE = (r"CASE WHEN regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}') "
        "THEN TRY_CAST({0} AS DATE) END")

TYPED_SALES = f"""
SELECT trim(id_vente) AS id_vente,
  {DATE.format('trim(date_vente)')} AS date_vente,
  date_vente AS date_vente_source,
  upper(trim(id_client)) AS id_client,
  upper(trim(id_produit)) AS id_produit,
  upper(trim(id_magasin)) AS id_magasin,
  CASE WHEN {NUMBER.format('quantite')} = floor({NUMBER.format('quantite')})
       THEN TRY_CAST({NUMBER.format('quantite')} AS INTEGER) END AS quantite,
  _ingest_date AS ingest_date
FROM ({SALES_LATEST})"""

CLEAN_SALES = f"""
SELECT *, NULLIF(concat_ws(', ',
  CASE WHEN date_vente_source IS NULL THEN 'date absente' END,
  CASE WHEN date_vente IS NULL AND date_vente_source IS NOT NULL THEN 'date invalide' END,
  CASE WHEN quantite IS NULL THEN 'quantite absente' END,
  CASE WHEN quantite = 0 THEN 'quantite nulle' END,
  CASE WHEN quantite < 0 THEN 'quantite negative' END), '') AS anomalies
FROM ({TYPED_SALES})"""

CLEAN_CUSTOMERS = f"""
SELECT upper(trim(id_client)) AS id_client, trim(nom) AS nom_client,
  {city('ville')} AS ville_client,
  CASE WHEN segment IS NULL THEN 'Non renseigné'
       ELSE upper(left(trim(segment), 1)) || lower(substr(trim(segment), 2)) END AS segment
FROM ({latest('clients', 'id_client')})"""

CLEAN_PRODUCTS = f"""
SELECT upper(trim(id_produit)) AS id_produit, trim(nom_produit) AS nom_produit,
  CASE WHEN categorie IS NULL OR trim(categorie) = '' THEN 'Non renseignée'
       ELSE trim(categorie) END AS categorie,
  TRY_CAST(prix_unitaire AS DOUBLE) AS prix_unitaire
FROM ({latest('produits', 'id_produit')})"""

CLEAN_STORES = f"""
SELECT upper(trim(id_magasin)) AS id_magasin, trim(nom_magasin) AS nom_magasin,
  {city('ville')} AS ville, trim(region) AS region
FROM ({latest('magasins', 'id_magasin')})"""

MATCHED = f"""
SELECT v.id_vente, v.date_vente, v.date_vente_source, v.ingest_date, v.quantite,
  v.id_client, v.id_produit, v.id_magasin,
  coalesce(c.nom_client, 'Client inconnu') AS nom_client,
  coalesce(c.segment, 'Inconnu') AS segment, c.ville_client,
  p.nom_produit, p.categorie, p.prix_unitaire,
  coalesce(m.nom_magasin, 'Magasin inconnu') AS nom_magasin,
  coalesce(m.ville, 'Inconnue') AS ville, coalesce(m.region, 'Inconnue') AS region,
  CAST(CAST(v.quantite AS DECIMAL(12, 0)) * CAST(p.prix_unitaire AS DECIMAL(14, 2)) AS DOUBLE) AS montant,
  NULLIF(concat_ws(', ', v.anomalies,
    CASE WHEN c.nom_client IS NULL THEN 'client inconnu' END,
    CASE WHEN p.nom_produit IS NULL THEN 'produit inconnu' END,
    CASE WHEN m.nom_magasin IS NULL THEN 'magasin inconnu' END), '') AS anomalies
FROM ({CLEAN_SALES}) v
LEFT JOIN ({CLEAN_CUSTOMERS}) c ON v.id_client = c.id_client
LEFT JOIN ({CLEAN_PRODUCTS}) p ON v.id_produit = p.id_produit
LEFT JOIN ({CLEAN_STORES}) m ON v.id_magasin = m.id_magasin"""

USABLE = "quantite > 0 AND prix_unitaire IS NOT NULL"
ENRICHED = f"SELECT {', '.join(ENRICHED_COLUMNS)} FROM ({MATCHED}) WHERE {USABLE}"

QUANTITY_NUMBER = NUMBER.format("quantite")


def revenue(key: str, sales: str) -> str:
    return f"""
SELECT {key}, CAST(count(id_vente) AS BIGINT) AS nb_ventes,
  CAST(sum(quantite) AS BIGINT) AS quantite_totale,
  CAST(sum(CAST(montant AS DECIMAL(18, 2))) AS DOUBLE) AS chiffre_affaires
FROM ({sales}) GROUP BY {key}"""


def both_axes(sales: str) -> str:
    return f"""
SELECT 'ca_par_ville' AS axe, ville AS cle, nb_ventes, quantite_totale, chiffre_affaires
FROM ({revenue('ville', sales)})
UNION ALL
SELECT 'ca_par_categorie', categorie, nb_ventes, quantite_totale, chiffre_affaires
FROM ({revenue('categorie', sales)})"""


def profile(source: str, key: str, columns: list[str]) -> str:
    everything = ", ".join(columns)
    per_column = " UNION ALL ".join(
        f"SELECT '{c}' AS colonne, count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS manquants "
        f"FROM {source}" for c in columns)
    return f"""
SELECT '{source}' AS source, t.lignes, t.lignes - d.n AS doublons, '{key}' AS cle,
  t.lignes - k.n AS doublons_cle, g.colonne, 'string' AS type, g.manquants
FROM ({per_column}) g,
  (SELECT count(*) AS lignes FROM {source}) t,
  (SELECT count(*) AS n FROM (SELECT DISTINCT {everything} FROM {source})) d,
  (SELECT count(*) AS n FROM (SELECT DISTINCT {key} FROM {source})) k"""


COLUMNS = {
    "ventes": ["id_vente", "date_vente", "id_client", "id_produit", "id_magasin", "quantite",
               "_fichier_source", "_ingest_date"],
    "clients": ["id_client", "nom", "ville", "segment", "_fichier_source", "_ingest_date"],
    "produits": ["id_produit", "nom_produit", "categorie", "prix_unitaire", "_fichier_source",
                 "_ingest_date"],
    "magasins": ["id_magasin", "nom_magasin", "ville", "region", "_fichier_source", "_ingest_date"],
}
KEYS = {"ventes": "id_vente", "clients": "id_client", "produits": "id_produit",
        "magasins": "id_magasin"}


def orphans(reference: str, key: str) -> str:
    return f"""
SELECT {key}, CAST(count(*) AS BIGINT) AS nb_ventes FROM ventes v
WHERE NOT EXISTS (SELECT 1 FROM {reference} r WHERE r.{key} = v.{key}) GROUP BY {key}"""


def drift(source: str) -> str:
    standard = "upper(left(trim(ville), 1)) || lower(substr(trim(ville), 2))"
    return f"""
SELECT DISTINCT '{source}' AS source, ville, CAST(length(ville) AS INTEGER) AS longueur,
  ville <> {standard} AS a_standardiser FROM {source}"""


# Messages are read with the checking engine's own JSON functions.
PARSED = """
SELECT message, partition, "offset", schema_version, id_vente, horodatage,
  CAST(NULL AS VARCHAR) AS id_caisse, id_magasin, ville, id_client, id_produit, nom_produit,
  categorie, quantite, prix_unitaire
FROM (
  SELECT message, partition, "offset",
    CAST(j->>'$.schema_version' AS INTEGER) AS schema_version,
    j->>'$.id_vente' AS id_vente, j->>'$.horodatage' AS horodatage,
    j->>'$.id_magasin' AS id_magasin, j->>'$.ville' AS ville, j->>'$.id_client' AS id_client,
    j->>'$.id_produit' AS id_produit, j->>'$.nom_produit' AS nom_produit,
    j->>'$.categorie' AS categorie,
    CASE WHEN json_type(j, '$.quantite') IN ('BIGINT', 'UBIGINT')
         THEN CAST(j->>'$.quantite' AS INTEGER) END AS quantite,
    CAST(j->>'$.prix_unitaire' AS DOUBLE) AS prix_unitaire
  FROM (SELECT *, CASE WHEN json_valid(message) AND json_type(message) = 'OBJECT'
                       THEN CAST(message AS JSON) END AS j FROM messages))"""
JUDGED = f"""
SELECT *, coalesce(id_vente IS NOT NULL AND id_magasin IS NOT NULL AND ville IS NOT NULL
  AND id_produit IS NOT NULL AND categorie IS NOT NULL AND quantite > 0 AND prix_unitaire > 0
  AND TRY_CAST(horodatage AS TIMESTAMP) IS NOT NULL, FALSE) AS conforme
FROM ({PARSED})"""
VALID = f"SELECT * EXCLUDE (message, conforme) FROM ({JUDGED}) WHERE conforme"
TYPED = f"""
SELECT * REPLACE ({city('ville')} AS ville,
    strftime(CAST(horodatage AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS horodatage),
  CAST(CAST(horodatage AS TIMESTAMP) AS DATE) AS date_vente,
  round(CAST(CAST(quantite AS DECIMAL(12, 0)) * CAST(prix_unitaire AS DECIMAL(14, 2)) AS DOUBLE), 2)
    AS montant
FROM ({VALID})"""
STATISTICS = f"""
SELECT partition, min("offset") AS premier_offset, max("offset") AS dernier_offset,
  CAST(count(*) AS BIGINT) AS recus, CAST(count(*) FILTER (conforme) AS BIGINT) AS valides,
  CAST(count(*) FILTER (NOT conforme) AS BIGINT) AS rejetes
FROM ({JUDGED}) GROUP BY partition"""

# The expected finding follows from how each file was made, not from reading it.
CONTROL = """
SELECT source, fichier, CAST(octet_length(encode(texte)) AS BIGINT) AS taille,
  sha256(texte) AS sha256,
  CASE source WHEN 'ventes' THEN 1 WHEN 'clients' THEN 2 ELSE 3 END AS rang,
  CASE WHEN fichier LIKE '%.txt' THEN 'extension .txt inattendue pour ventes (attendu : .csv)'
       WHEN source = 'ventes' AND fichier NOT LIKE '%.CSV'
       THEN 'extension (aucune) inattendue pour ventes (attendu : .csv)'
       WHEN trim(replace(texte, chr(10), '')) = '' THEN 'fichier vide'
       WHEN texte IN ('{"id_client": 1}', '[]')
       THEN 'JSON inattendu : une liste d''objets est attendue'
       WHEN texte = '<produits></produits>' THEN 'XML sans enregistrement'
       WHEN texte LIKE 'id_vente,id_client,id_magasin%'
       THEN 'champs obligatoires absents : date_vente, id_produit, quantite'
       WHEN texte LIKE '[{"id_client": "1", "nom": "a"}, {"ville": null}]'
       THEN 'champs obligatoires absents : segment'
       WHEN texte LIKE '<produits><produit><id_produit/><categorie/></produit>%'
       THEN 'champs obligatoires absents : nom_produit, prix_unitaire'
       WHEN source = 'ventes' AND instr(texte, chr(10)) = 0 THEN 'aucune ligne de données'
  END AS motif,
  CAST(CASE WHEN source = 'clients' THEN 2 WHEN source = 'produits' THEN 2
       WHEN texte LIKE '%"a%' THEN 3 ELSE 1 END AS BIGINT) AS lignes
FROM fichiers"""
AT = "2026-10-02 08:30:00"
OUTCOME = f"""
SELECT source, fichier, sha256, taille, 'REJECTED' AS statut, motif, '' AS destination,
  '_rejected/' || source || '/' || fichier AS rangement FROM ({CONTROL}) WHERE motif IS NOT NULL
UNION ALL
SELECT c.source, c.fichier, c.sha256, c.taille,
  CASE WHEN c.fichier = f.fichier THEN 'SUCCESS' ELSE 'DUPLICATE' END,
  CASE WHEN c.fichier = f.fichier THEN c.lignes || ' enregistrement(s)'
       ELSE 'contenu identique déjà ingéré le {AT} (' || f.fichier || ')' END,
  'raw/' || f.source || '/ingest_date=2026-10-02/' || f.fichier,
  '_archive/' || c.source || '/' || c.fichier
FROM ({CONTROL}) c JOIN (
  SELECT sha256, source, fichier FROM (
    SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY rang, fichier) AS n
    FROM ({CONTROL}) WHERE motif IS NULL) WHERE n = 1) f ON c.sha256 = f.sha256
WHERE c.motif IS NULL"""

BODIES = {
    "city_standard": (f"SELECT DISTINCT ville, {city('ville')} AS ville_standard FROM magasins", ["magasins"]),
    "line_amount": (f"""SELECT id_vente, quantite, prix_unitaire, montant FROM ({MATCHED})""",
                    ["ventes", "clients", "produits", "magasins"]),
    "latest_version": (SALES_LATEST, ["ventes"]),
    "drop_duplicate_keys": ("SELECT DISTINCT id_vente FROM ventes", ["ventes"]),
    "clean_sales": (f"SELECT * EXCLUDE (anomalies) FROM ({CLEAN_SALES})", ["ventes"]),
    "sales_anomalies": (f"SELECT id_vente, anomalies FROM ({CLEAN_SALES})", ["ventes"]),
    "clean_customers": (CLEAN_CUSTOMERS, ["clients"]),
    "clean_products": (CLEAN_PRODUCTS, ["produits"]),
    "clean_stores": (CLEAN_STORES, ["magasins"]),
    "reference_anomalies": (f"SELECT id_vente, anomalies FROM ({MATCHED})",
                            ["ventes", "clients", "produits", "magasins"]),
    "enrich_sales": (ENRICHED, ["ventes", "clients", "produits", "magasins"]),
    "usable_sales": (f"SELECT CAST(count(*) AS BIGINT) AS exploitables FROM ({ENRICHED})",
                     ["ventes", "clients", "produits", "magasins"]),
    "rejected_sales": (f"SELECT DISTINCT * FROM ({MATCHED}) WHERE NOT coalesce({USABLE}, FALSE)",
                       ["ventes", "clients", "produits", "magasins"]),
    "revenue_by_city": (revenue("ville", ENRICHED), ["ventes", "clients", "produits", "magasins"]),
    "revenue_by_category": (revenue("categorie", ENRICHED),
                            ["ventes", "clients", "produits", "magasins"]),
    "missing_values": ("SELECT " + ", ".join(
        f"CAST(count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS BIGINT) AS {c}"
        for c in COLUMNS["ventes"]) + " FROM ventes", ["ventes"]),
    "exact_duplicates": ("""
SELECT t.lignes, d.lignes_distinctes, t.lignes - d.lignes_distinctes AS doublons
FROM (SELECT count(*) AS lignes FROM copies) t,
     (SELECT count(*) AS lignes_distinctes FROM (SELECT DISTINCT * FROM copies)) d""", ["copies"]),
    "key_duplicates": ("""
SELECT t.lignes, d.cles_distinctes, t.lignes - d.cles_distinctes AS doublons_cle
FROM (SELECT count(*) AS lignes FROM ventes) t,
     (SELECT count(*) AS cles_distinctes FROM (SELECT DISTINCT id_vente FROM ventes)) d""", ["ventes"]),
    "repeated_keys": ("""SELECT id_vente, count(*) AS "count" FROM ventes GROUP BY 1 HAVING count(*) > 1""",
                      ["ventes"]),
    "duplicate_rows": ("""
SELECT v.*, d."count" FROM ventes v JOIN (
  SELECT id_vente, count(*) AS "count" FROM ventes GROUP BY 1 HAVING count(*) > 1) d
ON v.id_vente = d.id_vente""", ["ventes"]),
    "orphan_sales": ("""
SELECT v.* FROM ventes v
WHERE NOT EXISTS (SELECT 1 FROM produits p WHERE p.id_produit = v.id_produit)""", ["ventes", "produits"]),
    "orphan_customers": (orphans("clients", "id_client"), ["ventes", "clients"]),
    "orphan_products": (orphans("produits", "id_produit"), ["ventes", "produits"]),
    "orphan_stores": (orphans("magasins", "id_magasin"), ["ventes", "magasins"]),
    "segment_counts": ("SELECT segment, count(*) AS nombre FROM clients GROUP BY 1", ["clients"]),
    "category_counts": ("SELECT categorie, count(*) AS nombre FROM produits GROUP BY 1", ["produits"]),
    "invalid_dates": (f"SELECT id_vente, date_vente FROM ventes WHERE ({DATE.format('date_vente')}) IS NULL",
                      ["ventes"]),
    "suspicious_quantities": (f"""
SELECT id_vente, quantite FROM ventes WHERE {QUANTITY_NUMBER} IS NULL OR {QUANTITY_NUMBER} <= 0
  OR {QUANTITY_NUMBER} <> floor({QUANTITY_NUMBER})""", ["ventes"]),
    "suspicious_prices": ("""
SELECT id_produit, prix_unitaire FROM produits
WHERE TRY_CAST(prix_unitaire AS DOUBLE) IS NULL OR TRY_CAST(prix_unitaire AS DOUBLE) <= 0""", ["produits"]),
    "city_drift": (f"{drift('clients')} UNION ALL {drift('magasins')}", ["clients", "magasins"]),
    "source_profile": (" UNION ALL ".join(profile(s, KEYS[s], COLUMNS[s]) for s in COLUMNS),
                       list(COLUMNS)),
    "source_file_count": ("SELECT count(DISTINCT _fichier_source) AS nb_fichiers FROM ventes", ["ventes"]),
    "row_count": ("SELECT count(*) AS lignes FROM ventes", ["ventes"]),
    "row_preview": ("""
SELECT id_magasin, nom_magasin, ville FROM magasins ORDER BY id_magasin, nom_magasin, ville LIMIT 5""",
                    ["magasins"]),
    "lake_inventory": ("""
SELECT 'raw' AS zone, CASE WHEN octets_nom > 19 THEN source ELSE '(racine)' END AS source,
  count(*) AS objets, CAST(sum(octet_length(encode(texte))) AS BIGINT) AS octets
FROM (SELECT *, length(fichier) AS octets_nom FROM fichiers) GROUP BY 1, 2""", ["fichiers"]),
    "parse_events": (PARSED, ["messages"]),
    "valid_events": (VALID, ["messages"]),
    "rejected_events": (f'SELECT message, partition, "offset" FROM ({JUDGED}) WHERE NOT conforme',
                        ["messages"]),
    "typed_events": (TYPED, ["messages"]),
    "offset_ranges": (STATISTICS, ["messages"]),
    "stream_revenue": (both_axes(TYPED), ["messages"]),
    "stream_restart": (both_axes(TYPED), ["messages"]),
    "stream_valid_events": (TYPED, ["messages"]),
    "stream_rejected_events": (f'SELECT message, partition, "offset" FROM ({JUDGED}) WHERE NOT conforme',
                               ["messages"]),
    "stream_raw_messages": ('SELECT message, partition, "offset" FROM messages', ["messages"]),
    "stream_statistics": (STATISTICS, ["messages"]),
    "file_control": (f"""
SELECT source, fichier, taille, sha256, motif,
  CASE WHEN motif IS NULL OR motif LIKE 'champs%' THEN lignes
       WHEN motif LIKE 'aucune%' THEN 0 END AS lignes FROM ({CONTROL})""", ["fichiers"]),
    "file_fingerprint": ("SELECT source, fichier, sha256(texte) AS sha256 FROM fichiers", ["fichiers"]),
    "ingest_outcome": (OUTCOME, ["fichiers"]),
    "ingest_manifest": (f"""
SELECT o.sha256, o.fichier, o.source, o.destination, o.taille, c.lignes, '{AT}' AS date
FROM ({OUTCOME}) o JOIN ({CONTROL}) c ON o.fichier = c.fichier AND o.source = c.source
WHERE o.statut = 'SUCCESS'""", ["fichiers"]),
    "ingest_summary": (f"SELECT statut, count(*) AS fichiers FROM ({OUTCOME}) GROUP BY 1", ["fichiers"]),
    # An empty CSV field is a null.
    "sales_csv_scan": ("""
SELECT id_vente, date_vente, id_client, id_produit, id_magasin, NULLIF(quantite, '') AS quantite
FROM ventes""", ["ventes"]),
    "text_line_count": ("SELECT count(*) AS lignes FROM ventes", ["ventes"]),
    "table_round_trip": (CLEAN_PRODUCTS, ["produits"]),
    "customers_json_scan": ("SELECT id_client, nom, ville, segment FROM clients", ["clients"]),
    # The XML reader drops spaces around values.
    "products_xml_scan": ("""
SELECT trim(id_produit) AS id_produit, trim(nom_produit) AS nom_produit,
  trim(categorie) AS categorie, prix_unitaire FROM produits""", ["produits"]),
    "stores_xlsx_scan": ("SELECT id_magasin, nom_magasin, ville, region FROM magasins", ["magasins"]),
    "batch_revenue": (both_axes(ENRICHED), ["ventes", "clients", "produits", "magasins"]),
}

# A whole table with every order line of suppliers 0, 10, 20, ... once more.
COPIES = "SELECT * FROM ventes UNION ALL SELECT * FROM ventes WHERE id_magasin LIKE '%0'"


def oracle() -> dict[str, str]:
    statements = {}
    for name, (body, sources) in BODIES.items():
        ctes = [f"{s} AS ({source_sql(s)})" for s in sources if s != "copies"]
        if "copies" in sources:
            ctes = [f"ventes AS ({source_sql('ventes')})", f"copies AS ({COPIES})"]
        statements[name] = f"WITH {', '.join(ctes)}\n{body.strip()}"
    return {**statements, **{name: text.strip() for name, text in landing.ORACLE.items()}}
