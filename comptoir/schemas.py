"""Table layouts and fixed texts of the retail model.

The strings below are fixed values: stored tables and journals hold them, so they
must stay exactly as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns every file of a source must carry.
REQUIRED_FIELDS = {
    "ventes": ["id_vente", "date_vente", "id_client", "id_produit", "id_magasin", "quantite"],
    "clients": ["id_client", "nom", "ville", "segment"],
    "produits": ["id_produit", "nom_produit", "categorie", "prix_unitaire"],
    "magasins": ["id_magasin", "nom_magasin", "ville", "region"],
}

# Accepted file extensions per source, in the order sources are processed.
EXTENSIONS = {
    "ventes": [".csv"],
    "clients": [".json"],
    "produits": [".xml"],
    "magasins": [".xlsx"],
}

# The identifier of each source.
KEYS = {
    "ventes": "id_vente",
    "clients": "id_client",
    "produits": "id_produit",
    "magasins": "id_magasin",
}

# Labels written into tables.
DATE_MISSING = "date absente"
DATE_INVALID = "date invalide"
QUANTITY_MISSING = "quantite absente"
QUANTITY_ZERO = "quantite nulle"
QUANTITY_NEGATIVE = "quantite negative"
CUSTOMER_UNKNOWN = "client inconnu"
PRODUCT_UNKNOWN = "produit inconnu"
STORE_UNKNOWN = "magasin inconnu"
SEGMENT_DEFAULT = "Non renseigné"
CATEGORY_DEFAULT = "Non renseignée"
CUSTOMER_LABEL = "Client inconnu"
STORE_LABEL = "Magasin inconnu"
UNKNOWN_MASCULINE = "Inconnu"
UNKNOWN_FEMININE = "Inconnue"
FIRST_INGEST_DATE = "1970-01-01"

SOURCE_FILE = "_fichier_source"
INGEST_DATE = "_ingest_date"

# The columns of the enriched sales table, in order.
ENRICHED_COLUMNS = [
    "id_vente", "date_vente", "id_client", "nom_client", "segment", "ville_client",
    "id_produit", "nom_produit", "categorie", "id_magasin", "nom_magasin", "ville", "region",
    "quantite", "prix_unitaire", "montant", "anomalies",
]


def text_schema(source: str) -> T.StructType:
    """All-string schema of a source: typing is an explicit later step."""
    return T.StructType([T.StructField(name, T.StringType()) for name in REQUIRED_FIELDS[source]])


# The contract of one sales event and the fields it cannot do without.
EVENT_SCHEMA = (
    "schema_version int, id_vente string, horodatage string, id_caisse string, id_magasin string, "
    "ville string, id_client string, id_produit string, nom_produit string, categorie string, "
    "quantite int, prix_unitaire double"
)
EVENT_REQUIRED = [
    "id_vente", "horodatage", "id_magasin", "ville", "id_produit", "categorie",
    "quantite", "prix_unitaire",
]

# What a message source has to deliver, Kafka or any other.
ENVELOPE_SCHEMA = "value binary, partition int, offset bigint, timestamp timestamp"
