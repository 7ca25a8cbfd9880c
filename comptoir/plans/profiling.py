"""Profile of the raw sources."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comptoir.operators import profiling as P
from comptoir.operators.joins import all_of
from comptoir.schemas import KEYS


def profile_sources(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every report by name; nothing is corrected and nothing runs until a report is read."""
    sales = raw["ventes"]
    reports = {
        "profil": all_of([P.source_profile(name, rows, KEYS[name]) for name, rows in raw.items()]),
        "dates": P.invalid_dates(sales),
        "quantites": P.suspicious_quantities(sales),
        "doublons": P.duplicate_rows(sales, KEYS["ventes"]),
        "villes": all_of([P.city_drift(name, raw[name]) for name in ("clients", "magasins")]),
        "segments": P.value_counts(raw["clients"], "segment"),
        "categories": P.value_counts(raw["produits"], "categorie"),
        "prix": P.suspicious_prices(raw["produits"]),
    }
    for name in ("clients", "produits", "magasins"):
        reports[f"orphelins_{name}"] = P.orphan_keys(sales, raw[name], KEYS[name])
    return reports
