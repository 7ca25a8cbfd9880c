"""Small files of the four sources for tests."""

import io
import json
import zipfile
from pathlib import Path

from comptoir.catalog.files import PARTS, workbook

SALES_HEADER = "id_vente,date_vente,id_client,id_produit,id_magasin,quantite"


def put(path: Path, content) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return path


def sales_csv(*lines, header=SALES_HEADER, bom=False) -> str:
    return ("﻿" if bom else "") + "\n".join([header, *lines]) + "\n"


def customers_json(*rows) -> str:
    names = ("id_client", "nom", "ville", "segment")
    return json.dumps([dict(zip(names, row)) for row in rows], indent=1, ensure_ascii=False)


def products_xml(*rows) -> str:
    names = ("id_produit", "nom_produit", "categorie", "prix_unitaire")
    body = "".join("<produit>" + "".join(f"<{n}>{v}</{n}>" for n, v in zip(names, row)) + "</produit>"
                   for row in rows)
    return f"<?xml version='1.0' encoding='utf-8'?>\n<produits>{body}</produits>"


def stores_xlsx(*rows) -> bytes:
    return workbook([["id_magasin", "nom_magasin", "ville", "region"], *map(list, rows)])


def workbook_of(parts: dict) -> bytes:
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w") as archive:
        for name, text in {**PARTS, **parts}.items():
            archive.writestr(name, text)
    return target.getvalue()
