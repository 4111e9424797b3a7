"""All registered queries of the library and their SQL for a second engine."""

from __future__ import annotations

from lexforge.plans import catalog, documents  # noqa: F401 - documents registers its queries in catalog's tables


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.SQL)
