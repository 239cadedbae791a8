"""All registered queries."""

from __future__ import annotations

from fleet.queries import files, media, registry, relational, series, training, vectors  # noqa: F401


def all_queries():
    return dict(registry.QUERIES)


def all_sql():
    return dict(registry.SQL)
