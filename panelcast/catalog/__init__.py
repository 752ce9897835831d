"""The registered queries and, where SQL can say it, the same result as DuckDB SQL."""

from __future__ import annotations

import importlib

SECTIONS = ["scans", "projections", "joins", "aggregations", "windows", "scalars", "streams", "modeling"]


def _load() -> None:
    for section in SECTIONS:
        importlib.import_module(f"panelcast.catalog.{section}")


def all_queries():
    from panelcast.catalog.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from panelcast.catalog.registry import ORACLES

    _load()
    return dict(ORACLES)
