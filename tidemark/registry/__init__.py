"""Queries over the driver's tables, each beside the SQL that checks it."""

from importlib import import_module

AREAS = ("sales", "views", "standings", "catalog", "core", "models")


def _areas():
    return [import_module(f"{__name__}.{area}") for area in AREAS]


def all_queries() -> dict:
    return {name: run for area in _areas() for name, run in area.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: text for area in _areas() for name, text in area.SQL.items()}
