"""Imports every query module so the catalog is complete."""

from __future__ import annotations

import importlib

from dockcast.plans.catalog import ORACLE, QUERIES, SPECS

MODULES = ("q_panel", "q_weather", "q_asof", "q_files", "q_metrics", "q_serving", "q_ingest", "q_online", "q_models")


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"dockcast.plans.{m}")


def queries():
    load()
    return dict(QUERIES)


def oracle_sql():
    load()
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "SPECS"]
