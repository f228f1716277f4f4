"""Registered queries: the operators applied to the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import importlib

from .registry import REGISTRY, Query

MODULES = ["scalars", "relational", "calendars", "checks", "expectations", "engagement", "identity", "progress", "ledgers", "finance", "marketing", "alerts",
           "storage", "streams"]


def load_all() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return REGISTRY
