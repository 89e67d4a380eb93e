"""Registered queries and their oracle SQL."""

from __future__ import annotations

import importlib
from types import SimpleNamespace

MODULES = ["q_text", "q_tables", "q_match", "q_retrieval", "q_models", "q_streams"]


def all_queries() -> SimpleNamespace:
    for name in MODULES:
        try:
            importlib.import_module(f"checks.{name}")
        except ModuleNotFoundError as e:
            if e.name != f"checks.{name}":
                raise
    from checks.registry import ORACLES, QUERIES
    return SimpleNamespace(queries=QUERIES, oracles=ORACLES)
