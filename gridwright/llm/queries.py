"""All queries of the subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

import importlib

MODULES = ("queries_p1", "queries_p2", "queries_p3", "queries_p4", "queries_p6", "queries_p7", "queries_p8")

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = importlib.import_module(f"gridwright.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
