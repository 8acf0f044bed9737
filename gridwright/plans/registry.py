"""All queries of the core, by name, each with its SQL where SQL can express it."""

from __future__ import annotations

import importlib

MODULES = ("p5", "usage_plans", "text_plans", "qa_plans", "io_plans", "bot_plans", "more_plans", "last_plans", "final_plans", "rule_plans", "page_plans", "layer_plans", "gate_plans")


def collect() -> tuple[dict, dict]:
    queries: dict = {}
    oracles: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"gridwright.plans.{name}")
        queries |= module.QUERIES
        oracles |= module.ORACLES
    return queries, oracles
