"""Collects every registered query and its SQL oracle."""

from __future__ import annotations

import importlib

MODULES = ["q_quality", "q_indicators", "q_outcomes", "q_ranges", "q_misc", "q_ml", "q_live", "q_touch", "q_more", "q_stream", "q_io"]


def load():
    queries, sql = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"tidemark.catalog.{m}")
        queries.update(mod.QUERIES)
        sql.update(mod.SQL)
    return queries, {k: v for k, v in sql.items() if k in queries}
