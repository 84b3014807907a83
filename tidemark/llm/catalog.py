"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import importlib

MODULES = ["op1_extract", "op2_simhash", "op3_lines", "op4_ann", "op5_quality", "op6_chat", "op7_decontaminate", "op8_mixing", "op9_warc", "op10_secrets",
           "op11_spelling", "op12_rules", "op13_phrases"]


def load() -> tuple[dict, dict]:
    queries, sql = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"tidemark.llm.{m}")
        queries.update(mod.QUERIES)
        sql.update(mod.ORACLES)
    return queries, sql
