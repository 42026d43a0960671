"""The registry of this subpackage's queries and their SQL."""

from __future__ import annotations

import importlib

#: query -> module that has it
_WHERE = {
    "op1_langid": "langcode",
    "op2_byte_bpe": "bpe",
    "op3_url_filter": "urlrules",
    "op4_warc": "warc",
    "op5_packed_ids": "packed",
    "op6_token_counts": "unigram",
    "op7_suffix_dedup": "suffixdedup",
    "op8_quality_rules": "quality",
    "op9_decontaminate": "decontam",
    "op10_near_duplicates": "neardup",
    "op11_spelling_variants": "spelling",
    "op12_secret_novelty": "novelty",
    "op13_collocations": "collocations",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"textmill.llm.{module}"), name) for name, module in _WHERE.items()}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, module in _WHERE.items():
        found |= {k: v for k, v in getattr(importlib.import_module(f"textmill.llm.{module}"), "ORACLE_SQL", {}).items() if k == name}
    return found
