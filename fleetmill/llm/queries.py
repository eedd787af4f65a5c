"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = {
    "op4_license_scan": "op4_licenses",
    "op6_url_filter": "op6_urls",
    "op10_decontaminate": "op10_decontaminate",
    "op5_secret_scan": "op5_secrets",
    "op3_permutation_index": "op3_neighbours",
    "op1_quality_rules": "op1_quality",
    "op8_language_id": "op8_language",
    "op2_ngram_jaccard": "op2_jaccard",
    "op7_token_counts": "op7_tokens",
    "op9_best_fit_packing": "op9_packing",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: import_module(f"{__package__}.{module}").query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"{__package__}.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
