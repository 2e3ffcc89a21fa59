"""Queries ``opN_<name>`` of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as q
from .oracle import ORACLE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": q.op1_toxicity,
    "op2_quality_rules": q.op2_quality_rules,
    "op3_suffix_dedup": q.op3_suffix_dedup,
    "op4_licences": q.op4_licences,
    "op5_neighbours": q.op5_neighbours,
    "op6_packing": q.op6_packing,
    "op7_jaccard": q.op7_jaccard,
    "op8_mixing": q.op8_mixing,
    "op9_substring": q.op9_substring,
    "op10_pii": q.op10_pii,
    "op11_main_text": q.op11_main_text,
    "op12_ranked_search": q.op12_ranked_search,
    "op13_periodic_runs": q.op13_periodic_runs,
}

__all__ = ["QUERIES", "ORACLE_SQL"]
