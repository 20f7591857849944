"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query and the module that holds it.
_QUERIES = {
    "op10_quality": "quality",
    "op3_license_scan": "license_scan",
    "op6_decontamination": "decontaminate",
    "op1_pii": "pii",
    "op4_embedding_dedup": "embedding_dedup",
    "op5_warc": "warc",
    "op2_token_output": "token_output",
    "op7_simhash": "simhash",
    "op8_packing": "packing",
    "op9_substring_dedup": "substring_dedup",
    "op11_divergence": "divergence",
    "op12_ball_kmeans": "ball_kmeans",
    "op13_suffix_dedup": "suffix_dedup",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express at a bearable cost."""
    from . import ball_kmeans, divergence, warc

    return {"op5_warc": warc.OP5_SQL, "op11_divergence": divergence.OP11_SQL, "op12_ball_kmeans": ball_kmeans.OP12_SQL}
