"""All registered queries of the memory engine and their DuckDB twins, from the modules that hold them."""

from __future__ import annotations

from . import evaluation_queries, fact_check_queries, format_queries, identity_queries, mining_queries, name_queries, recall_queries, search_queries, source_queries, store_queries, text_queries, upkeep_queries  # noqa: F401  (they register themselves)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "entry"]


def entry(spark, sf_dir):
    """The flagship query: hybrid search."""
    return search_queries.search_vector(spark, sf_dir)
