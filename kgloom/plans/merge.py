"""Merges of node and edge files with their fixed column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import vocab
from ..operators.merge import merge_tables


def merge_edges(dfs: list[DataFrame], unique_keys: bool = False, **options) -> DataFrame:
    return merge_tables(
        dfs,
        ["subject", "predicate", "object"],
        vocab.EDGE_COALESCE_COLUMNS,
        unique_keys=unique_keys,
        **options,
    )


def merge_nodes(dfs: list[DataFrame], unique_keys: bool = False, **options) -> DataFrame:
    """Always has a ``name`` column, between ``id`` and ``category``."""
    return merge_tables(
        dfs,
        ["id", "category"],
        vocab.NODE_COALESCE_COLUMNS,
        leading=["id", "name", "category"],
        unique_keys=unique_keys,
        **options,
    )
