"""Compact identifiers (``PREFIX:local``) from a source name and a local id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import named, pad_left

# fixed values: sources by the way their ids are written
PADDED_SOURCES = ["HPO", "MONDO", "UBERON"]
PLAIN_SOURCES = ["CTD", "GO", "DrugBank"]
GROUPED_SOURCE = "MONDO_grouped"
GROUP_SEPARATOR = "_"


def edge_curie(source: Column, local: Column, padded_sources: list[str] = PADDED_SOURCES) -> Column:
    """Endpoint identifier of a relation row; an unknown source stands alone.

    The tests exclude each other, so one CASE states them all. A missing local
    id leaves the bare prefix, because joined parts skip nulls.
    """
    return (
        F.when(source == "NCBI", F.concat_ws("Gene:", source, local))
        .when(source.contains("REACTOME"), F.concat_ws(":", F.lit("REACT"), local))
        .when(source.isin(padded_sources), F.concat_ws(":", source, pad_left(local)))
        .when(source.isin(PLAIN_SOURCES), F.concat_ws(":", source, local))
        .otherwise(source)
    )


def with_node_curie(df: DataFrame, source: str, local: str, grouped_local: str) -> DataFrame:
    """Rewrite ``source`` to the node identifier, one rule after the other.

    Every rule looks at the text left by the rule before it, which matters when
    an id itself contains a later rule's marker. Each step is a projection that
    Spark keeps apart, so the expression does not grow with the rules.
    """
    value = named(source)
    steps = [
        (value.contains("NCBI"), F.concat_ws("Gene:", value, named(local))),
        (value.contains("REACTOME"), F.concat_ws(":", F.lit("REACT"), named(local))),
        (value.isin(PADDED_SOURCES), F.concat_ws(":", value, pad_left(named(local)))),
        (value.isin(PLAIN_SOURCES), F.concat_ws(":", value, named(local))),
        (value.contains(GROUPED_SOURCE), F.concat_ws(":", F.lit("MONDO"), pad_left(named(grouped_local)))),
    ]
    for test, result in steps:
        df = df.withColumn(source, F.when(test, result).otherwise(value))
    return df
