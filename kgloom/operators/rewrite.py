"""Endpoint rewriting through an id map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named, with_prefix
from .keys import own_shuffle


def id_map(nodes: DataFrame) -> DataFrame:
    """One identifier per id; the largest wins where an id has several."""
    return nodes.where("id is not null").groupBy("id").agg(F.max("identifier").alias("identifier"))


def rewrite_endpoints(
    edges: DataFrame,
    mapping: DataFrame,
    columns: tuple[str, ...] = ("subject",),
    prefix_predicate: bool = False,
) -> DataFrame:
    """Replace endpoints found in ``mapping`` (id, identifier); others stay.

    ``mapping`` must hold each id once. Edges are the left side of every join,
    so a frequent endpoint can be split over tasks.
    """
    order = edges.columns
    for i, column in enumerate(columns):
        key, value = f"__id{i}", f"__identifier{i}"
        lookup = mapping.select(own_shuffle(named("id")).alias(key), named("identifier").alias(value))
        edges = edges.join(lookup, named(column).cast("string") == F.col(key), "left")
        edges = edges.withColumn(column, F.coalesce(F.col(value), named(column).cast("string"))).drop(key, value)
    if prefix_predicate:
        edges = edges.withColumn("predicate", with_prefix(named("predicate")))
    return edges.select(*[named(c) for c in order])
