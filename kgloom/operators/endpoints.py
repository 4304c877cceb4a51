"""Edge endpoints and their match with the nodes table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .keys import own_shuffle

ENDPOINTS = ("subject", "object")


def endpoint_ids(edges: DataFrame, distinct: bool = True) -> DataFrame:
    """Subjects and objects as one ``id`` column, from a single scan."""
    ids = edges.select(F.explode(F.array(*[named(c) for c in ENDPOINTS])).alias("id"))
    return ids.distinct() if distinct else ids


def endpoint_check(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids found on one side only, as (side, id) with side ``nodes`` or ``edges``.

    Both differences come from one aggregation: ids are tagged with the side
    they come from, combined map-side, and shuffled once.
    """
    tagged = nodes.select(named("id").cast("string").alias("id"), F.lit(1).alias("side")).unionAll(
        endpoint_ids(edges, distinct=False).select(named("id").cast("string"), F.lit(2))
    )
    sides = tagged.where("id is not null").groupBy("id").agg(F.bit_or("side").alias("sides"))
    return sides.where("sides < 3").select(
        F.when(F.col("sides") == 1, "nodes").otherwise("edges").alias("side"), "id"
    )


def rows_with_id(df: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose ``column`` equals one of the ``id`` values."""
    wanted = ids.select("id").distinct().select(own_shuffle(named("id")).alias("__wanted"))
    return df.join(wanted, named(column).cast("string") == F.col("__wanted"), "left_semi")


def rows_with_either_id(df: DataFrame, ids: DataFrame, columns: tuple[str, ...] = ENDPOINTS) -> DataFrame:
    """Rows in which any of ``columns`` equals one of the ``id`` values.

    One left join per column sets a flag. The id side holds each id once, so a
    frequent endpoint only grows the left side, which Spark can split.
    """
    flags = []
    for i, column in enumerate(columns):
        key, flag = f"__wanted{i}", f"__flag{i}"
        wanted = ids.select("id").distinct().select(own_shuffle(named("id")).alias(key), F.lit(True).alias(flag))
        df = df.join(wanted, named(column).cast("string") == F.col(key), "left").drop(key)
        flags.append(flag)
    return df.where(F.coalesce(*flags)).drop(*flags)
