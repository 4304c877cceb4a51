"""Distinct by key, keeping the first row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import named


def keep_first(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """One row per key: the first under ``order_by``.

    Spark limits every map partition to one row per key before the shuffle, so
    a key holding much of the table does not reach a single task. Null keys are
    equal to each other here.
    """
    order = [named(o) if isinstance(o, str) else o for o in order_by]
    by_key = Window.partitionBy(*[named(k) for k in keys]).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(by_key))
    return ranked.where("__rank = 1").drop("__rank")
