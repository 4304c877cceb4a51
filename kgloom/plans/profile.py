"""Profiles of tables and files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators.columns import select_by_prefix
from ..operators.counts import head_tail_counts, table_shape, top_counts, value_counts
from ..sources.parquet import read_parquet_files


def superfluous_value_counts(df: DataFrame, ignore: Iterable[str] = (), k: int = 10) -> DataFrame:
    """Most and least frequent values of the columns marked with a leading ``_``."""
    return head_tail_counts(value_counts(select_by_prefix(df, include="_", ignore=ignore)), k)


def profile_parquet(
    spark: SparkSession, paths: list[str], k: int = 10
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(top values per column of the first file, shape of all files, all rows)."""
    rows = read_parquet_files(spark, paths)
    first = read_parquet_files(spark, paths[:1])
    return top_counts(value_counts(first), k), table_shape(rows), rows
