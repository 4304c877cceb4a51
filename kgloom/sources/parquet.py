"""Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Append parquet inputs that must share one schema (names, order, types)."""
    if not paths:
        raise ValueError("no input files")

    def shape(path: str) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(path).schema]

    first = shape(paths[0])
    for path in paths[1:]:
        if shape(path) != first:
            raise ValueError(f"schema of {path} differs from {paths[0]}")
    return spark.read.parquet(*paths)
