"""Value counts, rankings of them, and shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import named


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Counts of every value of many columns in one pass: (column_name, value, counts).

    Null is a value. Values are text. The table is unpivoted and counted with
    map-side combining, whatever the number of columns.
    """
    columns = df.columns if columns is None else columns
    cells = df.select(*[named(c).cast("string").alias(c) for c in columns])
    long = cells.unpivot([], [named(c) for c in columns], "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("counts"))


def _ranked(counts: DataFrame, k: int, from_end: bool) -> DataFrame:
    if from_end:
        order = [F.asc("counts"), F.desc_nulls_first("value")]
    else:
        order = [F.desc("counts"), F.asc_nulls_last("value")]
    by_column = Window.partitionBy("column_name").orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(by_column)).where(F.col("rank") <= k)


def top_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent values per column; ties by value, nulls last."""
    return _ranked(counts, k, from_end=False)


def head_tail_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k most and the k least frequent values per column, stacked.

    ``position`` runs through head, then tail, both by falling count. A column
    with fewer than 2k values repeats rows, as both ends show them.
    """
    head = _ranked(counts, k, from_end=False).withColumn("section", F.lit("head"))
    tail = _ranked(counts, k, from_end=True).withColumn("section", F.lit("tail"))
    both = head.unionAll(tail)
    # at most 2k rows per column reach this window
    size = F.max("rank").over(Window.partitionBy("column_name"))
    position = F.when(F.col("section") == "head", F.col("rank")).otherwise(2 * size - F.col("rank") + 1)
    return both.select(
        "column_name", "section", position.cast("int").alias("position"), "value", "counts"
    )


def wide_counts(ranked: DataFrame, columns: list[str]) -> DataFrame:
    """Ranked counts side by side: per column its values and its counts, by position.

    The pairs are named ``c`` and ``c_counts``; short columns end in nulls.
    """
    pick = []
    for c in columns:
        own = F.col("column_name") == c
        pick.append(F.max(F.when(own, F.col("value"))).alias(c))
        pick.append(F.max(F.when(own, F.col("counts"))).alias(c + "_counts"))
    return ranked.groupBy("position").agg(*pick)


def table_shape(df: DataFrame) -> DataFrame:
    """Row count and column count as one row."""
    return df.agg(F.count("*").alias("num_rows")).withColumn("num_columns", F.lit(len(df.columns)))


def file_shapes(spark: SparkSession, paths: list[str], sep: str = "\t") -> DataFrame:
    """Per file: lines, header included, and columns of the first line."""
    rows = spark.read.option("lineSep", "\n").text(paths)
    fields = F.size(F.split("value", "\\Q" + sep + "\\E", -1))
    # only a file's first block holds its header; rows are numbered in file order
    order = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    lines = rows.select(F.col("_metadata.file_path").alias("file"), fields.alias("fields"), order.alias("order"))
    return lines.groupBy("file").agg(
        F.count("*").alias("num_lines"), F.min_by("fields", "order").alias("num_columns")
    )
