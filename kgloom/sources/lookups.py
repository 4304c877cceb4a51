"""Small lookup tables of the graph-cleaning job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named
from .delimited import read_lines_tsv, with_ordinal

NORMALIZATION_RECORD = T.StructType(
    [
        T.StructField("id", T.StructType([
            T.StructField("identifier", T.StringType()),
            T.StructField("label", T.StringType()),
        ])),
        T.StructField("equivalent_identifiers", T.ArrayType(T.StructType([
            T.StructField("identifier", T.StringType()),
            T.StructField("label", T.StringType()),
        ]))),
        T.StructField("type", T.ArrayType(T.StringType())),
        T.StructField("information_content", T.FloatType()),
    ]
)


def _keyed(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key, the last one in the file winning."""
    rows = with_ordinal(rows)
    return rows.groupBy(*keys).agg(F.max_by(value, "_ordinal").alias(value))


def read_predicate_info(spark: SparkSession, path: str) -> DataFrame:
    """(subject, predicate, object) categories to the edge file holding them."""
    rows = read_lines_tsv(spark, path)
    names = ["subject", "predicate", "object", "file"]
    rows = rows.toDF(*names, *rows.columns[4:]).where(F.col("file").isNotNull())
    return _keyed(rows, names[:3], "file").select(*names)


def read_category_info(spark: SparkSession, path: str, include: list[str]) -> DataFrame:
    """Category to node file, for lines that contain one of the ``include`` texts."""
    rows = read_lines_tsv(spark, path)
    line = F.concat_ws("\t", *[named(c) for c in rows.columns])
    wanted = F.exists(F.array(*[F.lit(t) for t in include]), lambda t: line.contains(t))
    rows = rows.where(wanted)
    rows = rows.toDF("category", "file", *rows.columns[2:]).where(F.col("file").isNotNull())
    return _keyed(rows, ["category"], "file").select("category", "file")


def json_entries(json: Column, kind: T.DataType) -> Column:
    """JSON object to a map: key to its value of the given type, or to null."""
    return F.from_json(json, T.MapType(T.StringType(), kind))


def normalization_entries(json: Column) -> Column:
    """JSON object to a map: identifier to its record, or to null."""
    return json_entries(json, NORMALIZATION_RECORD)


def read_normalization(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Normalization responses, one JSON object per line, one row per entry."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths)
    entries = lines.select(F.explode(normalization_entries(F.col("value"))).alias("identifier", "record"))
    return entries.select(
        "identifier",
        F.col("record.id.identifier").alias("preferred_identifier"),
        F.col("record.id.label").alias("label"),
        F.col("record.equivalent_identifiers").alias("equivalent_identifiers"),
        F.col("record.type").alias("types"),
        F.col("record.information_content").alias("information_content"),
    )
