"""Schema snapshot scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COLUMN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("datatype", T.StringType()),
        T.StructField("samples", T.ArrayType(T.StringType())),
    ]
)
SNAPSHOT_SCHEMA = T.StructType(
    [T.StructField("nodes", T.ArrayType(_COLUMN)), T.StructField("edges", T.ArrayType(_COLUMN))]
)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot JSON as rows (table_name, ordinal, name, datatype, samples)."""
    document = spark.read.schema(SNAPSHOT_SCHEMA).json(path, multiLine=True)
    parts = [
        document.select(F.lit(table).alias("table_name"), F.posexplode(table).alias("ordinal", "column"))
        for table in ("nodes", "edges")
    ]
    return parts[0].unionAll(parts[1]).select("table_name", "ordinal", "column.*")
