"""Session settings the jobs expect, and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECOMMENDED = {
    # headers may differ by case only
    "spark.sql.caseSensitive": "true",
    # runtime re-planning: partition coalescing, join switching, skewed left joins
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "kgloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_root() -> str:
    """A folder of this process, gone when it ends."""
    folder = tempfile.TemporaryDirectory(prefix="kgloom-")
    atexit.register(folder.cleanup)
    return folder.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder the cluster names for checkpoints.

    Only a local session, whose executors are this machine, may do without: it
    gets a temporary folder. A cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a result used several times whose lineage is long: it is computed once
    and outlives the executors that computed it.
    """
    untyped = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    if untyped:
        df = df.withColumns({n: F.lit(None).cast("string") for n in untyped})
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
