from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kgloom.session import materialized, scratch_path


def named_root(root, master="local[2]"):
    conf = SimpleNamespace(get=lambda key, default=None: root)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session():
    assert scratch_path(named_root("s3a://shared/ck/"), "x").startswith("s3a://shared/ck/x-")
    local = [scratch_path(named_root(None), "x").rsplit("/", 1)[0] for _ in range(2)]
    assert local[0] == local[1]
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch_path(named_root(None, master), "x")


def test_materialized(spark, rows):
    df = spark.range(3).select("id", F.lit(None).alias("none"), F.lit("x").alias("a:b.c"))
    stored = materialized(df, "test")
    assert stored.columns == df.columns
    assert rows(stored) == [(i, None, "x") for i in range(3)]
