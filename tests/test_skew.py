"""Hot keys: adaptive execution must be able to split the large side of each join."""

import contextlib

import pytest
from pyspark.sql import functions as F

from kgloom import operators as ops
from kgloom import plans

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40000",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def graph(spark, tmp_path_factory):
    """A third of the edges start at one node, a third end at one, a third of the nodes share an id."""
    root = tmp_path_factory.mktemp("skew")
    n = F.col("id")
    cold = F.pmod(F.xxhash64(n), F.lit(5_000))
    edges = spark.range(0, 120_000, 1, 16).select(
        F.concat(F.lit("A:"), F.when(n % 3 == 0, 0).otherwise(cold)).alias("subject"),
        F.lit("p").alias("predicate"),
        F.concat(F.lit("A:"), F.when(n % 3 == 1, 1).otherwise(F.pmod(cold * 7, F.lit(5_000)))).alias("object"),
        F.sha2(n.cast("string"), 256).alias("w"),
    )
    nodes = spark.range(0, 120_000, 1, 16).select(
        F.concat(F.lit("A:"), F.when(n % 3 == 0, 0).otherwise(n % 5_000)).alias("id"),
        F.when(n % 2 == 0, "Gene").otherwise("Protein").alias("category"),
        F.concat(F.lit("I:"), n % 5_000).alias("identifier"),
        F.sha2(n.cast("string"), 256).alias("w"),
    )
    edges.withColumn("file", F.lit("f0")).write.parquet(str(root / "e"))
    nodes.write.parquet(str(root / "n"))
    return spark.read.parquet(str(root / "n")), spark.read.parquet(str(root / "e"))


def split_joins(df):
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    frame_rows = df.collect()
    text = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    return text.count("skew=true"), frame_rows


@pytest.mark.parametrize(
    "job, splits",
    [
        (lambda n, e: ops.rewrite_endpoints(e, ops.id_map(n), ("subject", "object")), 2),
        (lambda n, e: ops.rows_with_id(n, ops.endpoint_ids(e)), 1),
        (lambda n, e: ops.rows_with_either_id(e, n.select("id")), 2),
        (lambda n, e: plans.rewrite_raw_edges(e, n), 1),
    ],
    ids=["rewrite", "rows_with_id", "rows_with_either_id", "raw_edges"],
)
def test_hot_partitions_are_split(spark, graph, job, splits):
    nodes, edges = graph
    plain = job(nodes, edges)
    want = plain.agg(F.count("*"), F.sum(F.xxhash64(*plain.columns).cast("decimal(38,0)"))).first()
    with settings(spark, SMALL_PARTITIONS):
        df = job(nodes, edges)
        found, rows = split_joins(df)
        assert found >= splits
        again = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    assert tuple(again) == tuple(want) and len(rows) == want[0]


def test_raw_edges_with_files(spark, graph):
    nodes, edges = graph
    info = spark.createDataFrame(
        [("Gene", "p", "Gene", "f0"), ("Protein", "p", "Gene", "f0")], "subject string, predicate string, object string, file string"
    )
    with settings(spark, SMALL_PARTITIONS):
        found, rows = split_joins(plans.rewrite_raw_edges(edges, nodes, info))
    assert found >= 1 and len(rows) == 120_000
