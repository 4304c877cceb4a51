"""Sub-graph samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.endpoints import endpoint_ids, rows_with_either_id, rows_with_id
from ..operators.substring import ids_containing
from ..session import materialized

# Hex digits of a hash that part the ids into ranges of it.
RANGE_DIGITS = 4


def first_ids(ids: DataFrame, size: int) -> DataFrame:
    """The first ``size`` ids in id order, nulls last.

    Ranges of ids, from a sample, are counted; the sums over ranges tell which
    of them lie wholly among the first, and in which one the cut falls. Only
    that range is ranked, so no task holds all the ids that are taken.
    """
    named_ids = ids.select("id")
    # null comes after every id
    dealt = named_ids.repartitionByRange(F.asc_nulls_last("id")).sortWithinPartitions(F.asc_nulls_last("id"))
    placed = dealt.select("id", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__row"))
    placed = materialized(placed, "id-ranges")
    # one row a range
    before = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    starts = starts.select("__range", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return placed.join(F.broadcast(starts), "__range").where(F.col("__row") + F.col("__shift") < size).select("id")


def draw_ids(spark: SparkSession, ids: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """``size`` draws with replacement from distinct ids, as (id, times).

    The ids are numbered in the order of a seeded hash: ranges of the hash are
    counted (at most 65,536 of them), their sums tell where each range begins,
    and ids are numbered within their range. Draw ``k`` takes the number that a
    hash of ``k`` points to, so equal seeds give equal draws. Neither ids nor
    draws meet in one task.
    """
    named_ids = ids.select("id").where("id is not null")
    hashed = named_ids.withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}:"), "id")))
    hashed = hashed.withColumn("__range", F.substring("__hash", 1, RANGE_DIGITS))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = hashed.groupBy("__range").agg(F.count("*").alias("__n"))
    starts = starts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__range").orderBy("__hash", "id")
    numbered = hashed.withColumn("__place", F.row_number().over(within)).join(F.broadcast(starts), "__range")
    numbered = numbered.select("id", (F.col("__start") + F.col("__place") - 1).alias("__number"))
    total = named_ids.agg(F.count("*")).scalar()
    pointed = F.conv(F.substring(F.md5(F.concat(F.lit(f"draw:{seed}:"), F.col("id").cast("string"))), 1, 12), 16, 10)
    draws = spark.range(size).select(pointed.cast("long").alias("__to"))
    times = draws.select((F.col("__to") % F.nullif(total, F.lit(0))).alias("__number")).groupBy("__number").agg(F.count("*").alias("times"))
    return numbered.join(times, "__number").select("id", "times")


def sample_subgraph(
    nodes: DataFrame,
    edges: DataFrame,
    size: int = 100,
    random: bool = False,
    seed: int = 0,
    match: str = "substring",
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) around ``size`` endpoint ids, the first ones or drawn ones.

    Edges are taken when subject or object matches a chosen id, nodes when their
    id matches an endpoint of such an edge. ``substring`` matching lets an id
    select every longer text containing it; ``exact`` needs equality.

    Substrings are searched in the distinct ids, not in the edges. With
    ``materialize`` the endpoint ids, the chosen and the matching ones and the
    sampled edges are written to the shared folder at once: the joins on them
    then start from their true size, and what is needed several times is
    computed once. Without, only the choice of the first ids runs here.
    """
    if match not in ("substring", "exact"):
        raise ValueError(f"match must be 'substring' or 'exact', not {match!r}")
    def settled(df: DataFrame, label: str) -> DataFrame:
        return materialized(df, label) if materialize else df

    ids = settled(endpoint_ids(edges).where("id is not null"), "endpoint-ids")
    chosen = draw_ids(edges.sparkSession, ids, size, seed) if random else first_ids(ids, size)
    chosen = settled(chosen.select("id"), "chosen-ids")
    if match == "substring":
        chosen = settled(ids_containing(ids, chosen), "matching-ids")
    sampled = settled(rows_with_either_id(edges, chosen), "sampled-edges")
    ends = endpoint_ids(sampled)
    if match == "substring":
        ends = settled(ids_containing(nodes.select("id"), ends), "sampled-ids")
    return rows_with_id(nodes, ends), sampled
