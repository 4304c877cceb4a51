"""Cleaning a raw graph: node categories from a normalization table, edge endpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import list_text, named
from ..operators.first import keep_first
from ..operators.keys import own_shuffle
from ..operators.rewrite import id_map, rewrite_endpoints


def category_ancestors(
    spark: SparkSession, term_ancestors: DataFrame, seeds: dict[str, str | None] | None = None
) -> DataFrame:
    """(category, ancestors) for the seed categories whose term is known.

    ``term_ancestors`` holds (term, ancestors ARRAY<STRING>). The result has no
    more rows than there are seeds.
    """
    seeds = vocab.RAW_CATEGORIES if seeds is None else seeds
    pairs = [(c, t) for c, t in seeds.items() if t]
    known = spark.createDataFrame(pairs, "category string, term string")
    terms = term_ancestors.groupBy("term").agg(F.max("ancestors").alias("ancestors"))
    return terms.join(F.broadcast(known), "term").select("category", "ancestors")


def normalize_nodes(
    nodes: DataFrame,
    normalization: DataFrame,
    term_ancestors: DataFrame,
    seeds: dict[str, str | None] | None = None,
    order_by: list[str | Column] = ("id",),
) -> DataFrame:
    """Raw nodes with their identifier as id and their ancestors as category list.

    ``normalization`` holds (identifier, types); where it has none, the ancestors
    of the raw category stand in. One row per category and identifier is kept,
    the first by ``order_by`` and then by its other columns; nodes without an
    identifier all stay.
    """
    rest = [c for c in nodes.columns if c not in ("id", "category", "identifier")]
    has_identifier = F.coalesce(F.col("identifier") != "", F.lit(False))
    given = [c for c in order_by if isinstance(c, str)]
    ties = [c for c in nodes.columns if c not in given]
    distinct = keep_first(nodes.where(has_identifier), ["category", "identifier"], [*order_by, *ties])
    distinct = distinct.unionAll(nodes.where(~has_identifier).select(*[named(c) for c in distinct.columns]))
    types = normalization.groupBy("identifier").agg(F.max("types").alias("__types"))
    ancestors = category_ancestors(nodes.sparkSession, term_ancestors, seeds)
    ancestors = F.broadcast(ancestors.withColumnRenamed("ancestors", "__ancestors"))
    found = distinct.join(types, "identifier", "left").join(ancestors, "category", "left")
    category = list_text(F.coalesce("__types", "__ancestors"), vocab.UNIT_SEPARATOR)
    return found.select(named("identifier").alias("id"), category.alias("category"), *[named(c) for c in rest])


def category_edge_files(predicate_info: DataFrame) -> DataFrame:
    """(category, file) for each category met as subject or object of a file's pattern."""
    ends = F.explode(F.array(F.col("subject"), F.col("object"))).alias("category")
    return predicate_info.select(ends, "file").where("category is not null").distinct()


def rewrite_raw_edges(edges: DataFrame, nodes: DataFrame, predicate_info: DataFrame | None = None) -> DataFrame:
    """Edges with raw subjects replaced by identifiers.

    With ``predicate_info`` an edge (which then has a ``file`` column) is only
    rewritten by nodes of a category its file is about; among several such
    categories the first by name decides.
    """
    if predicate_info is None:
        return rewrite_endpoints(edges, id_map(nodes), ("subject",))
    order = edges.columns
    about = category_edge_files(predicate_info).groupBy("file").agg(F.collect_set("category").alias("__about"))
    # one element per category, so the list is as short as the category list
    mapping = (
        nodes.where("id is not null")
        .groupBy("id", "category")
        .agg(F.max("identifier").alias("identifier"))
        .groupBy(F.col("id").alias("__id"))
        .agg(F.array_sort(F.collect_list(F.struct("category", "identifier"))).alias("__known"))
    )
    about = about.select(own_shuffle(F.col("file")).alias("__file"), "__about")
    mapping = mapping.select(own_shuffle(F.col("__id")).alias("__id"), "__known")
    joined = edges.join(about, F.col("file") == F.col("__file"), "left")
    joined = joined.join(mapping, F.col("subject") == F.col("__id"), "left")
    usable = F.filter("__known", lambda k: F.array_contains("__about", k["category"]))
    replaced = F.coalesce(F.get(usable, F.lit(0))["identifier"], F.col("subject").cast("string"))
    return joined.withColumn("subject", replaced).select(*[named(c) for c in order])


def clean_graph(
    nodes: DataFrame,
    edges: DataFrame,
    normalization: DataFrame,
    term_ancestors: DataFrame,
    predicate_info: DataFrame | None = None,
    seeds: dict[str, str | None] | None = None,
    order_by: list[str | Column] = ("id",),
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a raw graph after normalization; edges by subject, object.

    The other columns follow in the sort order, so that the range sort can also
    part the rows of a frequent pair.
    """
    clean_nodes = normalize_nodes(nodes, normalization, term_ancestors, seeds, order_by)
    clean_edges = rewrite_raw_edges(edges, nodes, predicate_info)
    ends = ["subject", "object"]
    rest = [named(c) for c in clean_edges.columns if c not in ends]
    return clean_nodes, clean_edges.orderBy(*ends, *rest)


def no_empty(identifier: Column) -> Column:
    """Aggregate: true when no identifier is empty."""
    return F.bool_and(F.length(identifier) > 0)
