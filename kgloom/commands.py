"""File to file: each command reads its inputs, runs one job and writes the result.

Outputs are folders of part files. The paths may lie in any store Spark reads.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import operators as ops
from . import plans, sinks, sources
from .functions import vocab
from .functions.text import named


def build_edges(spark: SparkSession, kg: str, output: str, keep_overwritten: bool = False) -> None:
    """Relation table (comma separated) to edges; the first row in the file decides."""
    table = sources.with_position(sources.read_delimited(spark, kg, sep=","))
    edges = plans.build_edges(table, order_by=["_position"], keep_overwritten=keep_overwritten)
    sinks.write_delimited(edges, output)


def build_nodes(spark: SparkSession, nodes: str, drug_features: str, disease_features: str, output: str) -> None:
    tables = [sources.read_delimited(spark, p, sep=",") for p in (nodes, drug_features, disease_features)]
    sinks.write_delimited(plans.build_nodes(*tables), output)


def predicate_mappings(spark: SparkSession, kg: str, output: str) -> None:
    """The mapping report, one JSON object a line."""
    report = plans.predicate_mappings(sources.read_delimited(spark, kg, sep=","))
    sinks.write_json(report.orderBy("relation", "display_relation"), output)


def clean_nodes_header(spark: SparkSession, input: str, output: str) -> None:
    sinks.write_delimited(ops.clean_nodes_header(sources.read_delimited(spark, input)), output)


def clean_edges_header(spark: SparkSession, input: str, output: str) -> None:
    sinks.write_delimited(ops.clean_edges_header(sources.read_delimited(spark, input)), output)


def add_edge_columns(
    spark: SparkSession,
    input: str,
    output: str,
    primary_knowledge_source: str,
    knowledge_level: str = "knowledge_assertion",
    agent_type: str = "data_analysis_pipeline",
) -> None:
    edges = sources.read_delimited(spark, input, ragged="error")
    sinks.write_delimited(ops.add_edge_columns(edges, primary_knowledge_source, knowledge_level, agent_type), output)


def fix_delimiter(spark: SparkSession, input: str, output: str, column: str) -> None:
    sinks.write_delimited(ops.fix_delimiter(sources.read_delimited(spark, input), column), output)


def bool_columns_to_labels(
    spark: SparkSession, input: str, output: str, families: Iterable[str] = vocab.LABEL_FAMILIES
) -> None:
    names, lines = sources.read_line_fields(spark, input)
    sinks.write_unquoted(ops.line_labels(lines, names, families), output)


def endpoint_check(spark: SparkSession, nodes: str, edges: str) -> DataFrame:
    """Ids on one side only, sorted within each side."""
    ids = [sources.read_delimited(spark, p) for p in (nodes, edges)]
    return ops.endpoint_check(*ids).orderBy("side", "id")


def sample_subgraph(
    spark: SparkSession,
    nodes: str,
    edges: str,
    output_dir: str,
    size: int = 100,
    random: bool = False,
    seed: int = 0,
    match: str = "substring",
) -> None:
    names = sinks.sample_file_names(nodes.rstrip("/").rsplit("/", 1)[-1], size)
    tables = [sources.read_delimited(spark, p) for p in (nodes, edges)]
    for sampled, name in zip(plans.sample_subgraph(*tables, size, random, seed, match, materialize=True), names):
        sinks.write_delimited(sampled, f"{output_dir.rstrip('/')}/{name}")


def schema_snapshot(
    spark: SparkSession,
    nodes: str,
    edges: str,
    nodes_exclude: Iterable[str] = (),
    edges_exclude: Iterable[str] = (),
    seed: int = 0,
) -> str:
    """The snapshot as JSON text, as long as the two headers."""
    tables = [sources.read_delimited(spark, p, infer=True) for p in (nodes, edges)]
    snapshot = plans.schema_snapshot(*tables, nodes_exclude, edges_exclude, seed)
    return plans.snapshot_document(snapshot).first().json


def generation_spec(
    spark: SparkSession,
    nodes: str,
    edges: str,
    output: str,
    limit: int | None = None,
    rows: int = 100,
    snapshot: str | None = None,
) -> None:
    """YAML lines over the whole tables, or over the first ``limit / 2`` edges and their nodes; with ``snapshot`` (a snapshot file) only its columns are described."""
    tables = [sources.read_delimited(spark, p, infer=True) for p in (nodes, edges)]
    columns = sources.read_snapshot(spark, snapshot) if snapshot else None
    sinks.write_lines(plans.spec_lines(plans.generation_spec(*tables, limit, rows, columns)), output)


def superfluous_value_counts(spark: SparkSession, input: str, output: str, ignore: Iterable[str] = ()) -> None:
    """Comma separated, a pair of columns per superfluous column, at most 20 rows."""
    table = sources.read_delimited(spark, input)
    columns = [c for c in table.columns if c.startswith("_") and c not in set(ignore)]
    wide = ops.wide_counts(plans.superfluous_value_counts(table, ignore), columns)
    sinks.write_delimited(wide.orderBy("position").drop("position"), output, sep=",")


def profile_parquet(spark: SparkSession, inputs: list[str], output: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(top values of the first input, shape of all); ``output`` takes all rows as JSON."""
    counts, shape, rows = plans.profile_parquet(spark, inputs)
    if output:
        sinks.write_json(rows, output)
    return counts, shape


def file_shapes(spark: SparkSession, inputs: list[str]) -> DataFrame:
    return ops.file_shapes(spark, inputs)


def clean_graph(
    spark: SparkSession,
    nodes: str | list[str],
    edges: str | list[str],
    normalization: str,
    term_ancestors: str,
    output: str,
    predicate_info: str | None = None,
    category_info: str | None = None,
    categories: Iterable[str] = (),
) -> None:
    """Raw node and edge files to ``output``/nodes and ``output``/edges, a folder for each input file there.

    Every file is read by its own header. With ``category_info`` ``nodes`` is a
    folder, and only the files of the ``categories`` are read, found by that
    lookup. ``normalization`` holds JSON responses, ``term_ancestors`` a table of
    term and pipe-delimited ancestors. With ``predicate_info`` the edge files are
    told apart by their names. The first row of an identifier is the first in the
    order of files and lines.
    """
    if category_info:
        # as many rows as there are categories
        found = sources.read_category_info(spark, category_info, list(categories))
        files = sorted({r.file for r in found.select("file").collect()})
        nodes = [f"{nodes.rstrip('/')}/{f}.tsv" for f in files]
    raw_nodes = sources.read_raw_nodes(spark, nodes, file="file")
    raw_edges = sources.read_raw_edges(spark, edges, file="file")
    patterns = sources.read_predicate_info(spark, predicate_info) if predicate_info else None
    terms = sources.read_delimited(spark, term_ancestors)
    terms = terms.withColumn("ancestors", F.split("ancestors", r"\|"))
    found = sources.read_normalization(spark, normalization).select("identifier", "types")
    done_nodes, done_edges = plans.clean_graph(raw_nodes, raw_edges, found, terms, patterns, order_by=["file", "id"])
    # rows of a file come from neighbouring tasks, so it is written in few parts
    lead = ["file", "subject", "object"]
    rest = [named(c) for c in done_edges.columns if c not in lead]
    done = done_nodes.orderBy("file", "id"), done_edges.orderBy(*lead, *rest)
    for table, name in zip(done, ("nodes", "edges")):
        sinks.write_unquoted(table, f"{output.rstrip('/')}/{name}", by="file")


def merge_edges(spark: SparkSession, inputs: list[str], output: str, unique_keys: bool = False) -> None:
    """Merge edge files; cells are text and come out as they went in."""
    tables = [sources.read_delimited(spark, p) for p in inputs]
    sinks.write_delimited(plans.merge_edges(tables, unique_keys), output)


def merge_nodes(spark: SparkSession, inputs: list[str], output: str, unique_keys: bool = False) -> DataFrame:
    """Merge node files; returns the shape of the written table."""
    tables = [sources.read_delimited(spark, p) for p in inputs]
    sinks.write_delimited(plans.merge_nodes(tables, unique_keys), output)
    return ops.table_shape(sources.read_delimited(spark, output))
