"""Every job as a callable (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as ops
from .. import plans, sinks, sources
from ..functions import text
from ..functions.curie import edge_curie
from ..functions.vocab import PIPE, UNIT_SEPARATOR
from ..session import materialized, scratch_path
from . import inputs as I

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}
EDGE_KEYS = ["subject", "predicate", "object"]
SAMPLE_SIZE = 100


def job(function: Job) -> Job:
    JOBS[function.__name__] = function
    return function


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.build_edges(I.load(spark, sf_dir, I.RELATION_TABLE))


def stored_edges(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The same edges as a written table, for jobs that pass over them twice."""
    edges = graph_edges(spark, sf_dir)
    return materialized(edges.select(*columns) if columns else edges, "graph-edges")


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.load(spark, sf_dir, I.GRAPH_NODES)


# --- building ---------------------------------------------------------------------


@job
def build_edges(spark, sf_dir):
    return graph_edges(spark, sf_dir)


@job
def build_edges_overwritten(spark, sf_dir):
    kg = I.load(spark, sf_dir, I.RELATION_TABLE)
    edges = plans.build_edges(kg, keep_overwritten=True)
    return edges.select(*EDGE_KEYS, "negated", "subject_aspect_qualifier", "subject_direction_qualifier")


@job
def build_edges_ordered(spark, sf_dir):
    """Keep-first under a given order: relations in falling name order."""
    kg = I.load(spark, sf_dir, I.RELATION_TABLE)
    edges = plans.build_edges(kg, order_by=[F.translate("display_relation", "aceprt", "zyxwvu"), F.col("relation") == "disease_phenotype_negative"])
    return edges.select(*EDGE_KEYS, "negated", "subject_aspect_qualifier")


@job
def predicate_mappings(spark, sf_dir):
    return plans.predicate_mappings(I.load(spark, sf_dir, I.RELATION_TABLE))


@job
def build_nodes(spark, sf_dir):
    return plans.build_nodes(
        I.load(spark, sf_dir, I.FEATURE_NODES),
        I.load(spark, sf_dir, I.DRUG_FEATURES),
        I.load(spark, sf_dir, I.DISEASE_FEATURES),
    )


@job
def qualifier_counts(spark, sf_dir):
    edges = graph_edges(spark, sf_dir)
    by = ["predicate", "negated", "subject_aspect_qualifier"]
    return edges.groupBy(*by).agg(F.count("*").alias("n"))


@job
def explode_grouped(spark, sf_dir):
    kg = I.load(spark, sf_dir, I.RELATION_TABLE)
    exploded = plans.explode_grouped(plans.explode_grouped(kg, "x"), "y")
    return exploded.select("relation", "x_source", "x_id", "y_source", "y_id")


@job
def endpoint_curies(spark, sf_dir):
    kg = I.load(spark, sf_dir, I.RELATION_TABLE)
    return kg.select(
        edge_curie(F.col("x_source"), F.col("x_id")).alias("x"), edge_curie(F.col("y_source"), F.col("y_id")).alias("y")
    )


# --- endpoints and integrity --------------------------------------------------------


@job
def endpoint_ids(spark, sf_dir):
    return ops.endpoint_ids(graph_edges(spark, sf_dir))


@job
def endpoint_ids_all(spark, sf_dir):
    return ops.endpoint_ids(graph_edges(spark, sf_dir), distinct=False)


@job
def endpoint_check(spark, sf_dir):
    return ops.endpoint_check(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))


@job
def endpoint_check_counts(spark, sf_dir):
    check = ops.endpoint_check(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))
    return check.groupBy("side").agg(F.count("*").alias("n"))


@job
def endpoint_nodes(spark, sf_dir):
    """Nodes at the ends of edges that say something in a qualifier."""
    marked = graph_edges(spark, sf_dir).where("negated IS NOT NULL OR subject_aspect_qualifier IS NOT NULL")
    return ops.rows_with_id(graph_nodes(spark, sf_dir), ops.endpoint_ids(marked))


@job
def connected_nodes(spark, sf_dir):
    return ops.rows_with_id(graph_nodes(spark, sf_dir), ops.endpoint_ids(graph_edges(spark, sf_dir)))


# --- samples --------------------------------------------------------------------------


def _sample(spark, sf_dir, match, **options):
    nodes, edges = graph_nodes(spark, sf_dir), stored_edges(spark, sf_dir, *EDGE_KEYS)
    return plans.sample_subgraph(nodes, edges, SAMPLE_SIZE, match=match, **options)


@job
def sample_edges_substring(spark, sf_dir):
    return _sample(spark, sf_dir, "substring")[1]


@job
def sample_nodes_substring(spark, sf_dir):
    return _sample(spark, sf_dir, "substring", materialize=True)[0]


@job
def sample_edges_exact(spark, sf_dir):
    return _sample(spark, sf_dir, "exact")[1]


@job
def sample_nodes_exact(spark, sf_dir):
    return _sample(spark, sf_dir, "exact")[0]


@job
def substring_ids(spark, sf_dir):
    """Node ids that contain any endpoint: both sides whole."""
    ids = graph_nodes(spark, sf_dir).select("id")
    return ops.ids_containing(ids, ops.endpoint_ids(graph_edges(spark, sf_dir)))


@job
def substring_numbers(spark, sf_dir):
    """Node ids that contain a bare number: patterns without a common beginning."""
    ids = graph_nodes(spark, sf_dir).select("id")
    numbers = I.table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 37 + 5).cast("string").alias("id"))
    return ops.ids_containing(ids, numbers)


@job
def sample_random(spark, sf_dir):
    """Draws with replacement, by a hash that both engines compute."""
    return plans.draw_ids(spark, ops.endpoint_ids(graph_edges(spark, sf_dir)), SAMPLE_SIZE, seed=7)


@job
def sample_random_check(spark, sf_dir):
    """Draws in total, and drawn ids that are no endpoint."""
    ids = ops.endpoint_ids(graph_edges(spark, sf_dir))
    drawn = plans.draw_ids(spark, ids, SAMPLE_SIZE, seed=7)
    known = ids.select(F.col("id").alias("known"))
    checked = drawn.join(known, F.col("id") == F.col("known"), "left")
    return checked.agg(F.sum("times").alias("draws"), F.count_if(F.col("known").isNull()).alias("unknown"))


# --- columns ----------------------------------------------------------------------------


@job
def clean_nodes_header(spark, sf_dir):
    nodes = graph_nodes(spark, sf_dir)
    return ops.clean_nodes_header(nodes.toDF("id:ID", ":LABEL", "name:string", "src:string", "acctbal:double"))


@job
def clean_edges_header(spark, sf_dir):
    edges = graph_edges(spark, sf_dir).select(*EDGE_KEYS, "publications", "upstream_data_source")
    return ops.clean_edges_header(edges.toDF("subject:START_ID", "predicate", "object:END_ID", "publications:string[]", "upstream"))


@job
def add_edge_columns(spark, sf_dir):
    edges = graph_edges(spark, sf_dir).drop("agent_type", "publications", "knowledge_level")
    status = F.when(F.col("negated").isNull(), F.lit(None)).otherwise("observation")
    edges = edges.withColumn("knowledge_level", status)
    return ops.add_edge_columns(edges, "infores:none").select(
        *EDGE_KEYS, "knowledge_level", "agent_type", "primary_knowledge_source", "publications"
    )


@job
def drop_superfluous(spark, sf_dir):
    return ops.select_by_prefix(graph_nodes(spark, sf_dir), exclude=["_"])


@job
def keep_superfluous(spark, sf_dir):
    return ops.select_by_prefix(graph_nodes(spark, sf_dir), include="_", ignore=["_none"])


@job
def coalesce_columns(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("status_right"),
    )
    return ops.coalesce_columns(orders, ["status", "absent"])


@job
def fix_delimiter(spark, sf_dir):
    nodes = graph_nodes(spark, sf_dir)
    lists = nodes.withColumn("category", F.concat_ws(UNIT_SEPARATOR, "_src", "category", "name"))
    return ops.fix_delimiter(lists, "category").select("id", "category")


@job
def bool_to_labels(spark, sf_dir):
    return ops.bool_columns_to_labels(I.load(spark, sf_dir, I.ONE_HOT_NODES))


@job
def bool_lines_to_labels(spark, sf_dir):
    """The same from the lines of an unquoted file."""
    path = _written(spark, I.load(spark, sf_dir, I.ONE_HOT_NODES), "one-hot", sinks.write_unquoted)
    names, lines = sources.read_line_fields(spark, path)
    return ops.line_labels(lines, names)


@job
def keep_first(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return ops.keep_first(orders, ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"])


# --- profiles ----------------------------------------------------------------------------


@job
def superfluous_value_counts(spark, sf_dir):
    return plans.superfluous_value_counts(graph_nodes(spark, sf_dir))


@job
def superfluous_value_counts_wide(spark, sf_dir):
    counts = plans.superfluous_value_counts(graph_nodes(spark, sf_dir))
    return ops.wide_counts(counts, ["_src", "_acctbal"])


@job
def value_counts(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    return ops.value_counts(orders, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])


@job
def profile_parquet(spark, sf_dir):
    path = f"{sf_dir}/part.parquet"
    return plans.profile_parquet(spark, [path, path])[0]


@job
def parquet_shape(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    return plans.profile_parquet(spark, [path, path])[1]


@job
def parquet_append(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    return sources.read_parquet_files(spark, [path, path])


@job
def file_shapes(spark, sf_dir):
    """Lines without headers and columns, over all files the node table was written to."""
    path = scratch_path(spark, "shapes")
    sinks.write_delimited(graph_nodes(spark, sf_dir), path)
    shapes = ops.file_shapes(spark, [path])
    return shapes.agg(
        (F.sum("num_lines") - F.count("*")).alias("data_lines"),
        F.min("num_columns").alias("min_columns"),
        F.max("num_columns").alias("max_columns"),
    )


# --- text and JSON files ---------------------------------------------------------------------


def _written(spark, df, label, write=sinks.write_delimited):
    path = scratch_path(spark, label)
    write(df, path)
    return path


@job
def delimited_scan(spark, sf_dir):
    path = _written(spark, I.table(spark, sf_dir, "orders"), "delimited")
    return sources.read_delimited(spark, path)


@job
def comma_scan(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents").withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))
    documents = documents.withColumn("text", F.replace("text", F.lit("\r"), F.lit(" ")))
    path = _written(spark, documents, "comma", lambda df, p: sinks.write_delimited(df, p, sep=","))
    return sources.read_delimited(spark, path, sep=",")


@job
def multi_line_scan(spark, sf_dir):
    path = _written(spark, I.table(spark, sf_dir, "documents"), "lines")
    return sources.read_delimited(spark, path, multi_line=True)


@job
def inferred_scan(spark, sf_dir):
    path = _written(spark, I.table(spark, sf_dir, "part"), "inferred")
    return sources.read_delimited(spark, path, infer=True)


@job
def strict_scan(spark, sf_dir):
    path = _written(spark, I.table(spark, sf_dir, "customer"), "strict")
    return sources.read_delimited(spark, path, infer=True, ragged="error")


@job
def raw_node_scan(spark, sf_dir):
    path = _written(spark, I.load(spark, sf_dir, I.RAW_NODES), "raw-nodes", sinks.write_unquoted)
    return sources.read_raw_nodes(spark, path)


@job
def raw_edge_scan(spark, sf_dir):
    path = _written(spark, I.load(spark, sf_dir, I.RAW_EDGES), "raw-edges", sinks.write_unquoted)
    return sources.read_raw_edges(spark, path)


@job
def kgx_node_scan(spark, sf_dir):
    path = _written(spark, graph_nodes(spark, sf_dir), "kgx-nodes")
    return sources.read_kgx_nodes(spark, path)


@job
def kgx_edge_scan(spark, sf_dir):
    path = _written(spark, graph_edges(spark, sf_dir), "kgx-edges")
    return sources.read_kgx_edges(spark, path)


@job
def many_files_scan(spark, sf_dir):
    paths = [
        _written(spark, I.load(spark, sf_dir, i), "many")
        for i in (I.MERGE_SUPPLIERS, I.MERGE_PARTS, I.MERGE_CUSTOMERS)
    ]
    rows = sources.read_many(spark, paths)
    # part files have random names: what is compared is that they are part files
    return rows.withColumn("_file", F.regexp_extract("_file", "^part-", 0))


@job
def header_tail_scan(spark, sf_dir):
    """Columns of a node file beyond its leading three."""
    path = _written(spark, graph_nodes(spark, sf_dir), "tail")
    rows = sources.read_delimited(spark, path)
    return rows.select(*sources.header_tail(rows, 3))


@job
def mixed_headers_scan(spark, sf_dir):
    """One folder whose files have their columns in other orders, read by name."""
    path = scratch_path(spark, "mixed")
    parts = I.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    sinks.write_delimited(parts, path)
    suppliers = I.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("p_name"), F.col("s_suppkey").alias("p_partkey"), F.col("s_acctbal").alias("balance")
    )
    sinks.write_delimited(suppliers, path, mode="append")
    return sources.read_delimited(spark, path, headers="by_name")


@job
def late_misfit_scan(spark, sf_dir):
    """Numbers but for the last lines: the column is text and no cell is lost."""
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    last = orders.agg(F.max("o_orderkey")).scalar()
    value = F.when(F.col("o_orderkey") == last, F.lit("v2.1")).otherwise(F.col("o_custkey").cast("string"))
    path = _written(spark, orders.select("o_orderkey", value.alias("version")).orderBy("o_orderkey"), "misfit")
    return sources.read_delimited(spark, path, infer=True)


@job
def sample_names(spark, sf_dir):
    """Output names of samples of as many sizes as there are nations."""
    size = F.col("n_nationkey").cast("int")
    names = sinks.sample_file_names("kg.nodes.tsv", size)
    return I.table(spark, sf_dir, "nation").select(size.alias("size"), *[n.alias(c) for n, c in zip(names, ("nodes", "edges"))])


@job
def sorted_nodes(spark, sf_dir):
    """Node ids in order: each with the one before it in its category."""
    return ops.with_previous(graph_nodes(spark, sf_dir).select("category", "id"), "category", "id")


@job
def predicate_info_scan(spark, sf_dir):
    path = _written(spark, I.load(spark, sf_dir, I.PATTERNS), "patterns", sinks.write_unquoted)
    return sources.read_predicate_info(spark, path)


@job
def category_info_scan(spark, sf_dir):
    names = graph_nodes(spark, sf_dir).groupBy("category").agg(F.concat(F.lit("node_"), F.min("_src")).alias("file"))
    path = _written(spark, names, "categories", sinks.write_unquoted)
    return sources.read_category_info(spark, path, include=["Disease", "node_part"])


@job
def snapshot_scan(spark, sf_dir):
    snapshot = plans.schema_snapshot(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))
    path = _written(spark, plans.snapshot_document(snapshot), "snapshot", sinks.write_lines)
    return sources.read_snapshot(spark, path).withColumn("samples", text.list_text(F.col("samples")))


@job
def json_sink(spark, sf_dir):
    path = _written(spark, plans.predicate_mappings(I.load(spark, sf_dir, I.RELATION_TABLE)), "json", sinks.write_json)
    return spark.read.schema("relation string, display_relation string, predicate string").json(path)


@job
def json_rows(spark, sf_dir):
    nodes = graph_nodes(spark, sf_dir)
    return sinks.json_rows(nodes.withColumn("_acctbal", F.col("_acctbal").cast("string")))


@job
def json_lookup(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    return events.select("event_id", F.explode(sources.json_entries(F.col("props"), T.LongType())).alias("name", "k"))


@job
def normalization_scan(spark, sf_dir):
    """Normalization records written as JSON objects and read as a lookup table."""
    found = I.load(spark, sf_dir, I.NORMALIZATION)
    record = F.when(
        F.col("types").isNotNull(),
        F.struct(
            F.struct(F.col("identifier"), F.lit("size").alias("label")).alias("id"),
            F.array(F.struct("identifier")).alias("equivalent_identifiers"),
            text.text_list(F.col("types"), UNIT_SEPARATOR).alias("type"),
            F.lit(0.5).alias("information_content"),
        ),
    )
    lines = found.select(F.to_json(F.create_map("identifier", record), {"ignoreNullFields": "false"}).alias("value"))
    path = _written(spark, lines, "normalization", sinks.write_lines)
    read = sources.read_normalization(spark, path)
    return read.select(
        "identifier",
        "preferred_identifier",
        "label",
        F.get("equivalent_identifiers", F.lit(0))["identifier"].alias("equivalent_identifier"),
        text.list_text(F.col("types")).alias("types"),
        F.col("information_content").cast("double").alias("information_content"),
    )


# --- merges -----------------------------------------------------------------------------------


@job
def merge_edges_fold(spark, sf_dir):
    parts = [I.load(spark, sf_dir, i) for i in (I.MERGE_ORDERS, I.MERGE_LINES, I.MERGE_PRIORITIES)]
    return plans.merge_edges(parts)


@job
def merge_edges_split(spark, sf_dir):
    """The same rows when every key with several lines is divided."""
    parts = [I.load(spark, sf_dir, i) for i in (I.MERGE_ORDERS, I.MERGE_LINES, I.MERGE_PRIORITIES)]
    return plans.merge_edges(parts, split_rows=2)


@job
def merge_edges_fast(spark, sf_dir):
    parts = [I.load(spark, sf_dir, i) for i in (I.MERGE_ORDERS, I.MERGE_RETURNS, I.MERGE_PRIORITIES)]
    return plans.merge_edges(parts, unique_keys=True)


@job
def merge_nodes(spark, sf_dir):
    parts = [I.load(spark, sf_dir, i) for i in (I.MERGE_SUPPLIERS, I.MERGE_PARTS, I.MERGE_CUSTOMERS)]
    return plans.merge_nodes(parts)


@job
def merge_nodes_fast(spark, sf_dir):
    parts = [I.load(spark, sf_dir, i) for i in (I.MERGE_SUPPLIERS, I.MERGE_PARTS, I.MERGE_CUSTOMERS)]
    return plans.merge_nodes(parts, unique_keys=True)


# --- cleaning a raw graph -----------------------------------------------------------------------


def _identifiers(spark, sf_dir):
    nodes = graph_nodes(spark, sf_dir)
    return nodes.select("id", F.concat(F.col("_src"), F.lit("/"), F.col("name")).alias("identifier"))


@job
def rewrite_endpoints(spark, sf_dir):
    mapping = ops.id_map(_identifiers(spark, sf_dir))
    return ops.rewrite_endpoints(graph_edges(spark, sf_dir), mapping)


@job
def rewrite_endpoints_both(spark, sf_dir):
    mapping = ops.id_map(_identifiers(spark, sf_dir))
    return ops.rewrite_endpoints(graph_edges(spark, sf_dir), mapping, ("subject", "object"), prefix_predicate=True)


@job
def id_map(spark, sf_dir):
    nodes = I.load(spark, sf_dir, I.RAW_NODES)
    return ops.id_map(nodes.select(F.col("identifier").alias("id"), F.col("id").alias("identifier")))


def _lists(df, column):
    return df.withColumn(column, text.text_list(F.col(column), UNIT_SEPARATOR))


def _raw_graph(spark, sf_dir):
    return plans.clean_graph(
        I.load(spark, sf_dir, I.RAW_NODES),
        I.load(spark, sf_dir, I.RAW_EDGES),
        _lists(I.load(spark, sf_dir, I.NORMALIZATION), "types"),
        _lists(I.load(spark, sf_dir, I.TERM_ANCESTORS), "ancestors"),
        I.load(spark, sf_dir, I.PREDICATE_INFO),
    )


@job
def normalize_categories(spark, sf_dir):
    return _raw_graph(spark, sf_dir)[0]


@job
def clean_graph_edges(spark, sf_dir):
    return _raw_graph(spark, sf_dir)[1]


@job
def category_ancestors(spark, sf_dir):
    known = plans.category_ancestors(spark, _lists(I.load(spark, sf_dir, I.TERM_ANCESTORS), "ancestors"))
    return known.select("category", text.list_text(F.col("ancestors")).alias("ancestors"))


@job
def category_edge_files(spark, sf_dir):
    return plans.category_edge_files(I.load(spark, sf_dir, I.PATTERNS))


@job
def empty_identifiers(spark, sf_dir):
    nodes = I.load(spark, sf_dir, I.RAW_NODES)
    return nodes.groupBy("category").agg(plans.no_empty(F.col("identifier")).alias("complete"))


@job
def predicate_prefix(spark, sf_dir):
    kg = I.load(spark, sf_dir, I.RELATION_TABLE)
    return kg.select(text.with_prefix(F.col("relation")).alias("predicate"))


# --- snapshots and specs ---------------------------------------------------------------------------


@job
def schema_snapshot(spark, sf_dir):
    found = plans.schema_snapshot(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir), nodes_exclude=["_a"], seed=3)
    return found.withColumn("samples", text.list_text(F.col("samples")))


@job
def schema_snapshot_columns(spark, sf_dir):
    """Header, and how many samples each column has."""
    found = plans.schema_snapshot(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))
    return found.select("table_name", "ordinal", "name", "datatype", F.size("samples").alias("n_samples"))


def _spec(spark, sf_dir):
    nodes, edges = graph_nodes(spark, sf_dir), stored_edges(spark, sf_dir)
    return plans.generation_spec(nodes, edges)


@job
def generation_spec_values(spark, sf_dir):
    """Spec of all edges and the nodes they touch."""
    return _spec(spark, sf_dir)


@job
def generation_spec_snapshot(spark, sf_dir):
    nodes, edges = graph_nodes(spark, sf_dir), stored_edges(spark, sf_dir)
    left_out = ["original", "subject_a", "subject_d", "object_"]
    kept = plans.schema_snapshot(nodes, edges, nodes_exclude=["_", "name"], edges_exclude=left_out)
    return plans.generation_spec(nodes, edges, snapshot=kept)


@job
def generation_spec_lines(spark, sf_dir):
    return plans.spec_lines(_spec(spark, sf_dir))


@job
def id_prefixes(spark, sf_dir):
    return graph_nodes(spark, sf_dir).select(text.before_colon(F.col("id")).alias("prefix")).distinct()


@job
def sorted_values(spark, sf_dir):
    """Sorted distinct values of every column that is not superfluous, over the whole table."""
    return plans.table_spec(graph_edges(spark, sf_dir), "edges", rows=100, vocabularies={})


@job
def list_repeats(spark, sf_dir):
    """Words of whole texts, equal neighbours merged."""
    words = text.text_list(F.col("text"), " ")
    documents = I.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.list_text(text.drop_repeats(words), PIPE).alias("words"))
