from .build import build_edges, build_nodes, explode_grouped, predicate_mappings
from .clean import category_ancestors, category_edge_files, clean_graph, no_empty, normalize_nodes, rewrite_raw_edges
from .merge import merge_edges, merge_nodes
from .profile import profile_parquet, superfluous_value_counts
from .sample import draw_ids, first_ids, sample_subgraph
from .spec import generation_spec, schema_snapshot, snapshot_document, spec_lines, table_spec

__all__ = [
    "build_edges",
    "build_nodes",
    "category_ancestors",
    "category_edge_files",
    "clean_graph",
    "draw_ids",
    "explode_grouped",
    "first_ids",
    "generation_spec",
    "merge_edges",
    "merge_nodes",
    "no_empty",
    "normalize_nodes",
    "predicate_mappings",
    "profile_parquet",
    "rewrite_raw_edges",
    "sample_subgraph",
    "schema_snapshot",
    "snapshot_document",
    "spec_lines",
    "superfluous_value_counts",
    "table_spec",
]
