from .columns import (
    add_edge_columns,
    clean_edges_header,
    clean_nodes_header,
    coalesce_columns,
    ensure_columns,
    fix_delimiter,
    select_by_prefix,
)
from .counts import file_shapes, head_tail_counts, table_shape, top_counts, value_counts, wide_counts
from .endpoints import endpoint_check, endpoint_ids, rows_with_either_id, rows_with_id
from .first import keep_first
from .labels import bool_columns_to_labels, line_labels
from .merge import hot_keys, merge_tables
from .ordered import with_previous
from .rewrite import id_map, rewrite_endpoints
from .substring import ids_containing

__all__ = [
    "add_edge_columns",
    "bool_columns_to_labels",
    "clean_edges_header",
    "clean_nodes_header",
    "coalesce_columns",
    "endpoint_check",
    "endpoint_ids",
    "ensure_columns",
    "file_shapes",
    "fix_delimiter",
    "head_tail_counts",
    "id_map",
    "ids_containing",
    "keep_first",
    "line_labels",
    "hot_keys",
    "merge_tables",
    "with_previous",
    "rewrite_endpoints",
    "rows_with_either_id",
    "rows_with_id",
    "select_by_prefix",
    "table_shape",
    "top_counts",
    "value_counts",
    "wide_counts",
]
