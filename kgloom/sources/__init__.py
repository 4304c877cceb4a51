from .delimited import (
    files_by_header,
    header_tail,
    read_delimited,
    read_kgx_edges,
    read_kgx_nodes,
    read_line_fields,
    read_lines_tsv,
    read_many,
    read_raw_edges,
    read_raw_nodes,
    with_ordinal,
    with_position,
)
from .lookups import json_entries, read_category_info, read_normalization, read_predicate_info
from .parquet import read_parquet_files
from .snapshot import read_snapshot

__all__ = [
    "files_by_header",
    "header_tail",
    "json_entries",
    "read_category_info",
    "read_delimited",
    "read_kgx_edges",
    "read_kgx_nodes",
    "read_line_fields",
    "read_lines_tsv",
    "read_many",
    "read_normalization",
    "read_parquet_files",
    "read_predicate_info",
    "read_raw_edges",
    "read_raw_nodes",
    "read_snapshot",
    "with_ordinal",
    "with_position",
]
