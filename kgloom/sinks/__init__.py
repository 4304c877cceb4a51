from .writers import (
    json_rows,
    sample_file_names,
    write_delimited,
    write_json,
    write_lines,
    write_unquoted,
)

__all__ = [
    "json_rows",
    "sample_file_names",
    "write_delimited",
    "write_json",
    "write_lines",
    "write_unquoted",
]
