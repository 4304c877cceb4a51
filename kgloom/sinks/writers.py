"""Text, JSON and naming sinks. Every writer leaves one folder of part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named

_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists") -> None:
    """Quoted text with a header; blanks at cell ends are kept, quotes doubled."""
    df.write.mode(mode).options(sep=sep, header=True, quote='"', escape='"', **_KEEP_BLANKS).csv(path)


def write_unquoted(
    df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists", by: str | None = None
) -> None:
    """Plain text with a header: quotes are data, null and empty look the same. ``by`` names a column whose values
    get a folder each; it is not written into the files."""
    options = {"sep": sep, "header": True, "quote": "", "escapeQuotes": False, "emptyValue": ""}
    writer = df.write.mode(mode).options(**options, **_KEEP_BLANKS)
    (writer.partitionBy(by) if by else writer).csv(path)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a one-column frame of ready lines in its order."""
    lines.write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, null fields spelled out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON object."""
    row = F.struct(*[named(c) for c in df.columns])
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias(name))


def sample_file_names(nodes_file_name: str, size: int | Column) -> tuple:
    """Names of the sampled node and edge files, both made from the node file's; expressions for a size that is one."""
    if "nodes." not in nodes_file_name:
        raise ValueError(f"{nodes_file_name!r} lacks 'nodes.': both outputs would get one name")
    if isinstance(size, Column):
        at = lambda kind: F.concat(F.lit(f"{kind}_"), size.cast("string"), F.lit("."))
        return tuple(F.replace(F.lit(nodes_file_name), F.lit("nodes."), at(kind)) for kind in ("nodes", "edges"))
    return (
        nodes_file_name.replace("nodes.", f"nodes_{size}."),
        nodes_file_name.replace("nodes.", f"edges_{size}."),
    )
