"""Column-set operators: name rules over ``df.columns``, then one projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import named, replace_list_separator


def select_by_prefix(
    df: DataFrame,
    include: str | None = None,
    exclude: Iterable[str] = (),
    ignore: Iterable[str] = (),
) -> DataFrame:
    """Keep columns starting with ``include``, not with any ``exclude``, not in ``ignore``."""
    exclude, ignore = tuple(exclude), set(ignore)
    names = [
        c
        for c in df.columns
        if (include is None or c.startswith(include))
        and not (exclude and c.startswith(exclude))
        and c not in ignore
    ]
    return df.select(*[named(c) for c in names])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"cleaned header repeats {repeated}")
    return df.toDF(*names)


def _plain_name(name: str, primary: list[str]) -> str:
    name = name.split(":", 1)[0]
    return name if name in primary else "_" + name


def clean_nodes_header(df: DataFrame) -> DataFrame:
    """Cut type suffixes; mark columns that are not primary with a leading ``_``."""
    names = ["_label" if c == ":LABEL" else c for c in df.columns]
    return _renamed(df, [_plain_name(c, vocab.PRIMARY_NODE_COLUMNS) for c in names])


def clean_edges_header(df: DataFrame) -> DataFrame:
    return _renamed(df, [_plain_name(c, vocab.PRIMARY_EDGE_COLUMNS) for c in df.columns])


def ensure_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Append each missing column as a null string."""
    missing = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def add_edge_columns(
    df: DataFrame,
    primary_knowledge_source: str,
    knowledge_level: str = "knowledge_assertion",
    agent_type: str = "data_analysis_pipeline",
) -> DataFrame:
    """Complete the edge columns; only nulls are filled, empty text stays."""
    fill = {
        "knowledge_level": knowledge_level,
        "agent_type": agent_type,
        "primary_knowledge_source": primary_knowledge_source,
    }
    df = ensure_columns(df, vocab.ENSURED_EDGE_COLUMNS)
    return df.withColumns({c: F.coalesce(named(c).cast("string"), F.lit(v)) for c, v in fill.items()})


def coalesce_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fold ``c_right`` into ``c`` where it exists."""
    folded = [n for n in names if n + "_right" in df.columns]
    if not folded:
        return df
    df = df.withColumns({n: F.coalesce(named(n), named(n + "_right")) for n in folded})
    return df.drop(*[named(n + "_right") for n in folded])


def fix_delimiter(df: DataFrame, column: str) -> DataFrame:
    """Unit separators in a list column become pipes."""
    return df.withColumn(column, replace_list_separator(named(column)))
