"""Schema snapshots and data-generation specs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab
from ..functions.text import before_colon, named, round_half_up
from ..operators.columns import select_by_prefix
from ..operators.endpoints import endpoint_ids, rows_with_id

SNAPSHOT_SAMPLES = 6
COPY_SEED = 590590
#: slots of values for each sample of a column
SLOTS = 16


def _type_name(kind: T.DataType) -> str:
    return vocab.TYPE_NAMES.get(kind.simpleString(), kind.simpleString())


def _head(df: DataFrame, rows: int, order_by: Iterable[str] | None) -> DataFrame:
    return df.orderBy(*[named(c) for c in order_by or df.columns]).limit(rows)


def _cells(df: DataFrame, ordinals: dict[str, int]) -> DataFrame:
    """Long form (ordinal, value), values as text."""
    cells = [F.struct(F.lit(i).alias("ordinal"), named(c).cast("string").alias("value")) for c, i in ordinals.items()]
    return df.select(F.inline(F.array(*cells)))


def _by_ordinal(values: dict[int, str]) -> Column:
    """Look up a plan-time value of the column with this ordinal."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("ordinal"))


def _smallest(cells: DataFrame, size: int) -> DataFrame:
    """Distinct (ordinal, value, drawn), among them the ``size`` values of each column that are drawn first.

    The first draw of each of some slots of values is summed up along the tasks; the slots' draws are those of
    different values, so the ``size``-th of them bounds the draws wanted. Only cells within the bound are made
    distinct: a few values a column and task are shuffled, however many the column has.
    """
    number = F.conv(F.substring("drawn", 1, 15), 16, 10).cast("long")
    cells = cells.withColumn("__number", number)
    slot = F.pmod(F.xxhash64("value"), F.lit(SLOTS * size))
    least = cells.groupBy("ordinal", slot.alias("__slot")).agg(F.min("__number").alias("__least"))
    bounds = least.groupBy("ordinal").agg(F.get(F.sort_array(F.collect_list("__least")), F.lit(size - 1)).alias("__bound"))
    # one row a column
    near = cells.join(F.broadcast(bounds), "ordinal").where(F.col("__bound").isNull() | (F.col("__number") <= F.col("__bound")))
    return near.select("ordinal", "value", "drawn").distinct()


def _table_snapshot(df: DataFrame, table: str, exclude: Iterable[str], seed: int) -> DataFrame:
    df = select_by_prefix(df, exclude=exclude)
    ordinals = {c: i for i, c in enumerate(df.columns)}
    header = [(table, i, c, _type_name(df.schema[c].dataType)) for c, i in ordinals.items()]
    header = df.sparkSession.createDataFrame(header, "table_name string, ordinal int, name string, datatype string")
    if not ordinals:
        return header.withColumn("samples", F.array().cast("array<string>"))
    cells = _cells(df, ordinals).where("value is not null")
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(table), F.col("ordinal").cast("string"), "value"))
    values = _smallest(cells.withColumn("drawn", drawn), SNAPSHOT_SAMPLES)
    place = F.row_number().over(Window.partitionBy("ordinal").orderBy("drawn", "value"))
    chosen = values.withColumn("place", place).where(F.col("place") <= SNAPSHOT_SAMPLES)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"])
    samples = chosen.groupBy("ordinal").agg(listed.alias("samples"))
    none = F.array().cast("array<string>")
    return header.join(samples, "ordinal", "left").select(
        "table_name", "ordinal", "name", "datatype", F.coalesce("samples", none).alias("samples")
    )


def schema_snapshot(
    nodes: DataFrame,
    edges: DataFrame,
    nodes_exclude: Iterable[str] = (),
    edges_exclude: Iterable[str] = (),
    seed: int = 0,
) -> DataFrame:
    """Rows (table_name, ordinal, name, datatype, samples) for both tables.

    Samples are up to six different values of the whole column, the first ones by
    a seeded hash, so that equal tables have equal snapshots. Excluded columns are
    named by prefix.
    """
    return _table_snapshot(nodes, "nodes", nodes_exclude, seed).unionAll(
        _table_snapshot(edges, "edges", edges_exclude, seed)
    )


def snapshot_document(snapshot: DataFrame) -> DataFrame:
    """The snapshot as one JSON document. Its size is that of the two headers."""
    column = F.struct("ordinal", "name", "datatype", "samples")

    def columns(table: str) -> Column:
        own = F.array_sort(F.collect_list(F.when(F.col("table_name") == table, column)))
        return F.transform(own, lambda c: F.struct(c["name"], c["datatype"], c["samples"])).alias(table)

    return snapshot.agg(columns("nodes"), columns("edges")).select(
        F.to_json(F.struct("nodes", "edges"), {"pretty": "true"}).alias("json")
    )


def table_spec(
    df: DataFrame, table: str, rows: int, vocabularies: dict[str, list[str]] | None = None
) -> DataFrame:
    """The spec rows of one table (``nodes`` or ``edges``), over all its rows."""
    vocabularies = vocab.EDGE_VOCABULARIES if vocabularies is None else vocabularies
    spark = df.sparkSession
    names = [c for c in df.columns if not c.startswith("_")]
    ordinals = {c: i for i, c in enumerate(names)}
    fixed: list[tuple] = [(-1, None, None, "num_rows", str(rows), None)]
    sampled: dict[str, tuple[str, str]] = {}
    for name, i in ordinals.items():
        if table == "edges" and name in ("subject", "object"):
            fixed += [
                (i, name, "copy_column", "source_column", "nodes.id", None),
                (i, name, "copy_column", "seed", str(COPY_SEED), None),
                (i, name, "copy_column", "sample.num_rows", "@edges.num_rows", None),
            ]
        elif table == "edges" and name in vocabularies:
            values = vocabularies[name]
            fixed += [(i, name, "generate_values", "sample_values", v, float(n)) for n, v in enumerate(values)]
        elif table == "nodes" and name == "id":
            sampled[name] = ("generate_unique_id", "prefixes")
        else:
            sampled[name] = ("generate_values", "sample_values")

    schema = "ordinal int, name string, type string, setting string, value string, number double"
    result = spark.createDataFrame(fixed, schema)
    if sampled:
        doubles = [ordinals[n] for n in sampled if isinstance(df.schema[n].dataType, T.DoubleType)]
        if table == "nodes" and "id" in sampled:
            df = df.withColumn("id", _prefix(named("id").cast("string")))
        cells = _cells(df, {n: ordinals[n] for n in sampled}).where("value is not null")
        values = cells.groupBy("ordinal", "value").agg(F.lit(True).alias("found"))
        # a text column without values lists one empty text, a number column nothing
        empty = [(ordinals[n], None if ordinals[n] in doubles else "") for n in sampled]
        empty = spark.createDataFrame(empty, "ordinal int, value string")
        empty = empty.join(values.select("ordinal").distinct(), "ordinal", "left_anti")
        values = values.select("ordinal", "value").unionAll(empty)
        is_double = F.col("ordinal").isin(doubles)
        result = result.unionAll(
            values.select(
                "ordinal",
                _by_ordinal({ordinals[n]: n for n in sampled}).alias("name"),
                _by_ordinal({ordinals[n]: kind for n, (kind, _) in sampled.items()}).alias("type"),
                _by_ordinal({ordinals[n]: setting for n, (_, setting) in sampled.items()}).alias("setting"),
                "value",
                F.when(is_double, F.col("value").try_cast("double")).alias("number"),
            )
        )
    return result.select(F.lit(table).alias("table_name"), "*")


def _prefix(identifier: Column) -> Column:
    missing = F.raise_error(F.concat(F.lit("identifier without a colon: "), identifier))
    return F.when(identifier.contains(":") | identifier.isNull(), before_colon(identifier)).otherwise(
        missing.cast("string")
    )


def generation_spec(
    nodes: DataFrame,
    edges: DataFrame,
    limit: int | None = None,
    rows: int = 100,
    snapshot: DataFrame | None = None,
    order_by: Iterable[str] | None = None,
    vocabularies: dict[str, list[str]] | None = None,
) -> DataFrame:
    """A data-generation spec as rows, one per listed value.

    It describes all edges and the nodes they touch; columns with a leading ``_``
    are left out. With ``limit`` it describes the first ``limit / 2`` edges by
    ``order_by`` (or by all their columns) and their nodes. With ``snapshot`` only
    its columns are used. Columns: table_name, ordinal, name, type, setting, value,
    number (the place of a value, or its numeric form).
    """
    if snapshot is not None:
        # as many rows as the two tables have columns
        wanted = snapshot.orderBy("ordinal").select("table_name", "name").collect()
        nodes = nodes.select(*[named(r.name) for r in wanted if r.table_name == "nodes"])
        edges = edges.select(*[named(r.name) for r in wanted if r.table_name == "edges"])
    if limit is not None:
        edges = _head(edges, round_half_up(limit / 2), order_by)
    nodes = rows_with_id(nodes, endpoint_ids(edges))
    return table_spec(nodes, "nodes", rows, vocabularies).unionAll(
        table_spec(edges, "edges", rows, vocabularies)
    )


def _scalar_text(value: Column, number: Column, setting: Column) -> Column:
    """A YAML scalar: plain where that reads back as the same text, else quoted."""
    plain = value.rlike(r"^[A-Za-z_](?:[A-Za-z0-9_./|+-]|:(?! )| (?! *#))*[A-Za-z0-9_./|+-]\z|^[A-Za-z_]\z") & ~F.lower(value).isin(
        "null", "true", "false", "yes", "no", "on", "off", "y", "n", "nan", "inf"
    )
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    numeric = setting.isin("num_rows", "seed") | (number.isNotNull() & (number.cast("string") == value))
    return F.when(plain | numeric, value).otherwise(quoted)


def spec_lines(spec: DataFrame) -> DataFrame:
    """The spec as YAML lines in order, ready to be written as text.

    Every row emits its own line and the headings above it; repeated headings
    fall away in a distinct, and a range sort puts the lines in order.
    """
    setting, kind, value = F.col("setting"), F.col("type"), F.col("value")
    no_number, no_value = F.lit(None).cast("double"), F.lit(None).cast("string")
    column, entry = F.lit(" " * 4), F.lit(" " * 6)
    last = F.lit(2**31 - 1)
    name = _scalar_text(F.col("name"), no_number, F.col("name"))
    scalar = _scalar_text(value, F.col("number"), setting)
    for_table, listed = setting == "num_rows", setting.isin("prefixes", "sample_values")
    sampled, valued = setting == "sample.num_rows", value.isNotNull()

    def line(test: Column, c: Column, s: int, *parts: Column, place=(no_number, no_value)) -> Column:
        return F.when(
            test,
            F.struct(
                c.alias("c"),
                F.lit(s).alias("s"),
                place[0].alias("number"),
                place[1].alias("value"),
                F.concat(*parts).alias("line"),
            ),
        )

    here = F.col("ordinal")
    own = (F.col("number"), value)
    lines = F.array(
        line(for_table, F.lit(-2), 0, F.col("table_name"), F.lit(":")),
        line(for_table, F.lit(-1), 0, F.lit("  columns:")),
        line(for_table, last, 0, F.lit("  num_rows: "), value),
        line(~for_table, here, 0, column, name, F.lit(":")),
        line(~for_table, here, 1, entry, F.lit("type: "), kind),
        line(setting == "source_column", here, 2, entry, F.lit("source_column: "), scalar),
        line(setting == "seed", here, 3, entry, F.lit("seed: "), scalar),
        line(sampled, here, 4, entry, F.lit("sample:")),
        line(sampled, here, 5, F.lit(" " * 8), F.lit("num_rows: "), scalar),
        line(listed & valued, here, 6, entry, setting, F.lit(":")),
        line(listed & valued, here, 7, entry, F.lit("- "), scalar, place=own),
        line(listed & ~valued, here, 6, entry, setting, F.lit(": []")),
    )
    table = F.when(F.col("table_name") == "nodes", 0).otherwise(1)
    all_lines = spec.select(table.alias("t"), F.explode(F.array_compact(lines)).alias("l")).select("t", "l.*")
    return all_lines.distinct().orderBy("t", "c", "s", "number", "value").select("line")
