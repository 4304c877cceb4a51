"""Delimited text scans."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named
from .paths import belongs, file_name, file_path, leads_to, literal
from .records import header_record, read_records

# A separator no file holds: the line stays one cell.
_WHOLE_LINE = "\u0001\u0002\u0001"
_CORRUPT = "__corrupt"

_QUOTED = {"quote": '"', "escape": '"'}

KGX_NODE_FIELDS = ["id", "category"]
KGX_EDGE_FIELDS = [
    "subject",
    "predicate",
    "object",
    "primary_knowledge_source",
    "aggregator_knowledge_source",
    "knowledge_level",
    "agent_type",
]
KGX_OPTIONAL_FIELDS = ["aggregator_knowledge_source"]


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _reader(spark: SparkSession, sep: str, **options):
    settings = {
        "sep": sep,
        "header": True,
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        # every file's header is held against the first one's: columns are never swapped
        "enforceSchema": False,
        **options,
    }
    return spark.read.options(**settings)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "\t",
    infer: bool = False,
    ragged: str = "truncate",
    multi_line: bool = False,
    headers: str = "equal",
    ordinal: str | None = None,
) -> DataFrame:
    """Scan delimited files with a header; every column a string unless ``infer``.

    ``infer`` takes types from all rows of all files, one pass before the scan:
    whole numbers, numbers, booleans, or else text, so that no cell is lost.
    ``ragged="truncate"`` cuts extra fields and pads short rows with nulls;
    ``ragged="error"`` fails on extra fields. Empty cells, quoted or not, are
    null. Line breaks inside quotes need ``multi_line``: a pass over all lines
    tells which of them are inside quotes, and files are split all the same.

    Files must share one header, or the scan fails; with ``headers="by_name"``
    they are grouped by their own headers and their columns matched by name.

    ``ordinal`` names a column for the source order of a ``multi_line`` scan
    (for others take ``with_ordinal``).
    """
    if ordinal and not multi_line:
        raise ValueError("ordinal is for multi_line scans, take with_ordinal for others")
    if ragged not in ("truncate", "error"):
        raise ValueError(f"ragged must be 'truncate' or 'error', not {ragged!r}")
    if headers not in ("equal", "by_name"):
        raise ValueError(f"headers must be 'equal' or 'by_name', not {headers!r}")
    if headers == "by_name":
        parts = [
            read_delimited(spark, files, sep, False, ragged, multi_line, ordinal=ordinal)
            for files in files_by_header(spark, path).values()
        ]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return _typed(rows, ordinal) if infer else rows
    paths = _paths(path)
    if multi_line:
        rows = _scan_records(spark, paths, sep, ragged, ordinal)
        return _typed(rows, ordinal) if infer else rows
    schema = _inferred_schema(spark, paths, sep) if infer else None
    if ragged == "error":
        return _scan_strict_width(spark, paths, sep, schema)
    reader = _reader(spark, sep, **_QUOTED)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files by their first line, in the order of their names: one distributed scan, one row a file for the driver."""
    lines = spark.read.text(_paths(path)).select(
        file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "row").alias("header"))
    found: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():
        found.setdefault(r.header, []).append(literal(r.file))
    if not found:
        raise ValueError(f"no header in {path}")
    return found


def _plain(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(kind, (T.DoubleType, T.BooleanType)):
        return kind
    return T.StringType()


def _inferred_schema(spark: SparkSession, paths: list[str], sep: str) -> T.StructType:
    """Types that every row of every file fits."""
    inferred = _reader(spark, sep, inferSchema=True, **_QUOTED).csv(paths).schema
    return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in inferred])


def _typed(rows: DataFrame, beside: str | None = None) -> DataFrame:
    """Text columns as the narrowest type that all their cells fit; the column ``beside`` stays."""

    def fits(name: str, kind: str) -> Column:
        return F.coalesce(F.bool_and(named(name).isNull() | named(name).try_cast(kind).isNotNull()), F.lit(True))

    kinds = ("long", "double", "boolean")
    texts = [c for c in rows.columns if c != beside]
    checks = [fits(c, k).alias(f"{i}.{k}") for i, c in enumerate(texts) for k in kinds]
    filled = [F.count(named(c)).alias(f"{i}.n") for i, c in enumerate(texts)]
    found = rows.agg(*checks, *filled).first()
    cells = [named(beside)] if beside else []
    for i, c in enumerate(texts):
        kind = next((k for k in kinds if found[f"{i}.{k}"] and found[f"{i}.n"]), "string")
        cells.append(named(c).cast(kind).alias(c))
    return rows.select(*cells)


def _too_wide(text: Column, sep: str, width: int) -> Column:
    """Whether the text of a row of another width has more fields than ``width``; null has not."""
    unquoted = "\\Q" + sep + '\\E(?=(?:[^"]*"[^"]*")*[^"]*$)'
    return text.isNotNull() & (F.size(F.split(text, unquoted, -1)) > width)


def _too_wide_error() -> Column:
    return F.raise_error(F.lit("found more fields than the header defines")).cast("boolean")


def _column_names(header: list[str | None], by_case: bool) -> list[str]:
    """Names of columns as other scans give them: empty ones by place, repeated ones with their place."""
    known = [h if by_case or h is None else h.lower() for h in header]
    return [f"_c{i}" if not h else f"{h}{i}" if known.count(k) > 1 else h for i, (h, k) in enumerate(zip(header, known))]


def _scan_records(spark: SparkSession, paths: list[str], sep: str, ragged: str, ordinal: str | None) -> DataFrame:
    """Files whose cells may hold line breaks: records are cut first, then parsed one by one."""
    options = {"sep": sep, "mode": "PERMISSIVE", "multiLine": "true", **_QUOTED}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    top = header_record(spark, paths, sep)
    if top is None:
        raise ValueError(f"no header in {paths}")
    one = spark.createDataFrame([(top,)], "record string")
    width = len(T._parse_datatype_string(one.select(F.schema_of_csv(F.lit(top), options)).first()[0]).fields)
    # one more cell tells a header that goes on
    cells = [f"c{i}" for i in range(width + 1)]
    schema = ", ".join(f"{c} string" for c in cells)
    header = list(one.select(F.from_csv("record", schema, options)).first()[0])
    names = _column_names(header[:-1], spark.conf.get("spark.sql.caseSensitive") == "true")
    records = read_records(spark, paths, sep)
    # headers alone are parsed here, one a file
    top_cells = F.from_csv("record", schema, options)
    same = reduce(lambda a, b: a & b, [top_cells[c].eqNullSafe(F.lit(h)) for c, h in zip(cells, header)])
    other = F.raise_error(F.concat(F.lit("another header than the first file's in "), F.col("file"))).cast("boolean")
    keeps = F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(other))
    if ragged == "error":
        wide = (F.size(F.split("record", "\\Q" + sep + "\\E", -1)) > width) & _too_wide(F.col("record"), sep, width)
        keeps = keeps.when(F.col("whole") & wide, _too_wide_error())
    order = [F.struct("file", "block", "row").alias("at")] if ordinal else []
    parsed = records.where(keeps.otherwise(F.lit(True))).select(*order, F.from_csv("record", schema, options).alias("cells"))
    own = [F.col("at").alias(ordinal)] if ordinal else []
    return parsed.select(*own, *[F.col(f"cells.{c}").alias(n) for c, n in zip(cells, names)])


def _scan_strict_width(spark: SparkSession, paths: list[str], sep: str, schema: T.StructType | None) -> DataFrame:
    names = _reader(spark, sep, **_QUOTED).csv(paths).columns
    flagged = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    # columnPruning off: the width of a row is judged whatever columns are read
    options = {"columnNameOfCorruptRecord": _CORRUPT, "columnPruning": False}
    rows = _reader(spark, sep, **_QUOTED, **options).schema(flagged).csv(paths)
    # the first column takes part because a scan may not ask for the row text alone
    read = F.length(F.coalesce(named(names[0]), F.lit(""))) >= 0
    # a row of another width keeps its text; only then are its fields counted
    rows = rows.where(F.when(_too_wide(named(_CORRUPT), sep, len(names)) & read, _too_wide_error()).otherwise(read))
    cells = []
    for i, name in enumerate(names):
        cell = named(name)
        if schema is not None and not isinstance(schema[i].dataType, T.StringType):
            misfit = F.raise_error(F.concat(F.lit(f"a cell of {name} does not fit its type: "), cell))
            value = cell.try_cast(schema[i].dataType)
            cell = F.when(value.isNotNull() | cell.isNull(), value).otherwise(misfit.cast(schema[i].dataType))
        cells.append(cell.alias(name))
    return rows.select(*cells)


def read_line_fields(
    spark: SparkSession, path: str | list[str], sep: str = "\t", extra: dict[str, Column] | None = None
) -> tuple[list[str], DataFrame]:
    """(names of the header that all files share, lines split into one ``fields`` array).

    Quotes are data. Lines holding nothing but blanks are skipped. One array
    instead of columns keeps plans small for headers of thousands of names.
    """
    lines = _reader(spark, _WHOLE_LINE, quote="").csv(_paths(path))
    if not lines.columns:
        raise ValueError(f"no header in {path}")
    line = named(lines.columns[0])
    more = [c.alias(n) for n, c in (extra or {}).items()]
    return lines.columns[0].split(sep), lines.select(F.split(line, "\\Q" + sep + "\\E", -1).alias("fields"), *more)


def read_lines_tsv(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """Scan in which quotes are data: a missing field is null, an empty one ``''``."""
    names, lines = read_line_fields(spark, path, sep)
    return lines.select(*[F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)])


def _leading(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename the leading columns by position and keep rows that have them all."""
    if len(df.columns) < len(names):
        raise ValueError(f"expected at least {len(names)} columns, found {df.columns}")
    rest = df.columns[len(names):]
    return df.toDF(*names, *rest).where(named(names[-1]).isNotNull())


def _read_raw(spark: SparkSession, path: str | list[str], leading: list[str], file: str | None) -> DataFrame:
    """Unquoted files, each with its own header: the leading columns by place, the others by name."""
    parts = []
    for files in files_by_header(spark, path).values():
        rows = read_lines_tsv(spark, files)
        if file:
            name = F.regexp_replace(file_name(), r"\.[^.]*$", "")
            names, lines = read_line_fields(spark, files, extra={file: name})
            rows = lines.select(*[F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)], file)
        parts.append(_leading(rows, leading))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_raw_nodes(spark: SparkSession, path: str | list[str], file: str | None = None) -> DataFrame:
    """Raw nodes: id, category, identifier, then any; shorter rows are dropped. ``file`` names a column for the
    name of each row's file, without its ending."""
    return _read_raw(spark, path, ["id", "category", "identifier"], file)


def read_raw_edges(spark: SparkSession, path: str | list[str], file: str | None = None) -> DataFrame:
    """Raw edges, whose files hold subject, object, predicate in that order; ``file`` as for nodes."""
    return _read_raw(spark, path, ["subject", "object", "predicate"], file)


def header_tail(df: DataFrame, n: int) -> list[str]:
    return df.columns[n:]


def _read_kgx(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    # columnPruning off: a row of the wrong width must fail even if unread columns differ
    options = {**_QUOTED, "mode": "FAILFAST", "columnPruning": False}
    rows = _reader(spark, "\t", **options).csv(_paths(path))
    required = [f for f in fields if f not in KGX_OPTIONAL_FIELDS]
    missing = [f for f in required if f not in rows.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    cells = []
    for field in fields:
        if field in required:
            cells.append(F.coalesce(named(field), F.lit("")).alias(field))
        elif field in rows.columns:
            cells.append(named(field))
        else:
            cells.append(F.lit(None).cast("string").alias(field))
    return rows.select(*cells)


def read_kgx_nodes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict node scan: a missing column or a row of the wrong width fails."""
    return _read_kgx(spark, path, KGX_NODE_FIELDS)


def read_kgx_edges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict edge scan; only ``aggregator_knowledge_source`` may be missing."""
    return _read_kgx(spark, path, KGX_EDGE_FIELDS)


def read_many(
    spark: SparkSession, paths: list[str], sep: str = "\t", tag: str | None = "_file"
) -> DataFrame:
    """Append files whose headers may differ; ``tag`` names the file of each row.

    One scan finds all headers; files with equal headers are read by one scan.
    """
    if not paths:
        raise ValueError("no input files")
    result = None
    for alike in files_by_header(spark, paths).values():
        rows = read_delimited(spark, alike, sep)
        if tag:
            rows = rows.withColumn(tag, file_name())
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    return result


def with_ordinal(df: DataFrame, name: str = "_ordinal", files: list[str] | None = None) -> DataFrame:
    """Source order of a file scan as one comparable column.

    Take it directly on the scan: the row counter grows along a file's blocks.
    Files come in the order of ``files`` (names as given to the scan), or else
    by path.
    """
    path = file_path()
    place = F.lit(0)
    if files:
        # a file belongs to the longest of the given paths that leads to it
        known = sorted(enumerate(files), key=lambda x: -len(x[1]))
        for i, given in known[::-1]:
            place = F.when(belongs(path, given), i).otherwise(place)
    order = F.struct(
        place.alias("place"),
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(name, order)


#: decimal digits of a position: file, byte of the block, row of the scan's task
POSITION_DIGITS = (6, 12, 9)


def with_position(df: DataFrame, name: str = "_position", files: list[str] | None = None) -> DataFrame:
    """Source order of a file scan as one number, which aggregates keep in place (a struct as of ``with_ordinal`` they
    must sort by).

    Take it directly on the scan. Files are numbered in the order of ``files``, or else by path; their list, which the
    driver has anyway, is broadcast. A position that outgrows its digits is an error.
    """
    spark = df.sparkSession
    found = sorted(set(df.inputFiles()))
    place = lambda path: next((i for i, given in sorted(enumerate(files or []), key=lambda x: -len(x[1])) if leads_to(given, path)), 0)
    ranked = sorted((place(unquote(path)), unquote(path), path) for path in found)
    # the list and the rows write an empty host in different ways
    listed = [(re.sub("^([^:/]+):///", r"\1:/", path), i) for i, (_, _, path) in enumerate(ranked)]
    numbers = spark.createDataFrame(listed, "__path string, __file long")
    parts = {
        "__of": F.regexp_replace(F.col("_metadata.file_path"), "^([^:/]+):///", "$1:/"),
        "__block": F.col("_metadata.file_block_start"),
        "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }
    rows = df.withColumns(parts).join(F.broadcast(numbers), F.col("__of") == F.col("__path"))
    position = packed([F.col("__file"), F.col("__block"), F.col("__row")], POSITION_DIGITS)
    return rows.withColumn(name, position).drop(*parts, "__path", "__file")


def packed(numbers: list[Column], digits: tuple[int, ...]) -> Column:
    """Whole numbers side by side in one decimal, each in its digits."""
    def whole(value: int, n: int) -> Column:
        return F.lit(str(value)).cast(f"decimal({n},0)")

    total = sum(digits)
    result = whole(0, total)
    for i, (number, n) in enumerate(zip(numbers, digits)):
        wide = F.raise_error(F.concat(F.lit(f"more than {n} digits: "), number.cast("string"))).cast(f"decimal({n},0)")
        inside = (number >= 0) & (number <= whole(10**n - 1, n))
        fits = F.when(inside, number.cast(f"decimal({n},0)")).when(number.isNotNull(), wide)
        below = sum(digits[i + 1 :])
        result = (result + fits * whole(10**below, below + 1)).cast(f"decimal({total},0)")
    return result
