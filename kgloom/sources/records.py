"""Quoted records that may span lines, from files that are split like any other.

Whether a line break ends a record depends on all quotes before it. Each line is therefore read
as a function of the state it begins in (inside quotes or not): most keep the state, some turn
it over, some end in one state whatever came before. Functions of lines compose to those of a
block, one row each, and a running composition over a file's blocks tells the state in which a
block begins; a second one along the block tells it for each line. Lines that belong together
are then put together, and only they are shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .paths import file_path, literal

QUOTE = '"'
_OUTSIDE, _INSIDE, _CLOSED, _START = 0, 1, 2, 3


def _ends_inside(line: Column, sep: str, start: int) -> Column:
    """Whether a line that begins in the state ``start`` ends inside quotes.

    A quote opens at the begin of a field only; inside, a quote closes and a second one right after it opens again;
    any other quote is data.
    """
    pieces = F.split(line, QUOTE, -1)
    # what stands before each quote
    before = F.slice(pieces, 1, F.size(pieces) - 1)

    def step(state: Column, piece: Column) -> Column:
        field = F.endswith(piece, F.lit(sep))
        first = (piece == "") & (state >= _CLOSED)
        return F.when(state == _INSIDE, _CLOSED).when(field | first, _INSIDE).otherwise(_OUTSIDE)

    return F.aggregate(before, F.lit(start), step) == _INSIDE


def _with_states(rows: DataFrame, by: list[str], order: list[str], begin: Column) -> DataFrame:
    """``rows`` of functions (``to0``, ``to1``: the states in which a row ends that begins in 0 or 1) with ``state``, in
    which each begins when the first row of each ``by`` begins in ``begin``."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__turn", ((F.col("to0") == 1) & (F.col("to1") == 0)).cast("long"))
    rows = rows.withColumn("__turns", F.coalesce(F.sum("__turn").over(before), F.lit(0)))
    # a fixed state less the turns so far, so that adding all turns later leaves those after it
    fixed = F.when(F.col("to0") == F.col("to1"), F.pmod(F.col("to0") - F.col("__turns"), F.lit(2)))
    rows = rows.withColumn("__fixed", fixed)
    rows = rows.withColumn("__base", F.last("__fixed", ignorenulls=True).over(before))
    return rows.withColumn("state", F.pmod(F.coalesce(F.col("__base"), begin) + F.col("__turns"), F.lit(2)).cast("int"))


def _lines(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """Lines with their place and the states (``to0``, ``to1``) in which they end."""
    lines = spark.read.text(paths, lineSep="\n").select(
        file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value"
    )
    quoted = F.contains("value", F.lit(QUOTE))
    return lines.withColumns(
        {
            "to0": F.when(quoted, _ends_inside(F.col("value"), sep, _START)).otherwise(F.lit(False)).cast("int"),
            "to1": F.when(quoted, _ends_inside(F.col("value"), sep, _INSIDE)).otherwise(F.lit(True)).cast("int"),
        }
    )


def header_record(spark: SparkSession, paths: list[str], sep: str) -> str | None:
    """The first record of the file whose name comes first; the driver takes the lines it stands on."""
    files = spark.read.text(paths).select(file_path().alias("file"))
    first = files.agg(F.min("file")).first()[0]
    if first is None:
        return None
    lines = _lines(spark, [literal(first)], sep).select("value", "to0", "to1")
    wanted = 1
    while True:
        taken, record, state = lines.take(wanted), [], 0
        for value, to0, to1 in taken:
            if state == 0 and value in ("", "\r"):
                continue
            record.append(value)
            state = to1 if state else to0
            if state == 0:
                return "\n".join(record).removesuffix("\r")
        if len(taken) < wanted:
            return "\n".join(record).removesuffix("\r") if record else None
        wanted *= 4


def read_records(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """Records of quoted files: file, block and row (of the record's first line), ``first`` (of its file), ``record``, and
    ``whole``, which is true, for conditions that may be judged before parts of records are left out.

    Records end with a line feed outside quotes, and a carriage return before it. Blank lines between records are
    skipped.
    """
    lines = _lines(spark, paths, sep)
    along = _with_states(lines, ["file", "block"], ["row"], F.lit(None).cast("long")).drop("state")
    own = lambda begin: F.pmod(F.coalesce(F.col("__base"), begin) + F.col("__turns"), F.lit(2))
    end = lambda state: F.when(state == 0, F.col("to0")).otherwise(F.col("to1"))
    filled = ~F.col("value").isin("", "\r")
    # a block for either state it may begin in: the state it ends in, the first and the last record that begin in it
    each = []
    for begin in (0, 1):
        state = own(F.lit(begin))
        begins = F.when(state == 0, F.col("row"))
        each += [F.max_by(end(state), "row").alias(f"to{begin}"), F.max(begins).alias(f"__last{begin}")]
        each += [F.min(F.when(filled, begins)).alias(f"__first{begin}")]
    blocks = _with_states(along.groupBy("file", "block").agg(*each), ["file"], ["block"], F.lit(0))
    # one row a block: the state it begins in, the record that is open there, and the first record of the file
    found = lambda name: F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    place = lambda row: F.when(row.isNotNull(), F.struct("block", row.alias("row")))
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "file",
        "block",
        F.col("state").alias("__begin"),
        F.last(place(found("__last")), ignorenulls=True).over(earlier).alias("__open"),
        F.min(place(found("__first"))).over(of_file).alias("__head"),
    )
    told = along.join(blocks, ["file", "block"]).withColumn("__in", own(F.col("__begin")))
    told = told.withColumn("__out", end(F.col("__in")))
    # records of one line stay where they are
    here = F.struct("block", "row")
    alone = (F.col("__in") == 0) & (F.col("__out") == 0)
    plain = told.where(alone).select("file", here.alias("at"), "__head", F.col("value").alias("record"), alone.alias("whole"))
    upto = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.last(F.when(F.col("__in") == 0, here), ignorenulls=True).over(upto)
    spanning = told.withColumn("at", F.coalesce(begun, F.col("__open"))).where("__in = 1 OR __out = 1")
    lines_of = F.sort_array(F.collect_list(F.struct("block", "row", "value")))
    joined = spanning.groupBy("file", "at").agg(F.first("__head").alias("__head"), F.transform(lines_of, lambda x: x["value"]).alias("lines"))
    joined = joined.select("file", "at", "__head", F.array_join("lines", "\n").alias("record"), F.lit(True).alias("whole"))
    records = plain.unionAll(joined).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    # a filter on ``first`` may be moved below the one that leaves out parts of records: these are no first record
    first = (F.col("at") == F.col("__head")) & F.col("whole")
    return records.select("file", F.col("at.block").alias("block"), F.col("at.row").alias("row"), first.alias("first"), "whole", "record")
