"""Rows beside their neighbours in an order, however many rows share a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import named
from ..session import materialized


def with_previous(df: DataFrame, group: str, column: str, name: str = "before") -> DataFrame:
    """``df`` with the ``column`` of the row before in its ``group``, in the order of that column (nulls first).

    Rows are dealt by ranges of (group, column) and written in that order. Inside a range each row sees the one before
    it; the first row of a range gets the last one of the range before, of which there is one row a range. A group may
    hold any share of the table.
    """
    by = [named(group), named(column)]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = dealt.withColumns({"__range": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    dealt = materialized(dealt, "ordered")
    own = F.struct(named(group).alias("g"), named(column).alias("c"))
    lasts = dealt.groupBy("__range").agg(F.max_by(own, "__row").alias("__last"))
    carried = lasts.select("__range", F.lag("__last").over(Window.orderBy("__range")).alias("__carried"))
    along = Window.partitionBy("__range").orderBy("__row")
    rows = dealt.withColumn("__prior", F.lag(own).over(along)).join(F.broadcast(carried), "__range")
    prior = F.coalesce("__prior", "__carried")
    before = F.when(prior["g"].eqNullSafe(named(group)), prior["c"])
    return rows.withColumn(name, before).drop("__range", "__row", "__prior", "__carried")
