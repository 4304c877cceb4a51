"""Places of rows in the order of their group, where a group may hold any share of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kgloom.session import materialized

_ROW_BITS = 33  # of monotonically_increasing_id: the partition above, the row in it below


def placed(rows: DataFrame, group: str, order: list[str], label: str = "places") -> DataFrame:
    """``rows`` with ``at``, the place in its group by ``order`` (from 0), and ``group_size``, the rows of the group.

    ``group`` holds no nulls; rows equal in ``order`` get places in any order. The rows are dealt by ranges of
    (group, order) and written in that order once; a range's first place is the sum of what the ranges before it hold
    of the group, so a group is spread over as many tasks as it has ranges and never meets in one.
    """
    by = [group, *order]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__row", F.monotonically_increasing_id())
    dealt = materialized(dealt, label).withColumn("__part", F.shiftright("__row", _ROW_BITS))
    runs = dealt.groupBy(group, "__part").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    # one row a group and range
    of_group = Window.partitionBy(group)
    before = F.sum("__n").over(of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(
        group, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(of_group).alias("group_size")
    )
    found = dealt.join(starts, [group, "__part"])
    return found.withColumn("at", F.col("__row") + F.col("__shift")).select(*rows.columns, "at", "group_size")
