"""String and list expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocab import BIOLINK, PIPE, UNIT_SEPARATOR


def named(name: str) -> Column:
    """Column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def pad_left(value: Column, width: int = 7, fill: str = "0") -> Column:
    """Left pad that leaves longer text whole (``lpad`` alone would cut it)."""
    return F.when(F.length(value) >= width, value).otherwise(F.lpad(value, width, fill))


def list_text(values: Column, separator: str = PIPE) -> Column:
    """Array to delimited text."""
    return F.array_join(values, separator)


def text_list(value: Column, separator: str = PIPE) -> Column:
    """Delimited text to array, the separator taken literally."""
    return F.split(value, "\\Q" + separator + "\\E", -1)


def replace_list_separator(value: Column, old: str = UNIT_SEPARATOR, new: str = PIPE) -> Column:
    return F.replace(value, F.lit(old), F.lit(new))


def with_prefix(value: Column, prefix: str = BIOLINK) -> Column:
    """Add the prefix where it is missing; null stays null."""
    return F.when(value.startswith(prefix), value).otherwise(F.concat(F.lit(prefix), value))


def before_colon(value: Column) -> Column:
    return F.substring_index(value, ":", 1)


def drop_repeats(values: Column) -> Column:
    """Remove an element equal to the one before it (lists without nulls)."""
    # the list is paired with itself one place on, so each element is read once
    before = F.concat(F.array(F.lit(None).cast("string")), values)
    changed = F.zip_with(values, before, lambda x, last: F.when(last.isNull() | (x != last), x))
    return F.array_compact(changed)


def round_half_up(value: float) -> int:
    """Round half away from zero for a value that is not negative."""
    return int(value + 0.5)
