"""One-hot columns to label lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import named

# no header holds these
_NO_LABEL = "\u0001"
_BETWEEN = "\u0002"


def _label(name: str, family: str) -> str | None:
    """The name between the family's prefix and the first ``:``; none without ``:``."""
    if not name.startswith(family) or ":" not in name:
        return None
    return name.split(":", 1)[0].replace(family + "_", "")


def _labels(flags: Column, labels: list[str | None], separator: str) -> Column:
    """Labels of the flags that are exactly ``true``, in order.

    The labels are one literal looked up by place, so the expression stays flat
    however many there are.
    """
    listed = _BETWEEN.join(_NO_LABEL if label is None else label for label in labels)
    by_place = F.split(F.lit(listed), _BETWEEN)

    def chosen(flag: Column, i: Column) -> Column:
        label = F.get(by_place, i)
        return F.when((flag == "true") & (label != _NO_LABEL), label)

    # joining skips the nulls
    return F.array_join(F.transform(flags, chosen), separator)


def _is_kept(name: str, families: list[str]) -> bool:
    return not name.startswith(tuple(families))


def bool_columns_to_labels(
    df: DataFrame, families: Iterable[str] = vocab.LABEL_FAMILIES, separator: str = vocab.PIPE
) -> DataFrame:
    """Collapse each family of one-hot columns into one list of labels.

    A family is a name prefix. Only cells holding exactly ``true`` count. Family
    columns without ``:`` are dropped. Kept names are cut at the first ``:``.
    """
    families = list(families)
    cells = [named(c).alias(c.split(":", 1)[0]) for c in df.columns if _is_kept(c, families)]
    for family in families:
        members = {c: label for c in df.columns if (label := _label(c, family)) is not None}
        flags = F.array(*[named(c).cast("string") for c in members]).cast("array<string>")
        cells.append(_labels(flags, list(members.values()), separator).alias(family))
    return df.select(*cells)


def line_labels(
    lines: DataFrame,
    names: list[str],
    families: Iterable[str] = vocab.LABEL_FAMILIES,
    separator: str = vocab.PIPE,
) -> DataFrame:
    """The same over lines split into a ``fields`` array, for very wide headers."""
    families = list(families)
    kept = [(i, n) for i, n in enumerate(names) if _is_kept(n, families)]
    cells = [F.get("fields", F.lit(i)).alias(n.split(":", 1)[0]) for i, n in kept]
    for family in families:
        labels = [_label(n, family) for n in names]
        cells.append(_labels(F.col("fields"), labels, separator).alias(family))
    return lines.select(*cells)
