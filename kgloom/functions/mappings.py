"""Relation, qualifier and node-type mappings as column expressions."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def _case(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    result = None
    for test, value in branches:
        result = F.when(test, value) if result is None else result.when(test, value)
    return otherwise if result is None else result.otherwise(otherwise)


def predicate(relation: Column, display: Column, unmapped: Column) -> Column:
    """Predicate of a relation; ``unmapped`` is used when no rule matches."""
    by_predicate: dict[str, list[str]] = {}
    for name, target in vocab.RELATION_PREDICATES.items():
        by_predicate.setdefault(target, []).append(name)
    branches = [(relation.isin(names), F.lit(target)) for target, names in by_predicate.items()]
    by_display: dict[tuple[str, str], list[str]] = {}
    for (name, shown), target in vocab.DISPLAY_PREDICATES.items():
        by_display.setdefault((name, target), []).append(shown)
    branches += [
        ((relation == name) & display.isin(shown), F.lit(target))
        for (name, target), shown in by_display.items()
    ]
    return _case(branches, unmapped)


def node_category(node_type: Column) -> Column:
    """First marker contained in the type decides; other types stay as they are."""
    branches = [(node_type.contains(m), F.lit(c)) for m, c in vocab.NODE_TYPE_CATEGORIES]
    return _case(branches, node_type)


def qualifier_rules(keep_overwritten: bool = False) -> dict[tuple[str, str | None], dict[str, str]]:
    rules = dict(vocab.QUALIFIERS)
    if keep_overwritten:
        rules.update(vocab.OVERWRITTEN_QUALIFIERS)
    return rules


class QualifierRanks:
    """Small integers standing for the relations that lead to one predicate.

    Rows of one (subject, predicate, object) differ only in what their relation
    writes into the qualifier columns. Numbering the relations of such a
    predicate by (relation, display_relation) turns "keep the first row" into a
    ``min`` over an int, which Spark combines before the shuffle.
    """

    def __init__(self, keep_overwritten: bool = False):
        self.rules = qualifier_rules(keep_overwritten)
        sources = [(p, r, None) for r, p in vocab.RELATION_PREDICATES.items()]
        sources += [(p, r, d) for (r, d), p in vocab.DISPLAY_PREDICATES.items()]
        qualified = {p for p, r, d in sources if (r, d) in self.rules}
        # a relation may already be spelled like its predicate
        sources += [(p, p, None) for p in qualified]
        kept = sorted((s for s in sources if s[0] in qualified), key=lambda s: (s[0], s[1], s[2] or ""))
        self.ranks: dict[tuple[str, str | None], int] = {}
        for _, members in groupby(kept, key=lambda s: s[0]):
            for _, relation, display in members:
                self.ranks[(relation, display)] = len(self.ranks) + 1

    def rank(self, relation: Column, display: Column) -> Column:
        return _case(
            [(_matches(relation, display, key), F.lit(n)) for key, n in self.ranks.items()], F.lit(0)
        )

    def value(self, rank: Column, column: str) -> Column:
        """Qualifier text written by the relation of that rank."""
        branches = [
            (rank == self.ranks[key], F.lit(written[column]))
            for key, written in self.rules.items()
            if column in written
        ]
        return _case(branches, F.lit(None).cast("string"))

    def columns(self) -> set[str]:
        return {column for written in self.rules.values() for column in written}


def _matches(relation: Column, display: Column, key: tuple[str, str | None]) -> Column:
    test = relation == key[0]
    return test if key[1] is None else test & (display == key[1])
