"""Graph tables from a relation table and node feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab
from ..functions.curie import GROUP_SEPARATOR, GROUPED_SOURCE, PADDED_SOURCES, edge_curie, with_node_curie
from ..functions.mappings import QualifierRanks, node_category, predicate
from ..functions.text import named, text_list
from ..operators.merge import merge_tables
from ..sources.delimited import POSITION_DIGITS, packed

#: decimal digits for the place of an id in its group, on either side
PART_DIGITS = (5, 5)


def explode_grouped(df: DataFrame, side: str, position: str | None = None) -> DataFrame:
    """One row per part of a grouped id; its source becomes the plain one.

    Rows without a source are dropped. ``position`` names a column for the part
    number within the group.
    """
    source, local = f"{side}_source", f"{side}_id"
    grouped = named(source) == GROUPED_SOURCE
    parts = F.when(grouped, text_list(named(local), GROUP_SEPARATOR)).otherwise(F.array(named(local)))
    others = [named(c) for c in df.columns if c not in (source, local)]
    plain = F.when(grouped, F.lit("MONDO")).otherwise(named(source)).alias(source)
    if position:
        exploded = F.posexplode_outer(parts).alias(position, local)
    else:
        exploded = F.explode_outer(parts).alias(local)
    return df.where(named(source).isNotNull()).select(*others, plain, exploded)


def build_edges(
    kg: DataFrame, order_by: list[str | Column] | None = None, keep_overwritten: bool = False
) -> DataFrame:
    """Edges of a relation table, one row per (subject, predicate, object).

    Rows of one key differ only in the qualifiers their relation writes. The
    first row decides: by ``order_by`` (say, the ordinal of the source scan),
    where rows of grouped ids come first, or else by relation and display
    relation. Either way the choice is an aggregate that combines before the one
    shuffle; ordered by a position alone (``sources.with_position``) it is a
    hash aggregate, with the whole order in one number. ``keep_overwritten`` also emits the qualifiers a later rule blanks.
    Columns beyond the relation table's own are kept from the deciding row, but
    for those named in ``order_by``.
    """
    qualifiers = QualifierRanks(keep_overwritten)
    ordinals = [o for o in order_by or [] if isinstance(o, str)]
    extra = [c for c in kg.columns if c not in vocab.RELATION_COLUMNS and c not in ordinals]
    in_source_order = order_by is not None
    if in_source_order:
        order = [named(o) if isinstance(o, str) else o for o in order_by]
        kg = kg.withColumns({f"__order{i}": o for i, o in enumerate(order)})
        # grouped rows lead, those grouped on y before those on x only
        leads = [F.coalesce(named(s) != GROUPED_SOURCE, F.lit(True)) for s in ("y_source", "x_source")]
        kg = kg.withColumns({"__lead_y": leads[0], "__lead_x": leads[1]})
        kg = explode_grouped(explode_grouped(kg, "x", "__part_x"), "y", "__part_y")
        first_by = ["__lead_y", "__lead_x", *[f"__order{i}" for i in range(len(order))], "__part_x", "__part_y"]
        positioned = len(order) == 1 and kg.schema["__order0"].dataType == T.DecimalType(sum(POSITION_DIGITS), 0)
        if positioned and not extra:
            whole = F.col("__order0")
            leads = F.col("__lead_y").cast("int") * 2 + F.col("__lead_x").cast("int")
            digits = (1, sum(POSITION_DIGITS), *PART_DIGITS)
            ends = [F.coalesce(F.col(c), F.lit(0)) for c in ("__part_x", "__part_y")]
            kg = kg.withColumn("__first", packed([leads, whole, *ends], digits))
            first_by = ["__first"]
    else:
        kg = explode_grouped(explode_grouped(kg, "x"), "y")
        first_by = ["relation", "display_relation"]

    relation, display = F.col("relation"), F.col("display_relation")
    rank = qualifiers.rank(relation, display)
    rows = kg.select(
        edge_curie(F.col("x_source"), F.col("x_id")).alias("subject"),
        predicate(relation, display, unmapped=relation).alias("predicate"),
        # an empty source on this side is written like a padded one
        edge_curie(F.col("y_source"), F.col("y_id"), ["", *PADDED_SOURCES]).alias("object"),
        rank.alias("__rank"),
        *[named(c) for c in extra],
        *([named(c) for c in first_by] if in_source_order or extra else []),
    )
    keys = ["subject", "predicate", "object"]
    if in_source_order or extra:
        if first_by == ["__first"]:
            edges = rows.groupBy(*keys).agg(F.min_by("__rank", "__first").alias("__rank"))
        else:
            kept = F.struct("__rank", *[named(c) for c in extra])
            first = F.min_by(kept, F.struct(*[named(c) for c in first_by])).alias("kept")
            edges = rows.groupBy(*keys).agg(first).select(*keys, "kept.*")
    else:
        edges = rows.groupBy(*keys).agg(F.min("__rank").alias("__rank"))

    written = qualifiers.columns()
    constants = [
        (qualifiers.value(F.col("__rank"), name) if name in written else F.lit(value).cast("string")).alias(name)
        for name, value in vocab.RELATION_EDGE_CONSTANTS.items()
    ]
    return edges.select("predicate", *[named(c) for c in extra], *constants, "subject", "object")


def predicate_mappings(kg: DataFrame) -> DataFrame:
    """Distinct (relation, display_relation, predicate); unmapped relations show null.

    The predicate follows from the other two, so only those are made distinct.
    """
    shown = kg.select("relation", "display_relation").distinct()
    mapped = predicate(F.col("relation"), F.col("display_relation"), F.lit(None).cast("string"))
    return shown.withColumn("predicate", mapped)


def build_nodes(
    nodes: DataFrame, drug_features: DataFrame, disease_features: DataFrame, split_rows: int | None = None
) -> DataFrame:
    """Nodes with their drug and disease features, joined fully on ``node_index``.

    Feature rows that match no node stay, with null id, name and category;
    several disease rows multiply their node.
    """
    joined = merge_tables(
        [nodes, drug_features, disease_features], ["node_index"], split_rows=split_rows
    )
    coded = with_node_curie(joined, "node_source", "node_id", "mondo_id")
    coded = coded.withColumn("node_type", node_category(F.col("node_type")))
    coded = coded.drop("node_id", "node_index")
    # in two steps: the drug column gives up the name the node type takes over
    coded = coded.withColumnsRenamed({"node_source": "id", "node_name": "name", "category": "drug_category"})
    return coded.withColumnsRenamed({"node_type": "category"})
