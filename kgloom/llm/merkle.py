"""Merkle manifest of a dataset: slot pivot.

Each row is a leaf, the digest of its columns. Leaves of a group (the ``source``) form a tree in
the order of their id, and the groups' roots form the tree of the dataset. A level of a tree is
one step of conditional aggregates: they spread the children of a parent into as many columns
as a parent has slots; the columns put together and hashed are the parent's digest, and the
columns but a row's own are its siblings.

Rows are dealt once into blocks of consecutive leaves, whole subtrees of several levels. Inside
a block every level aggregates over a prefix of the base-``fanout`` digits of the place, so one
shuffle and one sort serve all levels; the blocks' digests, some thousand times fewer, are the
leaves of the next step. The way up writes these; the way down joins each block's path with
those of its rows, which are then where that join wants them.

A proof is the list of siblings before and after a node, level by level; it is enough to compute
the root from a leaf again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgloom.session import materialized

from .common import held_out, table
from .ranks import placed

FANOUT = 3
#: leaves of a block at most; whole levels of the tree
BLOCK_LEAVES = 2_500
PATH = "array<struct<before:string,after:string>>"


def encoded(value: Column) -> Column:
    """A value as text that tells where it ends: its size in bytes, a colon, the value; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(parts: list[Column]) -> Column:
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path make."""
    return F.aggregate(path, leaf, lambda node, level: digest([level["before"], node, level["after"]]))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    siblings = F.transform(path, lambda level: F.concat(level["before"], level["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def _climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (tree, at, size, digest and others) with their block, the block's digest for ``digest``, and their path to it."""
    slot = [F.expr(f"cast((at div {fanout**level}) % {fanout} as int)") for level in range(levels)]
    climbed = nodes.withColumns(
        {"block": F.expr(f"at div {fanout**levels}"), **{f"__slot{i}": s for i, s in enumerate(slot)}, "path": F.array().cast(PATH)}
    )
    climbed = climbed.repartition("tree", "block")
    for level in range(levels):
        parent = Window.partitionBy("tree", "block", *[f"__slot{i}" for i in range(levels - 1, level, -1)])
        own = F.col(f"__slot{level}")
        names = [f"__child{s}" for s in range(fanout)]
        climbed = climbed.withColumns({n: F.max(F.when(own == s, F.col("digest"))).over(parent) for s, n in enumerate(names)})
        before = F.concat_ws("", *[F.when(own > s, F.col(n)) for s, n in enumerate(names)])
        after = F.concat_ws("", *[F.when(own < s, F.col(n)) for s, n in enumerate(names)])
        # a tree that is down to one node at this level has found its root
        active = F.col("size") > fanout**level
        step = F.array(F.struct(before.alias("before"), after.alias("after"))).cast(PATH)
        climbed = climbed.withColumns(
            {
                "path": F.when(active, F.concat("path", step)).otherwise(F.col("path")),
                "digest": F.when(active, F.sha2(F.concat_ws("", *names), 256)).otherwise(F.col("digest")),
            }
        ).drop(*names)
    return climbed.drop(*[f"__slot{i}" for i in range(levels)])


def _tree_paths(nodes: DataFrame, fanout: int, above: Callable[[DataFrame], DataFrame], found: list[str]) -> DataFrame:
    """``nodes`` with their whole path and the columns ``found``, which ``above`` adds (with a path) to the trees' roots
    (tree, name, digest)."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    if largest <= 1:
        tops = above(nodes.select("tree", "name", "digest"))
        return nodes.drop("digest", "path").join(tops.select("tree", "path", *found), "tree")
    levels = 1
    while fanout**levels < largest and fanout ** (levels + 1) <= max(BLOCK_LEAVES, fanout):
        levels += 1
    leaves = fanout**levels
    climbed = _climbed(nodes, fanout, levels)
    heads = climbed.where(F.col("at") % leaves == 0).select(
        "tree", "name", F.col("block").alias("at"), F.expr(f"(size + {leaves - 1}) div {leaves}").alias("size"), "digest"
    )
    tops = _tree_paths(materialized(heads, "merkle-heads"), fanout, above, found)
    tops = tops.select("tree", F.col("at").alias("block"), F.col("path").alias("__above"), *found)
    joined = climbed.drop("digest").join(tops, ["tree", "block"])
    return joined.withColumn("path", F.concat("path", "__above")).drop("__above", "block")


def manifest(
    docs: DataFrame,
    columns: list[str],
    group: str = "source",
    order: str = "doc_id",
    fanout: int = FANOUT,
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """A row for each row of ``docs``: the order column, ``leaf``, ``subroot`` (of its group), ``root`` (of all) and
    ``path``, the siblings before and after it and its ancestors up to the root.

    ``columns`` make the leaf; other columns of ``docs`` are ignored, whatever their names, and those of ``carried`` are
    added to the rows. A null group is a group of its own and comes first, groups go bytewise as text, rows by the
    order column, nulls first, and rows equal in it by their leaf; repeated rows are leaves each. An empty table has
    no rows. A group of one row is its own subroot, a lone group's subroot the root.
    """
    carried = carried or {}
    if fanout < 2:
        raise ValueError("a parent has two slots at least")
    leaves = docs.select(
        encoded(F.col(group)).alias("tree"),
        F.col(group).cast("string").alias("name"),
        F.col(order).alias("__order"),
        digest([encoded(F.col(c)) for c in columns]).alias("digest"),
        *[c.alias(f"__carried_{n}") for n, c in carried.items()],
        F.monotonically_increasing_id().alias("__tie"),
    )
    # texts are read once; what follows is one digest a row
    leaves = materialized(leaves, "merkle-leaves").withColumn("leaf", F.col("digest"))
    leaves = placed(leaves, "tree", ["__order", "digest", "__tie"], "merkle-order").withColumnRenamed("group_size", "size").drop("__tie")

    def root_of(tops: DataFrame) -> DataFrame:
        tops = tops.select("tree", F.col("digest").alias("root"))
        return tops.withColumn("path", F.array().cast(PATH))

    def group_paths(tops: DataFrame) -> DataFrame:
        """Paths of the groups' roots in the tree of groups."""
        rows = tops.select(F.lit("").alias("tree"), "name", F.col("tree").alias("group"), "digest", F.col("digest").alias("subroot"))
        ranked = placed(rows, "tree", ["name"], "merkle-groups").withColumnRenamed("group_size", "size")
        return _tree_paths(ranked, fanout, root_of, ["root"]).select(F.col("group").alias("tree"), "subroot", "root", "path")

    done = _tree_paths(leaves, fanout, group_paths, ["subroot", "root"])
    return done.select(
        F.col("__order").alias(order), "leaf", "subroot", "root", "path", *[F.col(f"__carried_{n}").alias(n) for n in carried]
    )


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents, and what checking it finds after texts of every other id lost their line breaks."""
    docs = table(spark, sf_dir, "documents")
    tampered = {"text": F.when(held_out(F.col("doc_id"), 2, 0), F.translate("text", "\n", "")).otherwise(F.col("text"))}
    seen = digest([encoded(tampered.get(c, F.col(c))) for c in LEAF_COLUMNS])
    made = manifest(docs, LEAF_COLUMNS, carried={"seen": seen})
    checked = made.withColumn("folded_root", folded(F.col("seen"), F.col("path")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _leaf_sql(text: str) -> str:
    parts = [text if c == "text" else c for c in LEAF_COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}::VARCHAR)::VARCHAR || ':' || {p}::VARCHAR, '-')" for p in parts) + ")"


def _levels_sql(name: str, first: str) -> str:
    """Levels of trees as lists: (tree, level, nodes)."""
    return f"""{name} AS (
  {first}
  UNION ALL
  SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
    lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM {name} WHERE len(nodes) > 1
)"""


def _steps_sql(places: str, levels: str, offset: int) -> str:
    """Siblings of each place at each level: (rid, step, before, after)."""
    return f"""
  SELECT rid, {offset} + level AS step,
    array_to_string(nodes[3 * (i // 3) + 1:i], '') AS before, array_to_string(nodes[i + 2:3 * (i // 3) + 3], '') AS after
  FROM (SELECT rid, level, nodes, place // (3 ** level)::BIGINT AS i FROM {places} JOIN {levels} USING (tree) WHERE len(nodes) > 1)"""


OP11_SQL = f"""
WITH RECURSIVE sums AS (
  SELECT row_number() OVER () AS rid, *, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: ascii(c)::BIGINT)), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc FROM documents
), leaves AS (
  SELECT rid, doc_id, source, coalesce(source, '-') || (source IS NULL)::VARCHAR AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS seen FROM sums
), places AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), {_levels_sql("trees", "SELECT tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM places GROUP BY tree")}, subroots AS (
  SELECT tree, nodes[1] AS subroot FROM trees WHERE len(nodes) = 1
), group_rows AS (
  SELECT tree AS name, subroot, '' AS tree, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM subroots JOIN (SELECT DISTINCT tree, source FROM leaves) USING (tree)
), {_levels_sql("tops", "SELECT tree, 0 AS level, list(subroot ORDER BY place) AS nodes FROM group_rows GROUP BY tree")}, group_places AS (
  SELECT rid, group_rows.place, group_rows.tree, subroot FROM places JOIN group_rows ON places.tree = group_rows.name
), steps AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY step) AS step, before, after FROM (
    {_steps_sql("places", "trees", 0)} UNION ALL {_steps_sql("group_places", "tops", 1000)})
), folded AS (
  SELECT rid, 0::BIGINT AS step, seen AS node FROM leaves
  UNION ALL
  SELECT rid, steps.step, sha256(before || node || after) FROM folded JOIN steps USING (rid) WHERE steps.step = folded.step + 1
), ends AS (
  SELECT rid, arg_max(node, step) AS folded_root FROM folded GROUP BY rid
), proofs AS (
  SELECT rid, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM steps GROUP BY rid
)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN ends USING (rid) JOIN group_places USING (rid) LEFT JOIN proofs USING (rid)
CROSS JOIN (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1)
"""
