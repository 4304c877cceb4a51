"""Sharding: k-d tree partitioning.

Documents are points whose coordinates are their metadata. All of them are one node that has to
become a number of shards; a node is cut along the dimension in which its points spread widest,
at the weighted median (the place that leaves each side the bytes of its shards), until every
node is one shard of about the target bytes. Documents of one source, language and size thus
come to lie in few shards.

Medians are found by refinement, for all nodes of a level at once. A pass over the points sums
bytes by node and bin, with partial sums in each task; the bin that holds the median is cut into
bins again, until it holds one point. Points equal in the coordinate go on by a hash of the
text, of the id, and a row number, so a third of all rows in one place is cut as any other.
Only the bins of the nodes of a level, a set number of rows, and the cuts, one a shard, reach
the driver; points are never moved, for a point's node follows from the cuts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgloom.session import materialized

from .common import table
from .ranks import placed

#: bytes of a row besides its text
ROW_BYTES = 16
#: bins of one pass over all nodes of a level, and of one node
LEVEL_BINS, NODE_BINS = 1 << 15, 4_096
_WIDE = 1 << 52
#: what a cut compares: the coordinate along its dimension, then what tells points of one place apart
_KEYS = ["__k0", "__k1", "__k2", "__k3"]


@dataclass
class Cut:
    """Where a node is cut: points beyond ``at`` (and at it, if not ``inside``) belong to the right side, which begins at shard ``right``."""

    node: int
    dimension: int
    at: tuple[int, ...]
    inside: bool
    right: int


def _hashed(value: Column, digits: int) -> Column:
    """The first digits of a value's digest as a number; null goes first."""
    return F.coalesce(F.conv(F.substring(F.md5(value.cast("string").cast("binary")), 1, digits), 16, 10).cast("long"), F.lit(0))


def points(docs: DataFrame, dimensions: list[str], row_bytes: int = ROW_BYTES) -> DataFrame:
    """One slim row a document, written: doc_id, size, text_crc32, coordinates ``__c0``... and the keys that tell points apart.

    Numbers and times keep their order and are scaled to the width of the table, other values have no order that matters
    and are hashed; null, NaN and infinite values come first.
    """
    kinds = dict(zip(docs.columns, docs.schema))
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = [F.col("doc_id"), (F.octet_length(text).cast("long") + row_bytes).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]
    scaled = []
    for i, name in enumerate(dimensions):
        kind = kinds[name].dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = F.unix_micros(F.col(name).cast("timestamp")).cast("double")
        elif isinstance(kind, T.NumericType):
            value = F.col(name).cast("double")
        else:
            columns.append(_hashed(F.col(name), 13).alias(f"__c{i}"))
            continue
        scaled.append(f"__c{i}")
        columns.append(F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value).alias(f"__c{i}"))
    keys = [_hashed(text, 15).alias(_KEYS[1]), _hashed(F.col("doc_id"), 15).alias(_KEYS[2]), F.monotonically_increasing_id().alias(_KEYS[3])]
    found = materialized(docs.select(*columns, *keys), "shard-points")
    if scaled:
        ends = found.agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in scaled]).first()
        for c in scaled:
            low, high = ends[c]
            wide = F.lit(0.0) if low is None or low == high else (F.col(c) - F.lit(low)) / (F.lit(high) - F.lit(low)) * F.lit(float(_WIDE))
            found = found.withColumn(c, F.coalesce(F.floor(wide), F.lit(0)).cast("long"))
    return found


def in_nodes(found: DataFrame, levels: list[list[Cut]]) -> DataFrame:
    """Points with ``__node``, the first shard of the node that the cuts put them in."""
    n = sum(c.startswith("__c") for c in found.columns)
    found = found.withColumn("__node", F.lit(0))
    for cuts in levels:
        rows = [(c.node, c.dimension, *c.at, c.inside, c.right) for c in cuts]
        schema = "__node int, __dimension int, __a0 long, __a1 long, __a2 long, __a3 long, __inside boolean, __right int"
        # no more cuts than shards
        found = found.join(F.broadcast(found.sparkSession.createDataFrame(rows, schema)), "__node", "left")
        key = F.struct(_along("__dimension", n).alias("k0"), *[F.col(k) for k in _KEYS[1:]])
        at = F.struct(*[F.col(f"__a{i}").alias(k) for i, k in enumerate(["k0", *_KEYS[1:]])])
        beyond = F.col("__right").isNotNull() & ((key > at) | ((key == at) & ~F.col("__inside")))
        found = found.withColumn("__node", F.when(beyond, F.col("__right")).otherwise(F.col("__node")))
        found = found.drop("__dimension", *[f"__a{i}" for i in range(4)], "__inside", "__right")
    return found


def _along(dimension: str, n: int) -> Column:
    """The coordinate in a dimension."""
    return F.element_at(F.array(*[F.col(f"__c{i}") for i in range(n)]), F.col(dimension) + 1)


def _medians(dealt: DataFrame, n: int, nodes: list[dict], bins: int) -> list[Cut]:
    """Cuts of nodes, each with node, shards, weight, dimension and the extents of its coordinate there."""
    spark, cuts = dealt.sparkSession, []
    full = [(0, (1 << 63) - 1)] * 3
    # a region: its node, the keys' extents, the weight before it; it always holds the median
    open_ = [{**x, "extents": [x["extent"], *full], "before": 0} for x in nodes]
    while open_:
        each = max(2, min(NODE_BINS, bins // len(open_)))
        rows = []
        for r in open_:
            # the first key in which the points of the region differ is cut into bins
            r["key"] = next((i for i, (low, high) in enumerate(r["extents"]) if low < high), 3)
            low, high = r["extents"][r["key"]]
            rows.append((r["node"], r["dimension"], r["key"], *[x for e in r["extents"] for x in e], (high - low) // each + 1))
        bounds = ", ".join(f"__l{i} long, __h{i} long" for i in range(4))
        regions = spark.createDataFrame(rows, f"__node int, __dimension int, __key int, {bounds}, __step long")
        inside = dealt.join(F.broadcast(regions), "__node").withColumn("__k0", _along("__dimension", n))
        for i, k in enumerate(_KEYS):
            inside = inside.where(F.col(k).between(F.col(f"__l{i}"), F.col(f"__h{i}")))
        bin_ = F.expr(f"({_pick_sql(_KEYS)} - {_pick_sql([f'__l{i}' for i in range(4)])}) div __step")
        ends = [f(k).alias(f"{k}_{f.__name__}") for k in _KEYS for f in (F.min, F.max)]
        counted = inside.groupBy("__node", bin_.alias("__bin")).agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"), *ends)
        by_node: dict[int, list] = {}
        for row in counted.collect():
            by_node.setdefault(row["__node"], []).append(row)
        still = []
        for r in open_:
            # the median: the place where the left side has the bytes of its shards (compared without fractions)
            left, shards = r["shards"] // 2, r["shards"]
            before = r["before"]
            for row in sorted(by_node[r["node"]], key=lambda x: x["__bin"]):
                if (before + row["w"]) * shards >= r["weight"] * left:
                    break
                before += row["w"]
            if row["n"] == 1:
                at = tuple(row[f"{k}_min"] for k in _KEYS)
                nearer_left = (2 * before + row["w"]) * shards <= 2 * r["weight"] * left
                cuts.append(Cut(r["node"], r["dimension"], at, nearer_left, r["node"] + left))
            else:
                still.append({**r, "extents": [(row[f"{k}_min"], row[f"{k}_max"]) for k in _KEYS], "before": before})
        open_ = still
    return cuts


def _pick_sql(cells: list[str]) -> str:
    return f"element_at(array({', '.join(cells)}), __key + 1)"


def kd_cuts(found: DataFrame, shards: int) -> list[list[Cut]]:
    """Cuts by level that make ``shards`` nodes of about equal bytes out of all points."""
    n = sum(c.startswith("__c") for c in found.columns)
    levels: list[list[Cut]] = []
    parts = {0: shards}
    while any(k > 1 for k in parts.values()):
        dealt = in_nodes(found, levels)
        cells = [f(f"__c{i}").alias(f"{f.__name__}{i}") for i in range(n) for f in (F.min, F.max)]
        wide = dealt.where(F.col("__node").isin([x for x, k in parts.items() if k > 1])).groupBy("__node").agg(F.sum("size").alias("w"), *cells)
        nodes = []
        for row in wide.collect():
            widths = [row[f"max{i}"] - row[f"min{i}"] for i in range(n)]
            d = widths.index(max(widths))
            extent = (row[f"min{d}"], row[f"max{d}"])
            nodes.append({"node": row["__node"], "shards": parts[row["__node"]], "weight": row["w"], "dimension": d, "extent": extent})
        if not nodes:
            break
        levels.append(_medians(dealt, n, nodes, LEVEL_BINS))
        parts = {m: s for x, k in parts.items() for m, s in ([(x, k)] if k < 2 else [(x, k // 2), (x + k // 2, k - k // 2)])}
    return levels


def shard(
    docs: DataFrame,
    dimensions: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"),
    shards: int | None = None,
    target_bytes: int | None = None,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """doc_id, size, text_crc32, shard (from 0) and slot (from 0 in each shard) of every row of ``docs``, which has doc_id,
    text and the dimensions; other columns are ignored, whatever their names.

    Give the number of shards, or the bytes that one is to have. A row has the bytes of its text in UTF-8 (none for null)
    and ``row_bytes``. Shards' bytes differ by about a row, however rows repeat; with fewer rows than shards some shards
    stay empty, and an empty table has no rows. Slots go by id (null first), equal ids by text.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give the number of shards or their bytes")
    found = points(docs, list(dimensions), row_bytes)
    if shards is None:
        total = found.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    dealt = in_nodes(found, kd_cuts(found, shards))
    rows = dealt.select("doc_id", "size", "text_crc32", F.col("__node").alias("shard"), *_KEYS[1:])
    ranked = placed(rows, "shard", ["doc_id", *_KEYS[1:]], "shard-slots")
    return ranked.select("doc_id", "size", "text_crc32", "shard", F.col("at").alias("slot"))


SHARDS = 40


def op13_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(table(spark, sf_dir, "documents"), shards=SHARDS)
    law = found.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
    return law.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _number_sql(value: str, digits: int) -> str:
    return f"coalesce(('0x' || substr(md5({value}), 1, {digits}))::BIGINT, 0)"


def _scaled_sql(column: str) -> str:
    low, high = (f"(SELECT {f}({column})::DOUBLE FROM documents)" for f in ("min", "max"))
    return f"coalesce(CASE WHEN {low} < {high} THEN floor(({column}::DOUBLE - {low}) / ({high} - {low}) * {float(_WIDE)})::BIGINT END, 0)"


OP13_SQL = f"""
WITH RECURSIVE points AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT + {ROW_BYTES} AS size,
    {_number_sql("source", 13)} AS c0, {_number_sql("lang", 13)} AS c1, {_scaled_sql("n_chars")} AS c2, {_scaled_sql("doc_id")} AS c3,
    {_number_sql("coalesce(text, '')", 15)} AS k1, {_number_sql("doc_id::VARCHAR", 15)} AS k2
  FROM documents
), tree AS (
  SELECT rid, size, c0, c1, c2, c3, k1, k2, 0 AS node, {SHARDS} AS parts FROM points
  UNION ALL
  SELECT rid, size, c0, c1, c2, c3, k1, k2, CASE WHEN goes_left THEN node ELSE node + parts // 2 END,
    CASE WHEN goes_left THEN parts // 2 ELSE parts - parts // 2 END
  FROM (
    SELECT *, (2 * sum(size) OVER (PARTITION BY node ORDER BY k0, k1, k2 ROWS UNBOUNDED PRECEDING) - size) * parts
      <= 2 * sum(size) OVER (PARTITION BY node) * (parts // 2) AS goes_left
    FROM (
      SELECT *, CASE greatest(w0, w1, w2, w3) WHEN w0 THEN c0 WHEN w1 THEN c1 WHEN w2 THEN c2 ELSE c3 END AS k0
      FROM (
        SELECT *, {", ".join(f"max(c{i}) OVER (PARTITION BY node) - min(c{i}) OVER (PARTITION BY node) AS w{i}" for i in range(4))}
        FROM tree WHERE parts > 1
      )
    )
  )
), crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), crcs AS (
  SELECT rid, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1])), 4294967295) AS crc FROM points, crc_table
)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, node AS shard,
  row_number() OVER (PARTITION BY node ORDER BY doc_id NULLS FIRST, k1, k2) - 1 AS slot, NULL::INT AS grown_shard
FROM tree JOIN points USING (rid, size, k1, k2) JOIN crcs USING (rid) WHERE parts = 1
"""
