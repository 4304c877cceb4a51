"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two, and each segment is mapped to its bit
count: a point with 32 coordinates. The Manhattan distance of two points is at most the
Hamming distance of their fingerprints, so links are looked for among near points only. The
points are joined by a grid: coordinates form 8 blocks of 4, and points within a distance of
4 agree in at least 4 of the blocks, so a point is put into one cell for each choice of 4
blocks (70), and points that meet in a cell are compared: first by Manhattan distance, then
exactly by Hamming distance.

Equal fingerprints are one point, so copies never meet. A cell with many points is not paired
out: it is dealt again by the bits themselves, and within what remains a search from point to
point emits a spanning forest of its links, which has the same components.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgloom.operators.keys import own_shuffle
from kgloom.session import materialized

from .common import map_arrow, mixed, numbered_parts, row_keys, table, text_chunks
from .components import components

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
BLOCKS, BLOCKS_EQUAL = 8, 4
#: up to this size a cell's points are compared pair by pair, all at once
SMALL_CELL = 8
#: beyond this size a cell is dealt again by the bits
LARGE_CELL = 512
CELL_PARTITION_BYTES = 32 << 20
_ODD = 0x5555555555555555


def shingle_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().lower().split()  # of bytes: only A-Z are lower-cased
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = (stops - sizes).tolist()
    stops = stops[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, fp) of each row of ``docs`` (doc_id, text); texts without a word, and null texts, have fingerprint 0."""

    def run(batches):
        for piece in text_chunks(batches, "text"):
            found = [shingle_hashes(t) for t in piece.column("text").to_pylist()]
            fps = np.zeros(len(found), np.uint64)
            for i, h in enumerate(found):
                ones = np.zeros(64, np.int64)
                for at in range(0, len(h), 1 << 16):
                    bits = np.unpackbits(h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    ones += bits.sum(axis=0, dtype=np.int32)
                fps[i] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
            keys = [piece.column(n) for n in ("doc_id", "k1", "k2")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(fps.view(np.int64))], ["doc_id", "k1", "k2", "fp"])

    rows = docs.select("doc_id", *row_keys(), "text")
    return map_arrow(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, k1 long, k2 long, fp long")


def embedded(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 segments, two bits each, packed into 64."""
    return (fps & np.uint64(_ODD)) + (fps >> np.uint64(1) & np.uint64(_ODD))


@lru_cache(maxsize=1)
def block_masks() -> tuple[int, ...]:
    return tuple(sum(0xFF << 8 * b for b in chosen) for chosen in combinations(range(BLOCKS), BLOCKS_EQUAL))


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    """Manhattan distance of four packed segments, by their two bytes."""
    four = np.stack([np.arange(256) >> s & 3 for s in (0, 2, 4, 6)], 1)
    return np.abs(four[:, None] - four[None]).sum(2).astype(np.uint8)


def linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs link: near in the embedding, then by the bits themselves."""
    near = np.zeros(len(a), np.int32)
    left, right = embedded(a).view(np.uint8).reshape(-1, 8), embedded(b).view(np.uint8).reshape(-1, 8)
    for k in range(8):
        near += _steps()[left[:, k], right[:, k]]
    found = near <= max_bits
    found[found] = np.bitwise_count(a[found] ^ b[found]) <= max_bits
    return found


def _spanning(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever links connect within a group, at most one for each member."""
    edges, left = [], fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = np.bitwise_count(left ^ one) <= max_bits
            if near.any():
                edges.append((np.full(int(near.sum()), one), left[near]))
                queue.extend(left[near])
                left = left[~near]
    return edges


def group_links(keys: np.ndarray, fps: np.ndarray, max_bits: int = MAX_BITS, again: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among points of equal keys."""
    order = np.argsort(keys, kind="stable")
    keys, fps = keys[order], fps[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    size_of = np.repeat(sizes, sizes)
    edges = []
    small = size_of <= SMALL_CELL
    for d in range(1, SMALL_CELL):
        at = np.flatnonzero(small[:-d] & (keys[d:] == keys[:-d])) if len(keys) > d else np.zeros(0, int)
        hit = at[linked(fps[at], fps[at + d], max_bits)]
        edges.append((fps[hit], fps[hit + d]))
    for g in np.flatnonzero((sizes > SMALL_CELL) & ((sizes <= LARGE_CELL) | (not again))):
        edges.extend(_spanning(fps[first[g] : first[g] + sizes[g]], max_bits))
    if again and (sizes > LARGE_CELL).any():
        many = size_of > LARGE_CELL
        cells, points = keys[many], fps[many]
        for i, mask in enumerate(block_masks()):
            edges.extend(group_links(mixed(cells ^ mixed((points & np.uint64(mask)) + np.uint64(i))), points, max_bits, again=False))
    return edges


def links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (``fp``) of at most ``max_bits`` differing bits, at least so many
    that the components are right."""
    count = points.count()
    masks = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in block_masks()])
    # the two bits of a segment as a count: their exclusive or, and their conjunction one place up
    up = F.shiftrightunsigned("fp", 1)
    one, two = (x.bitwiseAND(F.lit(_ODD)) for x in (F.col("fp").bitwiseXOR(up), F.col("fp").bitwiseAND(up)))
    counts = one.bitwiseOR(F.shiftleft(two, 1))
    cells = points.select("fp", counts.alias("c"), F.explode(masks).alias("mask"))
    cells = cells.select(F.xxhash64(F.col("c").bitwiseAND(F.col("mask")), "mask").alias("cell"), "fp")
    parts = numbered_parts(points.sparkSession, count * len(block_masks()) * 16, CELL_PARTITION_BYTES)

    def run(batches):
        found = [(b.column("cell").to_numpy(), b.column("fp").to_numpy()) for b in batches]
        if not found:
            return
        keys, fps = (np.concatenate(x).view(np.uint64) for x in zip(*found))
        edges = group_links(keys, fps, max_bits)
        a, b = (np.concatenate(x).astype(np.uint64).view(np.int64) for x in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 2
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        for at in range(0, len(pairs), 100_000):
            some = pairs[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some[:, 0].copy()), pa.array(some[:, 1].copy())], ["a", "b"])

    return map_arrow(cells.repartition(parts, "cell"), run, "a long, b long").distinct()


def near_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, k1, k2, fp, root, component_id) of each row of ``docs`` (doc_id, text; other columns are ignored).

    ``root`` is one fingerprint of the component, ``component_id`` its smallest doc_id (null if it has none).
    """
    prints = materialized(fingerprints(docs), "fingerprints")
    points = materialized(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "points")
    roots = components(links(points, max_bits)).withColumnRenamed("node", "fp")
    rooted = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.select("fp", "root").join(lows, "root")
    named = named.select(own_shuffle(F.col("fp")).alias("key"), "root", "component_id")
    return prints.withColumn("key", own_shuffle(F.col("fp"))).join(named, "key", "left").drop("key")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` (any columns) without near copies: of each component one row stays, one with its smallest id.

    Of rows with equal id and text one stays, whatever else they hold; rows without an id stay only in a component
    that has no id at all.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2")
    stays = near_groups(docs, max_bits).groupBy("root").agg(F.min(order).alias("row")).select("row.k1", "row.k2")
    # equal rows first: the limit to one applies before the shuffle, and the join needs no other one
    keyed = docs.withColumns(dict(zip(("k1", "k2"), row_keys())))
    once = keyed.withColumn("__n", F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0)))).where("__n = 1")
    return once.join(stays, ["k1", "k2"], "left_semi").select(*docs.columns)


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
