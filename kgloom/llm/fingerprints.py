"""Document fingerprints: quartile bucket digest.

Byte triplets of a text are hashed into buckets and counted; each bucket is written as the
quartile its count falls into, after one byte for the text's length. Two digests differ by
the sum of their quartile steps (far quartiles count double) and of their length steps, both
bounded, which makes a likeness between 0 and 1.

The query compares each document with the next one. Neighbours come from one shuffle by
range: documents are cut into ranges at quantiles of the id, and a range also gets a copy of
the document that follows its last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, numbered_parts, table, text_bytes, text_chunks

BUCKETS = 1024
#: which bytes of a window make a triplet; apart, they tell documents of one language better than neighbours do
TRIPLETS = [(0, 3, 8)]
#: cost of the farthest quartiles, most that lengths count, and the share of the largest difference that counts as none alike
FAR_STEP, LENGTH_STEPS, BOUND = 6, 24, 0.35
RANGE_BYTES = 32 << 20


def bucket_counts(column: pa.Array) -> np.ndarray:
    """Triplets of each text by bucket."""
    data, offsets = text_bytes(column)
    counts = np.zeros(len(column) * BUCKETS, np.int64)
    owner = np.repeat(np.arange(len(column), dtype=np.int64), np.diff(offsets))
    wide = data.astype(np.uint32)
    for salt, (i, j, k) in enumerate(TRIPLETS):
        n = len(wide) - k
        if n <= 0:
            continue
        h = wide[i : i + n] * np.uint32(0x9E3779B1) + wide[j : j + n] * np.uint32(0x85EBCA6B) + wide[k : k + n] * np.uint32(0xC2B2AE35)
        h += np.uint32(salt * 0x27D4EB2F)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        inside = owner[:n] == owner[k:]
        counts += np.bincount((owner[:n] * BUCKETS + (h >> np.uint32(32 - BUCKETS.bit_length() + 1)))[inside], minlength=len(counts))
    return counts.reshape(-1, BUCKETS)


def digests(column: pa.Array) -> np.ndarray:
    """A row a text: the length step, then each bucket's quartile (0 to 3)."""
    counts = bucket_counts(column)
    _, offsets = text_bytes(column)
    ranked = np.sort(counts, axis=1)
    quartile = sum((counts > ranked[:, [BUCKETS * q // 4 - 1]]).astype(np.uint8) for q in (1, 2, 3))
    length = np.minimum(np.floor(4 * np.log2(1.0 + np.diff(offsets))), 255).astype(np.uint8)
    return np.concatenate([length[:, None], quartile.astype(np.uint8)], axis=1)


def hexadecimal(found: np.ndarray) -> list[str]:
    q = found[:, 1:].reshape(len(found), BUCKETS // 4, 4)
    packed = (q[..., 0] << 6 | q[..., 1] << 4 | q[..., 2] << 2 | q[..., 3]).astype(np.uint8)
    rows = np.concatenate([found[:, :1], packed], axis=1)
    return [r.tobytes().hex() for r in rows]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 from a bounded difference on."""
    steps = np.abs(a[:, 1:].astype(np.int16) - b[:, 1:])
    steps[steps == 3] = FAR_STEP
    length = np.minimum(np.abs(a[:, 0].astype(np.int16) - b[:, 0]), LENGTH_STEPS)
    return 1 - np.minimum(1.0, (steps.sum(axis=1) + length) / (BOUND * (FAR_STEP * BUCKETS + LENGTH_STEPS)))


def in_ranges(docs: DataFrame, n_ranges: int) -> DataFrame:
    """(range, extra, doc_id, text) so that within a range, in this order, each document that is not ``extra`` is
    followed by the next one by descending id (after the last comes the first)."""
    from pyspark.ml.feature import Bucketizer

    lowest = F.lit(-(1 << 63)).cast("long")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), lowest).alias("k"))
    cuts = keyed.select(F.col("k").cast("double").alias("v")).approxQuantile("v", [i / n_ranges for i in range(1, n_ranges)], 0.2 / n_ranges) if n_ranges > 1 else []
    if cuts:
        cut = Bucketizer(splits=[-float("inf"), *sorted(set(cuts)), float("inf")], inputCol="v", outputCol="range")
        ranged = cut.transform(keyed.withColumn("v", F.col("k").cast("double"))).withColumn("range", F.col("range").cast("int")).drop("v")
    else:
        ranged = keyed.withColumn("range", F.lit(0))
    # one row a range: the id of its first document, wanted by the range above
    firsts = sorted((r["range"], r.k) for r in ranged.groupBy("range").agg(F.max("k").alias("k")).collect())
    wanted = [(k, firsts[(i + 1) % len(firsts)][0]) for i, (_, k) in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(wanted, "k long, wanted int")
    places = F.array(F.struct(F.col("range"), F.lit(False).alias("extra")), F.struct(F.col("wanted").alias("range"), F.lit(True).alias("extra")))
    placed = ranged.join(F.broadcast(heads), "k", "left").withColumn("place", F.explode(F.filter(places, lambda p: p["range"].isNotNull())))
    placed = placed.select("place.range", "place.extra", "doc_id", "text", "k", F.xxhash64("text").alias("h"))
    dealt = placed.repartition(max(n_ranges, 1), "range")
    return dealt.sortWithinPartitions("range", "extra", F.desc("k"), "h", "text").select("range", "extra", "doc_id", "text")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text; other columns are ignored): n_chars, fingerprint, the edited text and its
    fingerprint, and the likeness to the edited text and to the next document.

    Null texts are empty. Documents go by descending id, null ids last, equal ids by a hash of the text. The edited
    text keeps the first half of a document (rounded up) and goes on with as many code points of the next one.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = in_ranges(docs, numbered_parts(docs.sparkSession, size, RANGE_BYTES))
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_chars", "fingerprint", "edited", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        carry = None
        for piece in text_chunks(batches, "text"):
            rows = pa.Table.from_batches([piece] if carry is None else [carry, piece]).combine_chunks()
            carry = piece.slice(piece.num_rows - 1)
            rows = rows.to_batches()[0]
            own = digests(rows.column("text"))
            at = np.flatnonzero(~rows.column("extra").to_numpy(zero_copy_only=False)[:-1])
            if not len(at):
                continue
            texts = rows.column("text").to_pylist()
            n = [len(texts[i]) for i in at]
            edited = pa.array([texts[i][: k - k // 2] + texts[i + 1][: k // 2] for i, k in zip(at, n)], pa.string())
            changed = digests(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(at)), pa.array(n, pa.int64()), pa.array(hexadecimal(own[at])), edited,
                    pa.array(hexadecimal(changed)), pa.array(likeness(own[at], changed)), pa.array(likeness(own[at], own[at + 1])),
                ],
                names,
            )

    schema = f"doc_id {kind}, n_chars long, fingerprint string, edited string, edited_fingerprint string, near_edited double, near_next double"
    return map_arrow(rows, run, schema)


def op6_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
