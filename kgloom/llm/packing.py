"""Packing: concatenate and cut.

All documents, in a fixed order, form one run of tokens, cut every ``length`` tokens. The
first pass encodes each document and adds up tokens along each partition; prefix sums over
the partitions' totals (one row a partition) then give every document its global offset,
from which its pieces follow without meeting any other document. Only the very last
sequence can need padding.

Encoded documents are written once to the shared folder: the order and the offsets must be
the same whenever a task is run again.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgloom.session import scratch_path

from .bpe import PATTERN, public_path, vocabulary
from .common import map_arrow, table, text_chunks

LENGTH = 2048
END_OF_DOCUMENT = 1


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    known = vocabulary(path)
    ranks = {b: i for i, b in enumerate(known.bytes_of) if i not in known.added.values()}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=known.added)


def _ids(text: str, path: str) -> np.ndarray:
    """Ids of a text. ``tiktoken`` refuses texts with runs of about a million blanks; these go through the vocabulary."""
    encoding = _encoding(path)
    try:
        return np.array(encoding.encode(text, allowed_special=encoding.special_tokens_set), "<u4")
    except ValueError:
        return np.frombuffer(vocabulary(path).encode(text), "<u4")


def tokenized(docs: DataFrame, path: str, end: int = END_OF_DOCUMENT) -> DataFrame:
    """(doc_id, part, before, n, ids): each document's ids as little-endian unsigned 32-bit integers, its
    partition, and the tokens of the partition's documents before it. Null and empty texts are the end mark alone."""

    def run(batches):
        before = 0
        for piece in text_chunks(batches, "text"):
            found = []
            for text in piece.column("text").to_pylist():
                ids = _ids(text, path).tobytes() if text else b""
                found.append(ids + end.to_bytes(4, "little"))
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("part"), pa.array(starts), pa.array(sizes), pa.array(found, pa.binary())],
                ["doc_id", "part", "before", "n", "ids"],
            )

    numbered = docs.select("doc_id", F.spark_partition_id().alias("part"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(numbered, run, f"doc_id {kind}, part int, before long, n long, ids binary")


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Pieces of the rows of ``docs`` (doc_id, text; other columns are ignored; repeated rows are packed each).

    A piece: doc_id, start (the document's tokens before it), length, ids (as in ``tokenized``), doc_tokens,
    sequence_id, offset in the sequence, and whether the sequence's boundary cuts the document before or after it.
    """
    spark = docs.sparkSession
    where = scratch_path(spark, "tokens")
    tokens = tokenized(docs, path, end)
    tokens.write.option("compression", "zstd").parquet(where)
    tokens = spark.read.schema(tokens.schema).parquet(where)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    # one row for each partition of the first pass, whatever the size of the documents
    base = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(base, F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("before"))
    last = F.expr(f"(at + n - 1) div {length}")
    cut = placed.select("*", F.explode(F.sequence(F.expr(f"at div {length}"), last)).alias("sequence_id"))
    first = F.greatest("at", F.col("sequence_id") * length)
    stop = F.least(F.col("at") + F.col("n"), (F.col("sequence_id") + 1) * length)
    start = first - F.col("at")
    size = stop - first
    return cut.select(
        "doc_id",
        start.alias("start"),
        size.alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        (first - F.col("sequence_id") * length).alias("offset"),
        (start > 0).alias("cut_before"),
        (start + size < F.col("n")).alias("cut_after"),
    )


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cut_before", "cut_after"
    )


def op10_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json")))
