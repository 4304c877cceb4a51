"""Small helpers the operators share: table reads, splits, and numpy views of text columns."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: words are runs of anything but these six characters
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: bytes of text that one numpy step works on
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a document belongs to the part that no model learns from (a null id does not)."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def row_keys() -> tuple[Column, Column]:
    """Two hashes of a document's id and text, which together name a row; equal rows share them."""
    return F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2")


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece hold about ``limit`` bytes (one long text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all UTF-8 bytes of a text column, where each text begins and the last ends); null reads as empty."""
    plain = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(plain, pa.ChunkedArray):
        plain = plain.combine_chunks()
    offsets = np.frombuffer(plain.buffers()[1], np.int64, len(plain) + 1, plain.offset * 8)
    data = plain.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbered_parts(spark: SparkSession, n_bytes: int, bytes_each: int) -> int:
    """Partitions for a shuffle of about ``n_bytes``: never fewer than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_bytes) // bytes_each))


@lru_cache(maxsize=8)
def _shipped(application: str) -> str:
    root = Path(__file__).resolve().parents[1]
    base = Path(tempfile.mkdtemp(prefix="kgloom-code-")) / root.name
    return shutil.make_archive(str(base), "zip", root.parent, root.name)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` by a function of this package, which executors get with the job."""
    context = df.sparkSession.sparkContext
    archive = _shipped(context.applicationId)
    if archive not in context._python_includes and Path(archive).name not in context._python_includes:
        context.addPyFile(archive)
    return df.mapInArrow(function, schema)
