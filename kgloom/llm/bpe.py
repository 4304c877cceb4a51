"""Byte-level BPE by a contiguous rank array, and decoding.

A word is held as its parts and, beside them, the rank of every adjacent pair. The smallest
rank is found by a scan, its boundary deleted, and the two neighbouring ranks refreshed. For
short words, which are nearly all, scans of a few list cells beat any cleverer structure;
words beyond ``LONG_WORD`` bytes take the same steps through a heap, so that a text without
blanks costs n log n. Words repeat, so a worker keeps what it has merged, up to a bound.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table, text_chunks

LONG_WORD = 200
KEPT_WORDS = 400_000
_NONE = 1 << 30
#: how the vocabulary's texts are cut into words before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else a later one."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens as bytes, merges as ranks, and added tokens, of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(_byte_letters())}
        ids = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for token, i in ids.items():
            if token not in added:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = [ids[c] for c in _byte_letters()]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left] << 20 | ids[right]] = rank
            self.merged.append(ids[left + right])
        self.added = added
        self.special = regex.compile("(" + "|".join(regex.escape(x) for x in added) + ")") if added else None
        self.words = regex.compile(PATTERN)
        self.kept: dict[str, bytes] = _Merged(self)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        if self.special is None or self.special.search(text) is None:
            return b"".join(map(self.kept.__getitem__, self.words.findall(text)))
        ids = []
        for i, piece in enumerate(self.special.split(text)):
            if i % 2:
                ids.append(self.added[piece].to_bytes(4, "little"))
            else:
                ids.extend(map(self.kept.__getitem__, self.words.findall(piece)))
        return b"".join(ids)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Merged(dict):
    """Words and their ids; a word that is missing is merged."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        merge = merge_word if len(raw) <= LONG_WORD else merge_long_word
        ids = np.array(merge(raw, self.vocabulary), "<u4").tobytes()
        if len(raw) <= LONG_WORD:
            self[word] = ids
        return ids


def merge_word(word: bytes, vocabulary: Vocabulary) -> list[int]:
    ranks, merged = vocabulary.ranks, vocabulary.merged
    parts = [vocabulary.byte_ids[b] for b in word]
    beside = [ranks.get(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:])]
    while beside:
        least = min(beside)
        if least == _NONE:
            break
        i = beside.index(least)
        parts[i] = merged[least]
        del parts[i + 1], beside[i]
        if i:
            beside[i - 1] = ranks.get(parts[i - 1] << 20 | parts[i], _NONE)
        if i < len(beside):
            beside[i] = ranks.get(parts[i] << 20 | parts[i + 1], _NONE)
    return parts


def merge_long_word(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """The same merges, found through a heap of (rank, place)."""
    ranks, merged = vocabulary.ranks, vocabulary.merged
    parts = [vocabulary.byte_ids[b] for b in word]
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            rank = ranks.get(parts[i] << 20 | parts[after[i]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        if parts[i] != left or after[i] >= n or parts[after[i]] != right:
            continue
        gone = after[i]
        parts[i], parts[gone], after[i] = merged[rank], -1, after[gone]
        if after[gone] < n:
            before[after[gone]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p >= 0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def public_path(name: str) -> str:
    """Where the machine that asks keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with its texts' ids (array of int); null encodes as empty. A column named ``out`` is replaced."""
    docs = docs.drop(out)
    names = docs.columns

    def run(batches):
        known = vocabulary(path)
        for piece in text_chunks(batches, text):
            found = [known.encode(t or "") for t in piece.column(text).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(found))])
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), ids], [*names, out])

    return map_arrow(docs, run, docs.withColumn(out, F.array().cast("array<int>")).schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids decode as empty. A column named ``out`` is replaced."""
    encoded = encoded.drop(out)
    names = encoded.columns

    def run(batches):
        known = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                lists = piece.column(ids)
                texts = [known.decode(lists[i].values.to_numpy().tolist()) if lists[i].is_valid else "" for i in range(len(lists))]
                yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), pa.array(texts, pa.string())], [*names, out])

    return map_arrow(encoded, run, encoded.withColumn(out, F.lit("")).schema)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_path("byte_bpe_50k.json")
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return decode(encoded.drop("text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
