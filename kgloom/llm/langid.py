"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed bigrams and trigrams of letters per language, one narrow pass and
one aggregate; the log-probability matrix (languages x buckets) is broadcast in slices of
languages, and texts are scored in numpy by sparse gathers, a chunk of texts and a slice at a
time. Beyond one slice, counts are written to the shared folder and read back by slices, so
neither driver nor worker holds more than one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgloom.session import materialized

from .common import CHUNK_BYTES, held_out, map_arrow, mixed, table, text_bytes, text_chunks

BUCKETS = 1 << 15
#: bytes of text that are scored or counted at once (a byte takes about 40 of memory), n-grams that are hashed at once
PIECE_BYTES, BLOCK_KEYS = 1 << 18, 1 << 15
#: the classifier is fitted on about so many labelled documents of each language, chosen by a hash of the id
TRAIN_DOCS = 40_000
#: languages that are counted, fitted and scored at once
SLICE_LANGUAGES = 64
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code points by their lower case; whatever is no letter becomes a blank."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Hash buckets of ``keys``, a block at a time, so that only the result is as long as they are."""
    out = np.empty(len(keys), np.int32)
    for at in range(0, len(keys), BLOCK_KEYS):
        out[at : at + BLOCK_KEYS] = mixed(keys[at : at + BLOCK_KEYS]) % np.uint64(buckets)
    return out


def hashed_ngrams(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every bigram and trigram, text it belongs to), without those of blanks only; 32-bit integers."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    firsts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])[offsets]
    owner = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(firsts))
    points = _folded()[points]
    same = owner[:-1] == owner[1:]
    keep2 = same & ((points[:-1] != 32) | (points[1:] != 32))
    keep3 = same[:-1] & same[1:] & keep2[:-1] & keep2[1:]
    pair = points[:-1].astype(np.uint64)
    pair <<= np.uint64(21)
    pair |= points[1:]
    ids = [_buckets(pair[keep2], buckets)]
    triple = pair[:-1]
    triple <<= np.uint64(21)
    triple |= points[2:]
    triple |= np.uint64(1 << 63)
    ids.append(_buckets(triple[keep3], buckets))
    return np.concatenate(ids), np.concatenate([owner[:-1][keep2], owner[:-2][keep3]])


def ngram_counts(labelled: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) over rows of (lang, text)."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for piece in text_chunks(batches, "text", PIECE_BYTES):
            langs, codes = np.unique(np.array(piece.column("lang").to_pylist(), object), return_inverse=True)
            ids, owners = hashed_ngrams(piece.column("text"), buckets)
            for first in range(0, len(langs), SLICE_LANGUAGES):
                some = langs[first : first + SLICE_LANGUAGES]
                mine = ((codes >= first) & (codes < first + len(some)))[owners]
                keys = (codes[owners[mine]] - first) * buckets + ids[mine]
                counts = np.bincount(keys, minlength=len(some) * buckets).reshape(len(some), buckets)
                for lang, n in zip(some, counts):
                    total[lang] = total.get(lang, 0) + n
                if len(total) > SLICE_LANGUAGES:
                    yield from rows_of(total)
                    total = {}
        yield from rows_of(total)

    def rows_of(total):
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    rows = map_arrow(labelled.select("lang", "text"), count, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _read(part) -> np.ndarray:
    """A slice, which a worker reads from its file again each time and does not keep."""
    if isinstance(part, np.ndarray):
        return part
    path = getattr(part, "_path", None)
    return part.load_from_path(path) if path else part.value


class LanguageModel:
    """Languages in order, log priors, and slices of log probabilities (buckets x languages), arrays or broadcast ones."""

    def __init__(self, languages: list[str], prior: np.ndarray, slices: list, buckets: int = BUCKETS):
        self.languages, self.prior, self.slices, self.buckets = languages, prior, slices, buckets

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(best language's number, its posterior) of each text."""
        ids, owners = hashed_ngrams(column, self.buckets)
        n, at = len(column), 0
        best, top, total = np.zeros(n, np.int64), np.full(n, -np.inf), np.zeros(n)
        for weights in map(_read, self.slices):
            width = weights.shape[1]
            sums = np.stack([np.bincount(owners, weights[ids, k], minlength=n) for k in range(width)], 1)
            sums = sums + self.prior[at : at + width]  # counts of no text at all are integers
            most = sums.max(1)
            best = np.where(most > top, at + sums.argmax(1), best)
            above = np.maximum(top, most)
            total = total * np.exp(top - above) + np.exp(sums - above[:, None]).sum(1)
            top, at = above, at + width
        return best, 1 / total


def fit(
    labelled: DataFrame,
    buckets: int = BUCKETS,
    train_docs: int = TRAIN_DOCS,
    max_languages: int | None = None,
) -> LanguageModel | None:
    """Fit on rows of (doc_id, lang, text); rows without lang or text teach nothing. None: nothing to learn from."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    per_language = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    if max_languages is not None:
        per_language = per_language.limit(max_languages + 1)
    sizes = {r.lang: r.n for r in per_language.collect()}
    if not sizes:
        return None
    if max_languages is not None and len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    # smaller languages are taken whole
    large = [F.lit(x) for lang, n in sizes.items() if n > train_docs for x in (lang, train_docs / n)]
    chosen = labelled.where(draw < F.coalesce(F.create_map(*large)[F.col("lang")], F.lit(1.0))) if large else labelled
    counts = ngram_counts(chosen, buckets)
    languages = sorted(sizes)
    prior = np.log([sizes[x] for x in languages]) - np.log(sum(sizes.values()))
    if len(languages) <= SLICE_LANGUAGES:
        return LanguageModel(languages, prior, [_weights(counts, languages, buckets)], buckets)
    counts = materialized(counts.repartitionByRange("lang").sortWithinPartitions("lang"), "language-counts")
    slices = []
    for at in range(0, len(languages), SLICE_LANGUAGES):
        some = languages[at : at + SLICE_LANGUAGES]
        part = counts.where(F.col("lang").between(some[0], some[-1]))
        slices.append(labelled.sparkSession.sparkContext.broadcast(_weights(part, some, buckets)))
    return LanguageModel(languages, prior, slices, buckets)


def _weights(counts: DataFrame, languages: list[str], buckets: int) -> np.ndarray:
    """Log probability of each bucket in these languages."""
    counts = counts.toPandas()
    table_ = np.full((buckets, len(languages)), 0.5)
    where = {lang: i for i, lang in enumerate(languages)}
    table_[counts["bucket"].to_numpy(int), counts["lang"].map(where).to_numpy(int)] += counts["n"].to_numpy(float)
    return np.log(table_ / table_.sum(0))


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (any columns, a ``text``) with lang_pred and score.

    A text that is null or has no letter is ``und`` with score 0; so is every text when
    there was nothing to learn from. Columns of the same names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = spark.sparkContext.broadcast((model.languages, model.prior, model.buckets))
    slices = [spark.sparkContext.broadcast(x) if isinstance(x, np.ndarray) else x for x in model.slices]
    names = docs.columns
    marked = docs.withColumn("__letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches):
        languages, prior, buckets = shared.value
        # a single slice is kept; several are read again for each piece, which is larger then
        model = LanguageModel(languages, prior, slices if len(slices) > 1 else [slices[0].value], buckets)
        for piece in text_chunks(batches, "text", PIECE_BYTES if len(slices) == 1 else CHUNK_BYTES):
            best, score = model.score(piece.column("text"))
            letters = piece.column("__letters").to_numpy(zero_copy_only=False)
            langs = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(n) for n in names] + [pa.array(langs, pa.string()), pa.array(np.where(letters, score, 0.0))],
                [*names, "lang_pred", "score"],
            )

    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return map_arrow(marked, run, schema)


def learned(docs: DataFrame) -> LanguageModel | None:
    """Model from the documents that are not held out (crc32 of the id mod 4 is not 2)."""
    return fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    return predict(marked, learned(docs)).select("doc_id", "held_out", "lang_pred", "score")
