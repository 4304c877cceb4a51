"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic text, that is on
the segments which toxic texts hold far more often than ordinary ones (on windows of toxic
texts where there are no such segments). Segments are words or, in writing without blanks,
runs of characters. A window of words is
compressed with the ordinary dictionary, and with the toxic one laid before it (so that what
both know costs the same and differences are the toxic segments' alone). The gap between the
two lengths is compared with a threshold calibrated on ordinary windows; the windows over it
give a document's features, and a logistic fit turns these into a score.

Training takes a bounded sample of labelled rows (``TRAIN_DOCS`` of each label, by a hash of
the id); scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kgloom.session import materialized

from .common import held_out, map_arrow, mixed, table, text_chunks

#: labelled documents of each label that training takes at most, about
TRAIN_DOCS = 12_000
#: windows of ordinary text for the ordinary dictionary, and its bytes
ORDINARY_WINDOWS, ORDINARY_BYTES = 60_000, 64_000
#: a toxic segment is in some toxic texts and so many times as often in them as in ordinary ones, and it is either in this
#: share of all toxic texts or there is evidence for it: its log-likelihood ratio is one that chance gives none of the
#: candidates with this probability. Near copies, whose rare words chance would not explain, count once
SEGMENT_SHARE, SEGMENT_TEXTS, SEGMENT_RATIO, SEGMENT_CHANCE = 0.02, 5, 8.0, 0.01
SHINGLE_WORDS, BANDS = 3, 8
#: bytes of a word that is a segment; of longer ones (writing without blanks) runs of so many characters are
WORD_BYTES, RUN_CHARACTERS, RUN_BYTES = (3, 40), (2, 4, 6), 6
#: rows that a task hands on at once, about
SEGMENT_ROWS = 50_000
WINDOW_WORDS = 12
#: a window inside a long word has about so many bytes, and at least so many characters
WINDOW_BYTES, WINDOW_CHARACTERS = 75, 30
LEVEL = 6
#: share of ordinary windows that may reach the window threshold
FALSE_WINDOWS = 0.005
TOXIC_FROM = 0.7


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes = b""
    toxic: bytes = b""
    threshold: int = 2
    weights: tuple[float, ...] = field(default=(0.0,) * 10)

    @property
    def able(self) -> bool:
        return bool(self.toxic)


@lru_cache(maxsize=2)
def _compressors(ordinary: bytes, toxic: bytes):
    import zstandard

    def compressor(content: bytes):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=known, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)

    return compressor(ordinary), compressor(toxic + ordinary)


def windows(text: bytes) -> list[bytes]:
    """Windows of words; a long word has windows of its own, which overlap by less than the longest run."""
    words = text.split()
    ends = [i for i, w in enumerate(words) if len(w) > WORD_BYTES[1]]
    out, at = [], 0
    for end in [*ends, len(words)]:
        out += [b" " + b" ".join(words[i : min(i + WINDOW_WORDS, end)]) + b" " for i in range(at, end, WINDOW_WORDS)]
        at = end + 1
        if end < len(words):
            word, overlap = words[end].decode(), RUN_CHARACTERS[-1] - 1
            size = max(WINDOW_CHARACTERS, WINDOW_BYTES * len(word) // len(words[end]))
            out += [b" " + word[i : i + size].encode() + b" " for i in range(0, max(1, len(word) - overlap), size - overlap)]
    return out


def segments(text: bytes) -> Iterator[list[str]]:
    """Every segment of a text once, in lists."""
    words = set(text.split())
    least, most = WORD_BYTES
    yield [w.decode() for w in words if least <= len(w) <= most]
    long = " ".join(w.decode() for w in words if len(w) > most)
    points = np.frombuffer(long.encode("utf-32-le"), np.uint32).astype(np.uint64)
    for k in RUN_CHARACTERS:
        n = len(points) - k + 1
        if n < 1:
            continue
        hashed, inside = np.zeros(n, np.uint64), np.ones(n, bool)
        for j in range(k):
            hashed = mixed(hashed ^ (points[j : j + n] + np.uint64(1)))
            inside &= points[j : j + n] != 32
        firsts = np.flatnonzero(inside)[np.unique(hashed[inside], return_index=True)[1]]
        for at in range(0, len(firsts), SEGMENT_ROWS):
            runs = [long[i : i + k] for i in firsts[at : at + SEGMENT_ROWS].tolist()]
            yield [r for r in runs if len(r.encode()) >= RUN_BYTES]


def gaps(text: bytes, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """How many bytes less each window takes when toxic segments are known."""
    plain, aware = (c.compress for c in _compressors(ordinary, toxic))
    return np.array([len(plain(w)) - len(aware(w)) for w in windows(text)], np.int64)


def features(found: np.ndarray, threshold: int) -> list[float]:
    """Windows over the threshold: their share, and how many there are by how far they are over it."""
    n = max(1, len(found))
    by_gap = np.bincount(np.clip(found - threshold, -1, 5) + 1, minlength=7)[1:]
    over = int(by_gap.sum())
    return [1.0, np.log1p(n), np.log1p(over), over / n, *np.minimum(by_gap, 3).astype(float)]


def _gap_rows(docs: DataFrame, model: ToxicityModel, threshold: int) -> DataFrame:
    """(toxic, doc features, rates of windows with a gap of 1, 2, ... 8 and more) of labelled documents."""

    def run(batches):
        for piece in text_chunks(batches, "text"):
            found = [gaps((t or "").encode(), model.ordinary, model.toxic) for t in piece.column("text").to_pylist()]
            tail = [[int((g >= k).sum()) for k in range(9)] for g in found]
            x = [features(g, threshold) for g in found]
            arrays = [piece.column("toxic"), pa.array(x, pa.list_(pa.float64())), pa.array(tail, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["toxic", "x", "tail"])

    return map_arrow(docs.select("text", "toxic"), run, "toxic int, x array<double>, tail array<long>")


def _segment_rows(docs: DataFrame) -> DataFrame:
    """(toxic, word): the segments of each row of (toxic, text), each once."""

    def run(batches):
        toxic, found = [], []
        for piece in text_chunks(batches, "text"):
            for label, text in zip(piece.column("toxic").to_pylist(), piece.column("text").to_pylist()):
                for some in segments(text.encode()):
                    found += some
                    toxic += [label] * len(some)
                    if len(found) >= SEGMENT_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.string())], ["toxic", "word"])
                        toxic, found = [], []
        yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.string())], ["toxic", "word"])

    return map_arrow(docs.select("toxic", "text"), run, "toxic int, word string")


def _trained_dictionary(docs: DataFrame) -> bytes:
    import zstandard

    def run(batches):
        for piece in text_chunks(batches, "text"):
            found = [w for t in piece.column("text").to_pylist() for w in windows((t or "").encode())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["window"])

    spread = map_arrow(docs.select("text"), run, "window binary").distinct()
    # thinned out before the sort, so that tasks hand on about as many windows as are wanted in all
    share = 1.1 * ORDINARY_WINDOWS / max(1, spread.count())
    drawn = F.pmod(F.xxhash64(F.lit("draw"), "window"), F.lit(1 << 30)) / float(1 << 30)
    rows = spread.where(drawn < share).orderBy(drawn, "window").limit(ORDINARY_WINDOWS).collect()
    samples = [bytes(r.window) for r in rows]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(samples)[-ORDINARY_BYTES:]


def evidence_limit(candidates: int) -> float:
    """The log-likelihood ratio that chance gives none of so many candidates, but for ``SEGMENT_CHANCE`` (corrected for
    their number; the ratio of a word that both kinds of texts hold alike follows chi-square with one degree)."""
    low, high = 0.0, 1_400.0
    while high - low > 1e-6:
        middle = (low + high) / 2
        low, high = (middle, high) if math.erfc(math.sqrt(middle / 2)) * max(1, candidates) > SEGMENT_CHANCE else (low, middle)
    return high


def _bands(text: str) -> np.ndarray:
    """Names of pairs of least hashes of a text's shingles; near copies share some of them."""
    import xxhash

    words = text.encode().split()
    runs = range(max(1, len(words) - SHINGLE_WORDS + 1))
    hashed = np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i : i + SHINGLE_WORDS])) for i in runs], np.uint64)
    least = np.array([mixed(hashed ^ np.uint64(2 * k + 1)).min() for k in range(2 * BANDS)], np.uint64)
    return mixed(least[::2] + mixed(least[1::2] ^ np.arange(BANDS, dtype=np.uint64))).view(np.int64)


def _copies_once(docs: DataFrame) -> DataFrame:
    """(toxic, text) without near copies: a text stays if none that shares a band has a lesser hash. Equal texts are one,
    toxic if any is."""

    def run(batches):
        for piece in text_chunks(batches, "text"):
            found = [_bands(t) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), piece.column("h")], ["bands", "h"])

    named = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("h"), "toxic", "text")
    texts = materialized(named.groupBy("h").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")), "toxicity-texts")
    bands = map_arrow(texts.select("text", "h"), run, "bands array<long>, h long").select("h", F.explode("bands").alias("band"))
    least = F.min("h").over(Window.partitionBy("band"))
    later = bands.withColumn("least", least).where("h > least").select("h").distinct()
    return texts.join(later, "h", "left_anti").select("toxic", "text")


def _toxic_dictionary(docs: DataFrame, segment_share: float, segment_ratio: float) -> bytes:
    """Segments of toxic texts, those of most evidence last (the nearest of equal matches is the cheapest). They come
    from the bounded sample, which bounds their number."""
    once = materialized(_copies_once(docs), "toxicity-once")
    sizes = {r.toxic: r.n for r in once.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = _segment_rows(once).groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine"))
    counts = materialized(counts.where(F.col("bad") >= SEGMENT_TEXTS), "toxicity-segments")
    rate = (F.col("bad") / max(1, sizes.get(1, 0))) / ((F.col("fine") + 0.5) / max(1, sizes.get(0, 0)))
    least = max(SEGMENT_TEXTS, segment_share * sizes.get(1, 0))
    both, bad_share = F.col("bad") + F.col("fine"), sizes.get(1, 0) / max(1, sum(sizes.values()))
    expected = lambda n, share: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (both * share))).otherwise(0.0)
    evidence = 2 * (expected("bad", bad_share) + expected("fine", 1 - bad_share))
    found = counts.where(rate >= segment_ratio).withColumn("evidence", evidence)
    found = found.where((F.col("bad") >= least) | (F.col("evidence") >= evidence_limit(counts.count())))
    top = found.orderBy("evidence", "bad", F.desc("word")).select("word").collect()
    return (" " + " ".join(r.word for r in top) + " ").encode() if top else b""


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton's steps."""
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.1] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        s = weight * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * s[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int = TRAIN_DOCS,
    segment_share: float = SEGMENT_SHARE,
    segment_ratio: float = SEGMENT_RATIO,
) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic): a document labelled twice counts as toxic if
    either label says so. Null ids, texts and labels teach nothing. Without toxic or without ordinary texts the model is
    unable: it scores everything 0."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return ToxicityModel()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, train_docs / sizes[1]).otherwise(train_docs / sizes[0])
    # at most about 2 x train_docs rows of two numbers
    chosen = known.where(draw < share)
    train = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    toxic = _toxic_dictionary(train, segment_share, segment_ratio) or _trained_dictionary(train.where("toxic = 1"))
    if not toxic:
        return ToxicityModel()
    model = ToxicityModel(_trained_dictionary(train.where("toxic = 0")), toxic)
    tails = _gap_rows(train.where("toxic = 0"), model, 2).select(F.posexplode("tail").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    reached = {r.k: r.n for r in tails.collect()}
    within = [k for k in range(1, 9) if reached.get(k, 0) <= FALSE_WINDOWS * max(1, reached.get(0, 0))]
    threshold = max(2, within[0]) if within else 8
    # sums over equal feature rows: most documents have none of a few hundred
    rows = _gap_rows(train, model, threshold).groupBy("toxic", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
    n = np.array([r.n for r in rows], float)
    whole = {k: sizes[k] / max(1.0, n[y == k].sum()) for k in (0, 1)}
    weight = n * np.where(y == 1, whole[1], whole[0])
    weight *= n.sum() / weight.sum()
    return ToxicityModel(model.ordinary, model.toxic, threshold, tuple(_logistic(x, y, weight)))


def predict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` (any columns, a ``text``) with score (0 to 1) and predicted (1 from 0.7). Null and empty texts have no
    window and get the score of a text without findings. Columns of the same names are replaced."""
    docs = docs.drop("score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        weights = np.array(model.weights)
        for piece in text_chunks(batches, "text"):
            if model.able:
                texts = piece.column("text").to_pylist()
                x = np.array([features(gaps((t or "").encode(), model.ordinary, model.toxic), model.threshold) for t in texts])
                score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            else:
                score = np.zeros(piece.num_rows)
            yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), pa.array(score)], [*names, "score"])

    scored = map_arrow(docs, run, docs.withColumn("score", F.lit(0.0)).schema)
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def learned(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Model from the labels that are not held out (crc32 of the id mod 3 is not 1)."""
    return fit(docs, labels.where(~held_out(F.col("doc_id"), 3, 1)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(docs, table(spark, sf_dir, "labels"))
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    return predict(marked, model).select("doc_id", "held_out", "score", "predicted")
