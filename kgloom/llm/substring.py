"""Substring dedup by recompression.

Words are named by a hash of their bytes, and rounds then name runs of a symbol and pairs of
neighbouring symbols by a hash of what they are made of, so equal word sequences get equal
names everywhere without a dictionary being passed around. Which neighbours pair up depends
on the symbols alone (a bit of the name says whether a symbol opens or closes a pair), hence
two equal sequences are parsed alike but for a few symbols at their ends. Each symbol carries
its context: the words on which its being cut out just so depends.

A window of words can then be repeated only if every symbol whose context lies inside it
occurs elsewhere too. Jobs on Spark:

1. equal rows become one with the number of its copies: all of a copied row's windows are
   repeated, so it only tells others what it holds and asks nothing;
2. every document is parsed; symbol names are counted over the corpus, and a document gets
   back which of its symbols are shared;
3. windows with an unshared symbol inside are out; the rest, some per cent on ordinary text
   and all of what is repeated, are verified by 96-bit hashes of their words, counted in the
   same way;
4. words covered by a repeated window are removed.

A word's names are two halves of a 128-bit hash of its bytes; longer sequences are named by
doubling: two halves of equal length, or a run and its length, are put together and mixed
again, so that no sum of powers can vanish for texts made to that end.

Names travel as packed arrays by bucket, those that a batch of documents holds several times
only once, so a name that a third of the corpus shares costs one entry a batch. Everything is
a function of the text, and rows are addressed by two hashes of all they hold; tasks can be
run again at will.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, mixed, table, text_bytes, text_chunks

WINDOW = 35
#: rounds, and those of them that name runs (later symbols side by side may be equal and just stay two)
ROUNDS, RUN_ROUNDS = 5, 1
#: symbols of more words than this pair no further
OPEN_WORDS = 4
#: names that one batch of documents gathers before it passes them on, bytes of names by bucket, and buckets at least
BATCH_NAMES, BUCKET_BYTES, LEAST_BUCKETS = 400_000, 24 << 20, 32
#: copies of a row that one task puts out
COPIES_A_ROW = 4_096
_FAR = 1 << 40
#: in place of a document, of those that ask nothing
_QUIET = 0xFFFFFFFF
_ASK = "bucket int, name binary, check binary, docs binary, doc binary, place binary"
_ASK_NAMES = ["bucket", "name", "check", "docs", "doc", "place"]


def _together(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of sequences made of two."""
    return mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def window_names(names: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Names of the windows that begin at ``at``, by doubling: of powers of two side by side."""
    found, done, size = None, 0, 1
    while True:
        if window & size:
            part = names[at + done]
            found = part if found is None else _together(found, part)
            done += size
        if done == window:
            return found
        names = _together(names[:-size], names[size:])
        size *= 2


class Words:
    """Words of a piece of documents: document, byte range, two hashes, and where each document's words begin."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        breaks = np.zeros(len(data) + 1, bool)
        breaks[offsets] = True
        before = np.concatenate([[True], blank[:-1]])[: len(data)] | breaks[:-1]
        after = np.concatenate([blank[1:], [True]])[: len(data)] | breaks[1:]
        self.data = data
        self.starts = np.flatnonzero(~blank & before)
        self.stops = np.flatnonzero(~blank & after) + 1
        self.firsts = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.firsts))

        self._names: np.ndarray | None = None

    def hashes(self, lane: int) -> np.ndarray:
        """One half of the hash of each word; each distinct word of the piece is hashed once."""
        if self._names is None:
            sizes = self.stops - self.starts
            inside = np.zeros(len(self.data) + 1, np.int8)
            inside[self.starts] = 1
            inside[self.stops] -= 1
            letters = self.data[np.cumsum(inside[:-1]).astype(bool)] if len(sizes) else self.data[:0]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
            coded = pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers).dictionary_encode()
            known = b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist())
            self._names = np.frombuffer(known, "<u8").reshape(-1, 2)[coded.indices.to_numpy(zero_copy_only=False)]
        return self._names[:, lane].copy()


class Symbols:
    """Symbols of a piece: name, words [lo, hi), context [left, right), document."""

    def __init__(self, words: Words, names: np.ndarray):
        n = len(names)
        self.name, self.doc = names, words.doc
        self.lo, self.hi = np.arange(n), np.arange(1, n + 1)
        self.left, self.right = self.lo.copy(), self.hi.copy()

    def _beside(self, which: np.ndarray, step: int) -> None:
        """Widen contexts by those of the neighbours on one side; an end of the document is out of any window."""
        at = np.flatnonzero(which)
        to = at + step
        there = (to >= 0) & (to < len(self.name))
        there[there] = self.doc[to[there]] == self.doc[at[there]]
        left, right = self.left.copy(), self.right.copy()
        a, b = at[there], to[there]
        left[a], right[a] = np.minimum(left[a], self.left[b]), np.maximum(right[a], self.right[b])
        ends = at[~there]
        if step < 0:
            left[ends] = -_FAR
        else:
            right[ends] = _FAR
        self.left, self.right = left, right

    def _join(self, first: np.ndarray, name: np.ndarray) -> None:
        """Keep symbols at ``first``, each grown to the next one kept."""
        last = np.append(first[1:], len(self.name)) - 1
        self.left, self.right = np.minimum.reduceat(self.left, first), np.maximum.reduceat(self.right, first)
        self.lo, self.hi, self.doc, self.name = self.lo[first], self.hi[last], self.doc[first], name

    def name_runs(self) -> None:
        everywhere = np.ones(len(self.name), bool)
        old = self.left, self.right
        self._beside(everywhere, -1)
        left, right = self.left, self.right
        self.left, self.right = old
        self._beside(everywhere, 1)
        self.left, self.right = np.minimum(self.left, left), np.maximum(self.right, right)
        fresh = np.concatenate([[True], (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])])
        first = np.flatnonzero(fresh)
        length = np.diff(np.append(first, len(self.name)))
        name = self.name[first]
        self._join(first, np.where(length > 1, mixed(name + mixed(length.astype(np.uint64))), name))

    def name_pairs(self, salt: int) -> None:
        takes_part = self.hi - self.lo <= OPEN_WORDS
        opens = mixed(self.name ^ np.uint64(salt)) >> np.uint64(63) == 1
        pair = np.zeros(len(self.name), bool)
        pair[:-1] = (takes_part & opens)[:-1] & (takes_part & ~opens)[1:] & (self.doc[1:] == self.doc[:-1])
        closed = np.concatenate([[False], pair[:-1]])
        alone = takes_part & ~pair & ~closed
        # an opening symbol is alone because of what follows it, a closing one because of what precedes it
        old = self.left, self.right
        self._beside(alone & ~opens, -1)
        left, right = self.left, self.right
        self.left, self.right = old
        self._beside(alone & opens, 1)
        self.left, self.right = np.minimum(self.left, left), np.maximum(self.right, right)
        first = np.flatnonzero(~closed)
        name = self.name[first]
        both = pair[first]
        name[both] = mixed(name[both] + mixed(self.name[first[both] + 1] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        self._join(first, name)


def parsed(words: Words, window: int, names: np.ndarray) -> tuple[Symbols, np.ndarray]:
    """(symbols, which of them a window can hold with their context)."""
    found = Symbols(words, names)
    if len(names):
        for r in range(ROUNDS):
            if r < RUN_ROUNDS:
                found.name_runs()
            found.name_pairs(r + 1)
    return found, np.flatnonzero(found.right - found.left <= window)


def candidate_windows(words: Words, symbols: Symbols, unshared: np.ndarray, window: int) -> np.ndarray:
    """First words of windows that lie in one document and hold no unshared symbol with its context."""
    n = len(words.doc)
    if n < window:
        return np.zeros(0, np.int64)
    out = np.zeros(n + 1, np.int64)
    np.add.at(out, np.maximum(symbols.right[unshared] - window, 0), 1)
    np.add.at(out, symbols.left[unshared] + 1, -1)
    ruled_out = np.cumsum(out)[: n - window + 1]
    return np.flatnonzero((ruled_out == 0) & (words.doc[: n - window + 1] == words.doc[window - 1 :]))


class Asker:
    """Gathers (name, check, document, place) of a batch of documents and packs them by bucket.

    What the batch itself holds twice is known to be shared: it is answered at once, and one entry goes out for the
    sake of others.
    """

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.docs, self.size, self.n_docs = buckets, [], [], 0, 0

    def add(self, keys: np.ndarray, copied: np.ndarray, doc: np.ndarray, name: np.ndarray, check: np.ndarray | None, place: np.ndarray) -> None:
        """Of copied rows (they are told nothing) each name counts twice."""
        base = self.n_docs
        self.docs.append(keys)
        self.n_docs += len(keys)
        if check is None:
            check = np.zeros(len(name), "<u4")
        quiet = copied[doc]
        owner = np.where(quiet, _QUIET, doc + base).astype(np.uint32)
        part = (name, check, owner, place.astype(np.uint32))
        if quiet.any():
            part = tuple(np.concatenate([x, x[quiet]]) for x in part)
        self.parts.append(part)
        self.size += len(part[0])

    def rows(self):
        if not self.size:
            self.parts, self.docs, self.n_docs = [], [], 0
            return
        keys = np.concatenate(self.docs)
        name, check, doc, place = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.docs, self.size, self.n_docs = [], [], 0, 0
        order = np.lexsort((check, name))
        name, check, doc, place = name[order], check[order], doc[order], place[order]
        same = (name[1:] == name[:-1]) & (check[1:] == check[:-1])
        fresh = np.concatenate([[True], ~same])
        several = ~fresh
        several[:-1] |= same
        bucket = (name % np.uint64(self.buckets)).astype(np.int64)
        # (whose bucket, which entries, whether they ask): the known are answered in the bucket of their document
        heard = doc != _QUIET
        home = (keys[:, 0][np.where(heard, doc, 0)] % np.uint64(self.buckets)).astype(np.int64)
        for where, chosen, asks in ((bucket, fresh, True), (home, several & heard, False)):
            at = np.flatnonzero(chosen)
            at = at[np.lexsort((place[at], doc[at], where[at]))]
            cuts = np.flatnonzero(np.concatenate([[True], where[at][1:] != where[at][:-1]])) if len(at) else []
            for a, b in zip(cuts, [*cuts[1:], len(at)]):
                some = at[a:b]
                silent = several[some] if asks else np.zeros(len(some), bool)
                used, local = np.unique(doc[some][~silent], return_inverse=True)
                owner = np.full(len(some), _QUIET, np.uint32)
                owner[~silent] = local
                local = owner
                cells = [name[some].tobytes(), check[some].tobytes() if check.any() else b""] if asks else [None, None]
                cells += [keys[used].tobytes(), local.tobytes(), place[some].tobytes()]
                arrays = [pa.array([int(where[some[0]])], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)]
                yield pa.RecordBatch.from_arrays(arrays, _ASK_NAMES)


def shared_places(asked: DataFrame, buckets: int) -> DataFrame:
    """(k1, k2, places): of each document, the places whose (name, check) occurs at least twice in the corpus."""

    def run(batches):
        names, checks, doc, place, keys = [], [], [], [], []
        base = 0
        for batch in batches:
            for name, check, docs, local, at in zip(*(batch.column(n).to_pylist() for n in _ASK_NAMES[1:])):
                known = np.frombuffer(docs, "<u8").reshape(-1, 2)
                local = np.frombuffer(local, "<u4").astype(np.int64)
                silent = local == _QUIET
                local = np.where(silent, -1, local + base)
                base += len(known)
                keys.append(known)
                places = np.frombuffer(at, "<u4")
                if name is None:
                    yield from answers(known, local - base + len(known), places)
                else:
                    names.append(np.frombuffer(name, "<u8"))
                    checks.append(np.frombuffer(check, "<u4"))
                    doc.append(local)
                    place.append(places)
        if not names:
            return
        name, check = np.concatenate(names), np.concatenate(checks)
        names, checks = [], []
        checked = len(check) == len(name)
        order = np.lexsort((check, name)) if checked else np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        if checked:
            same &= check[order][1:] == check[order][:-1]
        several = np.zeros(len(name), bool)
        several[:-1] |= same
        several[1:] |= same
        hit = order[several]
        doc = np.concatenate(doc)[hit]
        place = np.concatenate(place)[hit]
        yield from answers(np.concatenate(keys), doc[doc >= 0], place[doc >= 0])

    def answers(keys, doc, place):
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        for at in range(0, len(first), 5_000):
            own = first[at : at + 5_000]
            stop = first[at + 5_000] if at + 5_000 < len(first) else len(doc)
            lists = pa.ListArray.from_arrays(pa.array(np.append(own, stop) - own[0], pa.int32()), pa.array(place[own[0] : stop].astype(np.int32)))
            k = keys[doc[own]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), lists], ["k1", "k2", "places"])

    dealt = asked.repartition(buckets, "bucket")
    found = map_arrow(dealt, run, "k1 long, k2 long, places array<int>")
    # a document's places: no more than it has words
    return found.groupBy("k1", "k2").agg(F.flatten(F.collect_list("places")).alias("places"))


def _keys(piece: pa.RecordBatch) -> np.ndarray:
    return np.stack([piece.column("k1").to_numpy(), piece.column("k2").to_numpy()], 1).view(np.uint64)


def _places(piece: pa.RecordBatch, firsts: np.ndarray) -> np.ndarray:
    """Places of all documents of a piece, counted along the piece; ``firsts``: where each document's begin."""
    lists = piece.column("places")
    sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64) + np.repeat(firsts[:-1], sizes)


def distinct_rows(docs: DataFrame) -> DataFrame:
    """Each distinct row of ``docs`` once: k1, k2 (hashes of all its columns), text, rest (the other columns), copies."""
    complex_ = (T.MapType, T.StructType, T.ArrayType)
    plain = [F.to_json(F.struct(f"`{f.name}`")) if isinstance(f.dataType, complex_) else F.col(f"`{f.name}`") for f in docs.schema]
    # hashes pass over nulls, so where they are is hashed as well
    cells = [*plain, *[F.col(f"`{c}`").isNull() for c in docs.columns]]
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    keyed = docs.select(
        *[F.xxhash64(F.lit(i), *cells).alias(f"k{i}") for i in (1, 2)], "text", F.struct(F.lit(0).alias("__none"), *rest).alias("rest")
    )
    return keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("rest").alias("rest"), F.count(F.lit(1)).alias("copies"))


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct rows as of ``distinct_rows`` with ``places``: the first words of the row's windows of ``window`` words
    whose sequence also starts elsewhere. Rows with more than one copy repeat all of theirs, and have null for places;
    those of very many copies come in several rows, dealt to different tasks."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-int(size * 0.6) // BUCKET_BYTES))
    rows = distinct_rows(docs)

    def copied(piece):
        return piece.column("copies").to_numpy() > 1

    def symbol_rows(batches):
        asker = Asker(buckets)
        for piece in text_chunks(batches, "text"):
            words = Words(piece.column("text"))
            symbols, useful = parsed(words, window, words.hashes(0))
            ordinal = np.arange(len(symbols.name)) - np.searchsorted(symbols.doc, symbols.doc)
            asker.add(_keys(piece), copied(piece), symbols.doc[useful], symbols.name[useful], None, ordinal[useful])
            if asker.size >= BATCH_NAMES:
                yield from asker.rows()
        yield from asker.rows()

    def window_rows(batches):
        asker = Asker(buckets)
        for piece in text_chunks(batches, "text"):
            words = Words(piece.column("text"))
            names = words.hashes(0)
            symbols, useful = parsed(words, window, names)
            several = copied(piece)
            shared = several[symbols.doc]
            shared[_places(piece, np.searchsorted(symbols.doc, np.arange(piece.num_rows + 1)))] = True
            at = candidate_windows(words, symbols, useful[~shared[useful]], window)
            if len(at):
                name = window_names(names, at, window)
                check = (window_names(words.hashes(1), at, window) >> np.uint64(32)).astype("<u4")
                asker.add(_keys(piece), several, words.doc[at], name, check, at - words.firsts[words.doc[at]])
            if asker.size >= BATCH_NAMES:
                yield from asker.rows()
        yield from asker.rows()

    # all uses take the same columns, so that texts are shuffled once
    shared = shared_places(map_arrow(rows, symbol_rows, _ASK), buckets)
    repeated = shared_places(map_arrow(rows.join(shared, ["k1", "k2"], "left"), window_rows, _ASK), buckets)
    none = F.lit(None).cast("array<int>").alias("places")
    own = ["k1", "k2", "text", "rest"]
    alone = rows.where("copies = 1").join(repeated, ["k1", "k2"], "left").select(*own, "copies", "places")
    few = rows.where(f"copies between 2 and {COPIES_A_ROW}").select(*own, "copies", none)
    many = rows.where(f"copies > {COPIES_A_ROW}").withColumn("part", F.explode(F.expr(f"sequence(0, (copies - 1) div {COPIES_A_ROW})")))
    many = many.repartition("k1", "part").select(*own, F.expr(f"least({COPIES_A_ROW}, copies - part * {COPIES_A_ROW})").alias("copies"), none)
    return alone.unionAll(few).unionAll(many)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text and any columns) with n_words, n_removed and kept: its words without those covered by a
    window that also starts elsewhere, joined by blanks. Columns of these names are replaced. A null text has no words.

    Windows are judged on the input, and every occurrence goes, so what is kept depends on no order. Rows that are equal
    in all columns come out as often as they came in.
    """
    docs = docs.drop("n_words", "n_removed", "kept")

    def run(batches):
        for piece in text_chunks(batches, "text"):
            words = Words(piece.column("text"))
            cover = np.zeros(len(words.doc) + 1, np.int64)
            at = _places(piece, words.firsts)
            np.add.at(cover, at, 1)
            np.add.at(cover, np.minimum(at + window, len(words.doc)), -1)
            n = np.diff(words.firsts)
            whole = (piece.column("copies").to_numpy(zero_copy_only=False) > 1) & (n >= window)
            stays = (np.cumsum(cover)[:-1] == 0) & ~whole[words.doc]
            kept = []
            data = words.data.tobytes()
            for d in range(piece.num_rows):
                own = np.arange(words.firsts[d], words.firsts[d + 1])
                own = own[stays[own]]
                kept.append(b" ".join([data[a:b] for a, b in zip(words.starts[own].tolist(), words.stops[own].tolist())]).decode())
            gone = n - np.array([int(stays[a:b].sum()) for a, b in zip(words.firsts, words.firsts[1:])], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(x) for x in ("text", "rest", "copies")), pa.array(n.astype(np.int64)), pa.array(gone), pa.array(kept, pa.string())],
                ["text", "rest", "copies", "n_words", "n_removed", "kept"],
            )

    rows = removals(docs, window)
    zero = F.lit(0).cast("long")
    schema = rows.select("text", "rest", "copies", zero.alias("n_words"), zero.alias("n_removed"), F.lit("").alias("kept")).schema
    found = map_arrow(rows, run, schema).withColumn("__copy", F.explode(F.expr("array_repeat(0, int(copies))")))
    columns = [F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return found.select(*columns, "n_words", "n_removed", "kept")


def op1_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = """
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), windows AS (
  SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM split)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT rid, i + d AS i FROM repeated, (SELECT unnest(range(35)) AS d)
), words AS (
  SELECT rid, i, w FROM (SELECT rid, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM split)
), kept AS (
  SELECT rid, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (rid)
"""
