"""Substring dedup against every window compared with every other."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kgloom.llm import substring


def brute(texts, window):
    split = [[w for w in (t or "").encode().split()] for t in texts]
    seen = Counter(tuple(ws[i : i + window]) for ws in split for i in range(len(ws) - window + 1))
    rows = []
    for ws in split:
        gone = {j for i in range(len(ws) - window + 1) if seen[tuple(ws[i : i + window])] > 1 for j in range(i, i + window)}
        rows.append((len(ws), len(gone), b" ".join(w for j, w in enumerate(ws) if j not in gone).decode()))
    return rows


def repetitive(seed):
    draw = random.Random(seed)
    passages = [" ".join(draw.choices("abcdefgh", k=draw.randint(3, 60))) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [draw.choice(passages) if draw.random() < 0.3 else " ".join(draw.choices("abcd", k=draw.randint(0, 30))) for _ in range(4)]
        parts += ["q " * draw.randint(0, 90), "x y " * draw.randint(0, 40)][: draw.randint(0, 2)]
        draw.shuffle(parts)
        texts.append(draw.choice([" ", "\n", "\t\x0b "]).join(parts))
    return texts


@pytest.mark.parametrize("window", [5, 35])
def test_random_repeats(spark, window):
    texts = repetitive(window)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(docs, window).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_edges(spark, edge_docs, clashing_docs, no_docs):
    rows = edge_docs.collect()
    want = Counter(zip([r.doc_id for r in rows], brute([r.text for r in rows], 35)))
    for docs in (edge_docs, clashing_docs):
        found = substring.without_repeats(docs)
        assert Counter((r.doc_id, (r.n_words, r.n_removed, r.kept)) for r in found.collect()) == want
    assert substring.without_repeats(no_docs).count() == 0


def test_equal_windows_are_parsed_alike():
    """Of equal windows, the symbols whose context lies inside are equal."""
    for seed in range(30):
        draw = random.Random(seed)
        inner = draw.choices("abcdef", k=40)
        texts = [" ".join(draw.choices("abcdef", k=draw.randint(0, 20)) + inner + draw.choices("abcdef", k=draw.randint(0, 20))) for _ in range(2)]
        found = []
        for text in texts:
            words = substring.Words(pa.array([text]))
            symbols, useful = substring.parsed(words, 35, words.hashes(0))
            at = " ".join(text.split()).find(" ".join(inner)) // 2
            inside = useful[(symbols.left[useful] >= at) & (symbols.right[useful] <= at + 40)]
            found.append({(int(symbols.lo[i]) - at, int(symbols.hi[i]) - at, int(symbols.name[i])) for i in inside})
        assert found[0] == found[1]


def test_words_are_those_of_the_contract():
    text = "a\x1cb c\x85d　e  f\n\ng"
    words = substring.Words(pa.array([text, "", " ", "h"]))
    data = words.data.tobytes()
    assert [data[a:b] for a, b in zip(words.starts, words.stops)] == [*text.encode().split(), b"h"]
    assert words.firsts.tolist() == [0, 4, 4, 4, 5]


def test_a_word_hashes_alike_anywhere():
    words = substring.Words(pa.array(["ab cd ab", "cd"]))
    h = words.hashes(0)
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1]
    assert len(np.unique(substring.Words(pa.array([" ".join(f"w{i}" for i in range(50_000))])).hashes(0))) == 50_000


def test_query_digest(spark, edge_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in substring.op1_recompression(spark, str(tmp_path)).collect())
    rows = edge_docs.collect()
    want = Counter((r.doc_id, n, g, hashlib.sha256(k.encode()).hexdigest()) for r, (n, g, k) in zip(rows, brute([r.text for r in rows], 35)))
    assert got == want


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_made_to_collide(spark, size):
    """Words that differ in every letter, for which sums of powers of an odd number vanish modulo powers of two."""
    tail = " ".join(f"w{i}" for i in range(34))
    texts = [f"{thue_morse(size, 'a', 'b')} {tail}", f"{thue_morse(size, 'b', 'a')} {tail}"]
    texts += [thue_morse(64, "p ", "q "), thue_morse(64, "q ", "p ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(docs).collect()}
    assert [got[i] for i in range(4)] == brute(texts, 35)
    assert got[0][1] == got[1][1] == 0


def test_many_equal_rows(spark, monkeypatch):
    """A third of all rows are equal; they cost as much as their number, and come out as often."""
    monkeypatch.setattr(substring, "COPIES_A_ROW", 7)
    passage = " ".join(f"w{i}" for i in range(50))
    rows = [(1, passage + " and more")] * 500 + [(2, "short text")] * 500
    rows += [(10 + i, f"a{i} {passage} b{i}" if i % 10 == 0 else " ".join(f"x{i}y{j}" for j in range(40))) for i in range(500)]
    rows += [(3, passage), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tags", F.array(F.lit("t"), F.lit(None)))
    found = substring.without_repeats(docs.repartition(6))
    assert found.columns == ["doc_id", "text", "tags", "n_words", "n_removed", "kept"]
    want = Counter(zip([r[0] for r in rows], brute([r[1] for r in rows], 35)))
    assert Counter((r.doc_id, (r.n_words, r.n_removed, r.kept)) for r in found.collect()) == want


def test_rows_apart_in_where_their_nulls_are(spark):
    rows = [(1, "a b", "x", None), (1, "a b", None, "x"), (1, "a b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert substring.distinct_rows(docs).count() == 3


def test_windows_are_named_by_their_words():
    names = substring.Words(pa.array([" ".join(random.Random(1).choices("abc", k=3000))])).hashes(0)
    for window in (1, 2, 5, 32, 35):
        at = np.arange(len(names) - window + 1)
        found = substring.window_names(names.copy(), at, window).tolist()
        sequences = [tuple(names[i : i + window].tolist()) for i in at]
        assert len(set(zip(found, sequences))) == len(set(found)) == len(set(sequences))
