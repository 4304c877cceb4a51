"""Ids, decoding and packing against the tokenizers library."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")

from kgloom.llm import bpe, packing  # noqa: E402

PATH = bpe.public_path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text("ab '\n<|endoftx>sé1"))
def test_any_text(text):
    known = bpe.vocabulary(PATH)
    ids = np.frombuffer(known.encode(text), "<u4").tolist()
    assert ids == ids_of(text)
    assert known.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_long_words_merge_alike():
    known = bpe.vocabulary(PATH)
    for word in (b"a" * 300, b"xyzzy" * 90, bytes(range(256)) * 2, "日本語".encode() * 60, b"ab", b"q"):
        assert bpe.merge_long_word(word, known) == bpe.merge_word(word, known)


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    known = bpe.Vocabulary(PATH)
    for i in range(50):
        assert np.frombuffer(known.encode(f"w{i} x y z"), "<u4").tolist() == ids_of(f"w{i} x y z")
    assert len(known.kept) < 12


def test_round_trip(spark, edge_docs, clashing_docs, no_docs):
    rows = edge_docs.collect()
    want = Counter((r.doc_id, tuple(ids_of(r.text)), r.text or "") for r in rows)
    for docs in (edge_docs, clashing_docs):
        found = bpe.decode(bpe.encode(docs, PATH), PATH)
        assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found.collect()) == want
        assert set(docs.columns) <= set(found.columns)
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


def test_query(spark, edge_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = Counter(tuple(r) for r in bpe.op8_bpe_round_trip(spark, str(tmp_path)).collect())
    rows = [(r.doc_id, ids_of(r.text), r.text or "") for r in edge_docs.collect()]
    assert got == Counter((i, len(x), digest(",".join(map(str, x))), digest(t)) for i, x, t in rows)


@pytest.mark.parametrize("length", [16, 2048])
def test_packing(spark, edge_docs, clashing_docs, length):
    for docs in (edge_docs.repartition(3), clashing_docs):
        pieces = packing.pack(docs, PATH, length).collect()
        sequences = {}
        for p in pieces:
            sequences.setdefault(p.sequence_id, []).append(p)
        assert sorted(sequences) == list(range(len(sequences)))
        for s, parts in sequences.items():
            at = 0
            for p in sorted(parts, key=lambda p: p.offset):
                assert p.offset == at and p.length > 0 and len(p.ids) == 4 * p.length
                at += p.length
            assert at == length or (s == len(sequences) - 1 and at < length)
        # the pieces of a document, put together, are its ids; equal rows count as often as they occur
        whole = Counter()
        runs = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
        ids = []
        for p in runs:
            assert p.start == len(ids) and p.cut_before == (p.start > 0)
            ids += np.frombuffer(p.ids, "<u4").tolist()
            assert p.cut_after == (len(ids) < p.doc_tokens)
            if len(ids) == p.doc_tokens:
                whole[p.doc_id, tuple(ids)] += 1
                ids = []
        assert whole == Counter((r.doc_id, (*ids_of(r.text), 1)) for r in edge_docs.collect())


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_packing_long_runs_of_blanks(spark, blank):
    text = "a" + blank * 1_200_000 + "<|endoftext|> b"
    pieces = packing.pack(spark.createDataFrame([(1, text), (2, "one two")], "doc_id long, text string"), PATH).collect()
    found = {1: b"", 2: b""}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        found[p.doc_id] += bytes(p.ids)
    assert np.frombuffer(found[1], "<u4").tolist() == [*ids_of(text), 1]
    assert np.frombuffer(found[2], "<u4").tolist() == [*ids_of("one two"), 1]


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_digests(spark, edge_docs):
    pieces = packing.pack(edge_docs, PATH)
    assert all(zlib.crc32(r.ids) == c for r, c in zip(pieces.orderBy("sequence_id", "offset").collect(), [x.ids_crc32 for x in packing.digests(pieces).orderBy("sequence_id", "offset").collect()]))
