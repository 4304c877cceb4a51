import datetime
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("kgloom.llm")

from kgloom.llm import sharding  # noqa: E402
from kgloom.llm.sharding import op13_kd_tree_shards, shard  # noqa: E402

WIDE = 1 << 52


def number(value, digits):
    return 0 if value is None else int(hashlib.md5(str(value).encode()).hexdigest()[:digits], 16)


def scaled(rows, name):
    values = [float(r[name]) for r in rows if r[name] is not None]
    low, high = (min(values), max(values)) if values else (0, 0)
    return [int((r[name] - low) / (high - low) * WIDE // 1) if r[name] is not None and low < high else 0 for r in rows]


def brute(rows, shards):
    """Shard of each row, by sorting."""
    size = [len((r["text"] or "").encode()) + 16 for r in rows]
    points = list(zip(
        [number(r["source"], 13) for r in rows], [number(r["lang"], 13) for r in rows], scaled(rows, "n_chars"), scaled(rows, "doc_id")
    ))
    ties = [(number(r["text"] or "", 15), number(r["doc_id"], 15)) for r in rows]
    out = [0] * len(rows)

    def cut(own, first, parts):
        if parts == 1 or not own:
            for i in own:
                out[i] = first
            return
        width = [max(points[i][d] for i in own) - min(points[i][d] for i in own) for d in range(4)]
        d = width.index(max(width))
        own = sorted(own, key=lambda i: (points[i][d], ties[i], i))
        total, before, left = sum(size[i] for i in own), 0, parts // 2
        sides = [], []
        for i in own:
            sides[(2 * before + size[i]) * parts > 2 * total * left].append(i)
            before += size[i]
        cut(sides[0], first, left)
        cut(sides[1], first + left, parts - left)

    cut(list(range(len(rows))), 0, shards)
    return out


def check(rows, result, shards):
    want = brute(rows, shards)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"], r["shard"]) for r in result)
    assert got == sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()), s)
        for r, s in zip(rows, want)
    )
    for s in set(want):
        own = sorted((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0) for r in result if r["shard"] == s)
        assert [x[0] for x in own] == list(range(len(own)))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)


@pytest.mark.parametrize("shards", [1, 3, 7, 40])
def test_shards_match_brute_force(edge_docs, shards):
    rows = [r.asDict() for r in edge_docs.collect()]
    check(rows, shard(edge_docs, shards=shards).collect(), shards)


def test_hot_places_are_cut(spark, prose, monkeypatch):
    """A third of all rows are copies, another third share their metadata."""
    monkeypatch.setattr(sharding, "LEVEL_BINS", 8)
    rows = [(i, prose(i, 3 + i % 50), "en", f"s{i % 5}", i % 50) for i in range(100)]
    rows += [(1000, "the same text again", "en", "hot", 5)] * 100
    rows += [(2000 + i, prose(i, 9), "en", "hot", 9) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    dicts = [dict(zip(docs.columns, r)) for r in rows]
    result = shard(docs, shards=6).collect()
    # copies are alike; any of them may be in either shard that they are cut between
    check(dicts, result, 6)
    loads = [sum(r["size"] for r in result if r["shard"] == s) for s in range(6)]
    assert max(loads) - min(loads) <= 2 * max(r["size"] for r in result)


def test_target_bytes_other_dimensions_and_empty_tables(spark, no_docs):
    day = datetime.date(2024, 1, 1)
    docs = spark.createDataFrame(
        [(i, "x" * 84, day + datetime.timedelta(days=i), float("nan") if i % 2 else i / 3) for i in range(20)],
        "doc_id long, text string, day date, score double",
    )
    result = shard(docs, ("day", "score"), target_bytes=500).collect()
    assert sorted(r["shard"] for r in result) == [s for s in range(4) for _ in range(5)]
    assert shard(no_docs, shards=5).count() == 0 and shard(no_docs, target_bytes=5).count() == 0
    with pytest.raises(ValueError):
        shard(docs, shards=2, target_bytes=5)


def test_other_columns_do_not_matter(edge_docs, clashing_docs):
    odd = clashing_docs.withColumns({c: F.lit("theirs") for c in ["size", "shard", "slot", "at", "group_size", "text_crc32"]})
    same = lambda d: sorted(map(str, shard(d, shards=4).collect()))
    assert same(odd) == same(edge_docs)


def test_query_columns(spark, edge_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    result = op13_kd_tree_shards(spark, str(tmp_path)).collect()
    assert len(result) == edge_docs.count()
    assert {r["law"] for r in result} == {"bytes"} and {r["grown_shard"] for r in result} == {None}
    assert all(0 <= r["shard"] < 40 for r in result)
