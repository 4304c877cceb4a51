import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("kgloom.llm")

from kgloom.llm import merkle  # noqa: E402
from kgloom.llm.merkle import LEAF_COLUMNS, folded, manifest, op11_merkle_manifest, proof_digest  # noqa: E402


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, columns):
    cells = ["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns]
    return sha("".join(cells))


def climb(level, fanout):
    """(root, siblings of each place by level) of a list of digests."""
    paths = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for place, i in enumerate(at):
            run, own = runs[i // fanout], i % fanout
            paths[place].append(("".join(run[:own]), "".join(run[own + 1 :])))
        at = [i // fanout for i in at]
        level = [sha("".join(r)) for r in runs]
    return level[0], paths


def brute(rows, columns, fanout, order="doc_id"):
    """(order, leaf, subroot, root, path) of each row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r[order] is not None, r[order] or 0, leaf_of(r, columns)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s])], fanout) for s in names}
    if not names:
        return []
    root, tops = climb([trees[s][0] for s in names], fanout)
    out = []
    for s, top in zip(names, tops):
        for (there, value, leaf), path in zip(sorted(groups[s]), trees[s][1]):
            out.append((value if there else None, leaf, trees[s][0], root, tuple(path + top)))
    return out


def found(made):
    rows = made.select("doc_id", "leaf", "subroot", "root", "path").collect()
    return [(r[0], r[1], r[2], r[3], tuple((s["before"], s["after"]) for s in r["path"])) for r in rows]


def key(row):
    return (row[0] is not None, row[0] or 0, row[1:])


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_matches_brute_force(edge_docs, fanout):
    rows = [r.asDict() for r in edge_docs.collect()]
    assert sorted(found(manifest(edge_docs, LEAF_COLUMNS, fanout=fanout)), key=key) == sorted(brute(rows, LEAF_COLUMNS, fanout), key=key)


def test_several_blocks_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 9)
    rows = [{"doc_id": i * 7 % 331, "source": "hot" if i % 3 else f"s{i % 40}", "text": f"text {i}"} for i in range(330)]
    rows += [{"doc_id": 5, "source": "hot", "text": "copied"}] * 120
    docs = spark.createDataFrame([(r["doc_id"], r["source"], r["text"]) for r in rows], "doc_id long, source string, text string")
    columns = ["doc_id", "source", "text"]
    assert sorted(found(manifest(docs, columns)), key=key) == sorted(brute(rows, columns, 3), key=key)


def test_a_row_alone_and_an_empty_table(spark, no_docs):
    one = spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string")
    row = manifest(one, ["text"]).first()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:x") and row["path"] == []
    assert manifest(no_docs, LEAF_COLUMNS).count() == 0


def test_other_columns_do_not_matter(edge_docs, clashing_docs):
    names = ["tree", "name", "at", "size", "digest", "path", "block", "leaf", "root", "subroot", "group", "group_size"]
    odd = clashing_docs.withColumns({c: F.lit("theirs") for c in names})
    assert sorted(found(manifest(odd, LEAF_COLUMNS)), key=key) == sorted(found(manifest(edge_docs, LEAF_COLUMNS)), key=key)


def test_proofs_tell_changed_rows(spark, edge_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r.asDict() for r in edge_docs.collect()]
    by_leaf = {r[1]: r for r in brute(rows, LEAF_COLUMNS, 3)}
    result = op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(result) == len(rows)
    for r in result:
        want = by_leaf[r["leaf"]]
        assert (r["subroot"], r["root"]) == want[2:4]
        assert r["proof_sha256"] == sha("".join(a + b for a, b in want[4]))
        assert r["verified"] == (r["folded_root"] == r["root"])
        own = [x for x in rows if leaf_of(x, LEAF_COLUMNS) == r["leaf"]][0]
        even = own["doc_id"] is not None and zlib.crc32(str(own["doc_id"]).encode()) % 2 == 0
        assert r["verified"] == (not even or "\n" not in (own["text"] or ""))


def test_folding(spark):
    made = spark.createDataFrame([("x", [("a", "b"), ("", "c")])], f"leaf string, path {merkle.PATH}")
    row = made.select(folded(F.col("leaf"), F.col("path")).alias("root"), proof_digest(F.col("path")).alias("proof")).first()
    assert row["root"] == sha(sha("axb") + "c") and row["proof"] == sha("abc")


def test_one_shuffle_serves_the_levels_of_a_block(spark):
    """All levels of a block share the exchange by block and its sort."""
    nodes = spark.range(300).select(
        (F.col("id") % 2).cast("string").alias("tree"), F.lit("t").alias("name"), F.col("id").alias("at"),
        F.lit(300).cast("long").alias("size"), F.sha2(F.col("id").cast("string"), 256).alias("digest"),
    )
    plan = merkle._climbed(nodes, 3, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == 5
