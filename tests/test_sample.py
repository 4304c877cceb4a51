import random

import pytest

from kgloom import operators as ops
from kgloom import plans, sinks


def some_graph(spark, seed=0):
    rng = random.Random(seed)
    ids = [f"{p}:{n}" for p in ("A", "NCBIGene", "MONDO") for n in range(60)]
    edges = [(rng.choice(ids), "p", rng.choice(ids)) for _ in range(150)]
    nodes = [(i, i.lower()) for i in ids] + [("x-NCBIGene:1-y", "long"), ("A:1", "again")]
    return nodes, edges


def frames(spark, nodes, edges):
    return (
        spark.createDataFrame(nodes, "id string, name string"),
        spark.createDataFrame(edges, "subject string, predicate string, object string"),
    )


def brute(nodes, edges, size, match):
    same = (lambda text, part: part in text) if match == "substring" else (lambda text, part: text == part)
    chosen = sorted({e for s, _, o in edges for e in (s, o)})[:size]
    picked = [e for e in edges if any(same(e[0], c) or same(e[2], c) for c in chosen)]
    ends = {e for s, _, o in picked for e in (s, o)}
    return [n for n in nodes if any(same(n[0], e) for e in ends)], picked


@pytest.mark.parametrize("match", ["substring", "exact"])
@pytest.mark.parametrize("materialize", [False, True])
def test_sample_equals_brute_force(spark, rows, match, materialize):
    nodes, edges = some_graph(spark)
    want_nodes, want_edges = brute(nodes, edges, 7, match)
    got_nodes, got_edges = plans.sample_subgraph(*frames(spark, nodes, edges), size=7, match=match, materialize=materialize)
    assert rows(got_edges) == sorted(want_edges)
    assert rows(got_nodes) == sorted(want_nodes)


def test_substring_selects_longer_ids(spark, rows):
    edges = spark.createDataFrame([("NCBIGene:1", "p", "B:1"), ("NCBIGene:12", "p", "C:1")], "subject string, predicate string, object string")
    ids = spark.createDataFrame([("NCBIGene:1",)], "id string")
    longer = ops.ids_containing(ops.endpoint_ids(edges), ids)
    assert ops.rows_with_either_id(edges, longer).count() == 2
    assert ops.rows_with_either_id(edges, ids).count() == 1


def test_ids_containing_edge_cases(spark, rows):
    ids = spark.createDataFrame([("abc",), ("xabcx",), ("ab",), ("é:ü1",), (None,), ("",)], "id string")

    def found(*patterns):
        return rows(ops.ids_containing(ids, spark.createDataFrame([(p,) for p in patterns], "id string")))

    assert found("abc") == [("abc",), ("xabcx",)]
    assert found("a.c", None) == []
    assert found("ü") == [("é:ü1",)]
    assert found("") == [("",), ("ab",), ("abc",), ("xabcx",), ("é:ü1",)]
    assert found() == []
    assert found("bcx", "xabcx", "zz") == [("xabcx",)]


def test_bare_numbers_as_patterns(spark, rows):
    rng = random.Random(2)
    ids = [f"P{rng.randrange(10**9)}:{rng.randrange(10**6)}" for _ in range(200)]
    patterns = [str(rng.randrange(10 ** rng.randint(1, 6))) for _ in range(60)]
    got = ops.ids_containing(*(spark.createDataFrame([(x,) for x in xs], "id string") for xs in (ids, patterns)))
    assert rows(got) == sorted({(i,) for i in ids if any(p in i for p in patterns)})


def test_random_sample_is_a_subset(spark, rows):
    nodes, edges = some_graph(spark)
    got_nodes, got_edges = plans.sample_subgraph(*frames(spark, nodes, edges), size=5, random=True, seed=3, match="exact")
    assert set(rows(got_edges)) <= set(edges) and set(rows(got_nodes)) <= set(nodes)
    ends = {e for s, _, o in rows(got_edges) for e in (s, o)}
    assert {n for n, _ in rows(got_nodes)} == ends & {n for n, _ in nodes}


def test_draws(spark):
    ids = spark.createDataFrame([(f"i{n}",) for n in range(8)], "id string")
    seen = {}
    for seed in range(12):
        drawn = plans.draw_ids(spark, ids, 6, seed).collect()
        assert sum(r.times for r in drawn) == 6
        assert len({r.id for r in drawn}) == len(drawn)
        for r in drawn:
            seen[r.id] = seen.get(r.id, 0) + r.times
    assert len(seen) == 8
    again = plans.draw_ids(spark, ids, 6, 4).collect()
    assert sorted(again) == sorted(plans.draw_ids(spark, ids, 6, 4).collect())
    # more draws than ids: all can be drawn, none twice as a row
    many = plans.draw_ids(spark, ids, 200, 1).collect()
    assert sum(r.times for r in many) == 200 and len(many) == 8


def test_first_ids(spark):
    ids = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "id string")
    assert [r.id for r in plans.first_ids(ids, 2).collect()] == ["a", "b"]


def test_names():
    assert sinks.sample_file_names("kg.nodes.tsv", 5) == ("kg.nodes_5.tsv", "kg.edges_5.tsv")
    with pytest.raises(ValueError):
        sinks.sample_file_names("kg.tsv", 5)


def test_first_ids_are_taken_from_several_ranges(spark):
    ids = spark.range(5000, numPartitions=7).selectExpr("concat('i', lpad(id % 1700, 5, '0')) id").unionAll(spark.createDataFrame([(None,)] * 3, "id string"))
    want = sorted(f"i{i % 1700:05}" for i in range(5000))
    for size in (0, 1, 777, 4999, 5000):
        assert sorted(r.id for r in plans.first_ids(ids, size).collect()) == want[:size]
    assert plans.first_ids(ids, 6000).count() == 5003


def test_previous_rows(spark, rows):
    import collections

    data = [("hot", f"x{i % 300:04}") for i in range(900)] + [("a", "1"), ("a", None), (None, "n"), (None, "m"), ("b", "2")]
    df = spark.createDataFrame(data, "category string, id string").repartition(5)
    got = collections.Counter((r.category, r.id, r.before) for r in ops.with_previous(df, "category", "id").collect())
    want = collections.Counter()
    for c in {d[0] for d in data}:
        own = sorted((d[1] for d in data if d[0] == c), key=lambda v: (v is not None, v))
        want.update((c, v, p) for v, p in zip(own, [None, *own]))
    assert got == want
