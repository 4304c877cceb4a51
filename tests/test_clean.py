from pyspark.sql import functions as F

from kgloom import operators as ops
from kgloom import plans


def raw(spark):
    nodes = spark.createDataFrame(
        [
            ("1", "Anatomy", "U:1", "one"),
            ("2", "Anatomy", "U:1", "second of U:1"),
            ("3", "Anatomy", "U:2", "null record"),
            ("4", "Anatomy", "U:3", "absent"),
            ("5", "Gene", "G:1", "gene"),
            ("6", "Cytoband", "C:1", "no ancestors"),
        ],
        "id string, category string, identifier string, name string",
    )
    normalization = spark.createDataFrame(
        [("U:1", ["t1", "t2"]), ("U:2", None), ("U:1", ["t1", "t2"])], "identifier string, types array<string>"
    )
    ancestors = spark.createDataFrame(
        [("biolink:GrossAnatomicalStructure", ["a", "b"]), ("biolink:Gene", ["g"]), ("biolink:Gene", ["g"])],
        "term string, ancestors array<string>",
    )
    return nodes, normalization, ancestors


def test_nodes(spark, rows):
    done = plans.normalize_nodes(*raw(spark))
    assert done.columns == ["id", "category", "name"]
    assert rows(done) == [
        ("C:1", None, "no ancestors"),
        ("G:1", "g", "gene"),
        ("U:1", "t1\x1ft2", "one"),
        ("U:2", "a\x1fb", "null record"),
        ("U:3", "a\x1fb", "absent"),
    ]


def test_first_row_follows_the_given_order(spark, rows):
    done = plans.normalize_nodes(*raw(spark), order_by=[F.desc("id")])
    assert ("U:1", "t1\x1ft2", "second of U:1") in rows(done)


def test_ancestors_of_seeds(spark, rows):
    _, _, ancestors = raw(spark)
    assert rows(plans.category_ancestors(spark, ancestors)) == [("Anatomy", ["a", "b"]), ("Gene", ["g"])]


def test_largest_identifier_wins(spark, rows):
    nodes = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c"), (None, "d")], "id string, identifier string")
    mapping = ops.id_map(nodes)
    assert rows(mapping) == [("1", "b"), ("2", "c")]
    edges = spark.createDataFrame([("1", "p", "2", "x"), ("9", "biolink:p", "1", "y"), (None, None, "1", "z")], "subject string, predicate string, object string, w string")
    assert rows(ops.rewrite_endpoints(edges, mapping)) == [
        (None, None, "1", "z"), ("9", "biolink:p", "1", "y"), ("b", "p", "2", "x"),
    ]
    assert rows(ops.rewrite_endpoints(edges, mapping, ("subject", "object"), prefix_predicate=True)) == [
        (None, None, "b", "z"), ("9", "biolink:p", "b", "y"), ("b", "biolink:p", "c", "x"),
    ]


def test_edges_are_rewritten_by_the_categories_of_their_file(spark, rows):
    nodes = spark.createDataFrame(
        [("1", "B", "b:1"), ("1", "A", "a:1"), ("1", "A", "a:0"), ("2", "C", "c:2")],
        "id string, category string, identifier string",
    )
    info = spark.createDataFrame(
        [("A", "r", "B", "f1"), ("B", "r", "X", "f2"), ("X", "r", "Y", "f3"), ("X", "r", "C", "f1")],
        "subject string, predicate string, object string, file string",
    )
    edges = spark.createDataFrame(
        [(s, "o", "p", f) for s in ("1", "2") for f in ("f1", "f2", "f3", "f4")],
        "subject string, object string, predicate string, file string",
    )
    done = plans.rewrite_raw_edges(edges, nodes, info)
    assert done.columns == edges.columns
    assert rows(done, "file", "subject") == [
        ("f1", "a:1"), ("f1", "c:2"), ("f2", "2"), ("f2", "b:1"), ("f3", "1"), ("f3", "2"), ("f4", "1"), ("f4", "2"),
    ]
    assert rows(plans.rewrite_raw_edges(edges.drop("file"), nodes), "subject") == [("b:1",)] * 4 + [("c:2",)] * 4
    assert rows(plans.category_edge_files(info)) == [
        ("A", "f1"), ("B", "f1"), ("B", "f2"), ("C", "f1"), ("X", "f1"), ("X", "f2"), ("X", "f3"), ("Y", "f3"),
    ]


def test_whole_graph_sorts_edges(spark):
    nodes, normalization, ancestors = raw(spark)
    edges = spark.createDataFrame([("5", "x", "p"), ("1", "z", "p"), ("1", "y", "p")], "subject string, object string, predicate string")
    _, done = plans.clean_graph(nodes, edges, normalization, ancestors)
    assert [tuple(r) for r in done.collect()] == [("G:1", "x", "p"), ("U:1", "y", "p"), ("U:1", "z", "p")]


def test_no_empty(spark):
    df = spark.createDataFrame([("a",), ("",)], "identifier string")
    assert df.agg(plans.no_empty(F.col("identifier"))).first()[0] is False
    assert df.where("identifier <> ''").agg(plans.no_empty(F.col("identifier"))).first()[0] is True


def test_nodes_without_identifier_stay(spark):
    nodes = spark.createDataFrame(
        [("1", "Gene", None), ("2", "Gene", None), ("3", "Gene", ""), ("4", "Gene", "X:1"), ("5", "Gene", "X:1")],
        "id string, category string, identifier string",
    )
    found = spark.createDataFrame([], "identifier string, types array<string>")
    terms = spark.createDataFrame([], "term string, ancestors array<string>")
    assert sorted((r.id is None, r.id or "") for r in plans.normalize_nodes(nodes, found, terms).collect()) == [
        (False, ""), (False, "X:1"), (True, ""), (True, ""),
    ]


def test_numeric_endpoints(spark):
    edges = spark.createDataFrame([(1, "p", 2)], "subject long, predicate string, object long")
    mapping = spark.createDataFrame([(1, "I:1")], "id long, identifier string")
    assert tuple(ops.rewrite_endpoints(edges, mapping, ("subject", "object")).first()) == ("I:1", "p", "2")


def test_both_ends_at_once(spark, rows):
    mapping = spark.createDataFrame([("a", "A"), ("b", None), ("", "E")], "id string, identifier string")
    data = [("a", "p", "a"), ("a", "p", "b"), ("b", "q", "a"), (None, "p", "a"), ("x,y", "p", '"'), ("", "p", None), ("a", "p", "a")]
    edges = spark.createDataFrame(data, "subject string, predicate string, object string")
    known = {"a": "A", "": "E"}
    want = [(known.get(s, s), p, known.get(o, o)) for s, p, o in data]
    got = ops.rewrite_endpoints(edges, mapping, ("subject", "object"))
    assert rows(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
