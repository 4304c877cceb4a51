from kgloom import operators as ops


def graph(spark):
    nodes = spark.createDataFrame([("A.1",), ("AX1",), ("B",), (None,), ("B",)], "id string")
    edges = spark.createDataFrame(
        [("A.1", "p", "B"), ("C", "p", "A.1"), (None, "p", "B")], "subject string, predicate string, object string"
    )
    return nodes, edges


def test_endpoint_ids(spark, rows):
    _, edges = graph(spark)
    assert rows(ops.endpoint_ids(edges)) == [(None,), ("A.1",), ("B",), ("C",)]
    assert ops.endpoint_ids(edges, distinct=False).count() == 6


def test_check_names_both_sides(spark, rows):
    nodes, edges = graph(spark)
    assert rows(ops.endpoint_check(nodes, edges)) == [("edges", "C"), ("nodes", "AX1")]


def test_check_is_empty_once_nodes_are_added(spark):
    nodes, edges = graph(spark)
    check = ops.endpoint_check(nodes, edges)
    full = nodes.unionAll(check.where("side = 'edges'").select("id")).where("id <> 'AX1'")
    assert ops.endpoint_check(full, edges).count() == 0


def test_check_compares_numbers_as_text(spark, rows):
    nodes = spark.createDataFrame([(1,), (2,)], "id bigint")
    edges = spark.createDataFrame([("1", "3")], "subject string, object string")
    assert rows(ops.endpoint_check(nodes, edges)) == [("edges", "3"), ("nodes", "2")]


def test_rows_with_id_is_exact(spark, rows):
    nodes, _ = graph(spark)
    ids = spark.createDataFrame([("A.1",), ("A.1",), (None,)], "id string")
    assert rows(ops.rows_with_id(nodes, ids)) == [("A.1",)]


def test_rows_with_either_id(spark, rows):
    _, edges = graph(spark)
    ids = spark.createDataFrame([("B",), ("B",), ("C",), (None,)], "id string")
    assert rows(ops.rows_with_either_id(edges, ids)) == [(None, "p", "B"), ("A.1", "p", "B"), ("C", "p", "A.1")]


def test_keep_first(spark, rows):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 5, "y"), (None, 4, "x")], "k string, o int, v string")
    assert rows(ops.keep_first(df, ["k"], ["o"])) == [(None, 4, "x"), ("k", 1, "a")]
