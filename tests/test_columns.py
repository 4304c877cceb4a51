import pytest

from kgloom import operators as ops
from kgloom import sources
from kgloom.functions import vocab


def frame(spark, names, *data):
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(list(data), schema)


def test_nodes_header(spark):
    df = frame(spark, ["id:ID", ":LABEL", "name:string", "foo:int", ":X"])
    assert ops.clean_nodes_header(df).columns == ["id", "__label", "name", "_foo", "_"]


def test_edges_header(spark):
    df = frame(spark, ["subject", "publications:string[]", "foo", "object:END"])
    assert ops.clean_edges_header(df).columns == ["subject", "publications", "_foo", "object"]


@pytest.mark.parametrize("clean", [ops.clean_nodes_header, ops.clean_edges_header])
def test_header_collision(spark, clean):
    with pytest.raises(ValueError, match="repeats"):
        clean(frame(spark, ["foo:int", "foo:string"]))


def test_edge_columns_completed(spark, rows):
    df = frame(spark, ["subject", "knowledge_level"], ("a", None), ("b", ""), ("c", "k"))
    done = ops.add_edge_columns(df, "infores:x")
    assert done.columns == ["subject", "knowledge_level", *vocab.ENSURED_EDGE_COLUMNS[1:]]
    assert rows(done, "subject", "knowledge_level", "agent_type", "primary_knowledge_source", "publications") == [
        ("a", "knowledge_assertion", "data_analysis_pipeline", "infores:x", None),
        ("b", "", "data_analysis_pipeline", "infores:x", None),
        ("c", "k", "data_analysis_pipeline", "infores:x", None),
    ]


def test_coalesce_columns(spark, rows):
    df = frame(spark, ["a", "a_right", "b"], (None, "x", "1"), ("y", "x", "2"))
    done = ops.coalesce_columns(df, ["a", "b", "none"])
    assert done.columns == ["a", "b"]
    assert rows(done) == [("x", "1"), ("y", "2")]


def test_select_by_prefix(spark):
    df = frame(spark, ["id", "_a", "_b", "x.y", "xz"])
    assert ops.select_by_prefix(df, include="_", ignore=["_b"]).columns == ["_a"]
    assert ops.select_by_prefix(df, exclude=["_", "x."]).columns == ["id", "xz"]
    assert ops.select_by_prefix(df).columns == df.columns


def test_fix_delimiter(spark, rows):
    df = frame(spark, ["id", "l"], ("1", "a\x1fb"), ("2", "a,b"), ("3", None))
    assert rows(ops.fix_delimiter(df, "l")) == [("1", "a|b"), ("2", "a,b"), ("3", None)]


def test_labels(spark, rows):
    names = ["id:ID", "CHEBI_ROLE_a:boolean", "name", "CHEBI_ROLE_b c:boolean", "CHEBI_ROLE_none", "MONDO_SUPERCLASS_x:y:z"]
    df = frame(
        spark,
        names,
        ("1", "true", "n", "true", "true", "true"),
        ("2", "True", "n", "1", "true", ""),
        ("3", None, "n", "true", "true", "false"),
    )
    done = ops.bool_columns_to_labels(df)
    assert done.columns == ["id", "name", "CHEBI_ROLE", "MONDO_SUPERCLASS"]
    assert rows(done) == [("1", "n", "a|b c", "x"), ("2", "n", "", ""), ("3", "n", "b c", "")]


def test_labels_of_a_very_wide_table(spark, rows):
    names = ["id"] + [f"CHEBI_ROLE_{i}:boolean" for i in range(3000)]
    data = [("a", *["true" if i % 1000 == 7 else "false" for i in range(3000)])]
    done = ops.bool_columns_to_labels(frame(spark, names, *data))
    assert rows(done) == [("a", "7|1007|2007", "")]


def test_labels_of_lines(spark, tmp_path, rows):
    names = [f"CHEBI_ROLE_{i}:boolean" for i in range(5000)] + ["id:ID", "MONDO_SUPERCLASS_:x", "CHEBI_ROLE_none"]
    cells = ["true" if i % 1000 == 7 else "false" for i in range(5000)] + ['"a', "true", "true"]
    path = tmp_path / "wide.tsv"
    path.write_text("\t".join(names) + "\n" + "\t".join(cells) + "\nfalse\n")
    done = ops.line_labels(*reversed(sources.read_line_fields(spark, str(path))))
    assert done.columns == ["id", "CHEBI_ROLE", "MONDO_SUPERCLASS"]
    assert rows(done) == [(None, "", ""), ('"a', "7|1007|2007|3007|4007", "")]


def test_labels_without_members(spark, rows):
    assert rows(ops.bool_columns_to_labels(frame(spark, ["id"], ("1",)))) == [("1", "", "")]
