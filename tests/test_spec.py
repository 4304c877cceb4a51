import json

import pytest

from kgloom import plans, sinks, sources


def graph(spark):
    nodes = spark.createDataFrame(
        [("A:1", "c1", 2.0, None, "h"), ("B:2", "it's", 10.5, None, "h"), ("B:3", "c1", 2.0, None, "h"), ("Z:9", "far", 1.0, "n", "h")],
        "id string, category string, score double, note string, _hidden string",
    )
    edges = spark.createDataFrame(
        [("A:1", "p", "B:2", "given", None), ("A:1", "q", "B:3", "given", None), ("Z:9", "p", "A:1", "given", None)],
        "subject string, predicate string, object string, agent_type string, weight double",
    )
    return nodes, edges


LINES = """nodes:
  columns:
    id:
      type: generate_unique_id
      prefixes:
      - A
      - B
    category:
      type: generate_values
      sample_values:
      - c1
      - 'it''s'
    score:
      type: generate_values
      sample_values:
      - 2.0
      - 10.5
    note:
      type: generate_values
      sample_values:
      - ''
  num_rows: 7
edges:
  columns:
    subject:
      type: copy_column
      source_column: nodes.id
      seed: 590590
      sample:
        num_rows: '@edges.num_rows'
    predicate:
      type: generate_values
      sample_values:
      - p
      - q
    object:
      type: copy_column
      source_column: nodes.id
      seed: 590590
      sample:
        num_rows: '@edges.num_rows'
    agent_type:
      type: generate_values
      sample_values:
      - manual_agent
      - automated_agent
      - data_analysis_pipeline
      - computational_model
      - text_mining_agent
      - image_processing_agent
      - manual_validation_of_automated_agent
      - not_provided
    weight:
      type: generate_values
      sample_values: []
  num_rows: 7
"""


def test_lines(spark):
    # 1.5 edges: two
    spec = plans.generation_spec(*graph(spark), limit=3, rows=7, order_by=["subject", "predicate"])
    assert "\n".join(r.line for r in plans.spec_lines(spec).collect()) + "\n" == LINES


def test_vocabulary_override(spark, rows):
    spec = plans.generation_spec(*graph(spark), vocabularies={"agent_type": ["x"]})
    assert rows(spec.where("name = 'agent_type'"), "value") == [("x",)]


def test_id_without_colon_fails(spark):
    nodes = spark.createDataFrame([("A1",)], "id string")
    edges = spark.createDataFrame([("A1", "p", "A1")], "subject string, predicate string, object string")
    with pytest.raises(Exception, match="without a colon"):
        plans.generation_spec(nodes, edges).collect()


def test_snapshot(spark, tmp_path, rows):
    nodes, edges = graph(spark)
    found = plans.schema_snapshot(nodes, edges, nodes_exclude=["_", "no"], edges_exclude=["agent"], seed=5)
    assert rows(found.orderBy("table_name", "ordinal"), "table_name", "name", "datatype") == sorted(
        [("nodes", "id", "str"), ("nodes", "category", "str"), ("nodes", "score", "f64")]
        + [("edges", c, "str") for c in ("subject", "predicate", "object")]
        + [("edges", "weight", "f64")]
    )
    samples = {(r.table_name, r.name): r.samples for r in found.collect()}
    assert samples["edges", "weight"] == []
    assert 1 <= len(samples["nodes", "id"]) <= 6 and set(samples["nodes", "id"]) <= {"A:1", "B:2", "B:3", "Z:9"}
    assert all(a != b for s in samples.values() for a, b in zip(s, s[1:]))
    assert rows(found) == rows(plans.schema_snapshot(nodes, edges, ["_", "no"], ["agent"], seed=5))

    document = plans.snapshot_document(found)
    read = json.loads(document.first().json)
    assert [c["name"] for c in read["nodes"]] == ["id", "category", "score"]
    sinks.write_lines(document, str(tmp_path / "s"))
    back = sources.read_snapshot(spark, str(tmp_path / "s"))
    assert rows(back, "table_name", "ordinal", "name", "datatype", "samples") == rows(
        found, "table_name", "ordinal", "name", "datatype", "samples"
    )
    spec = plans.generation_spec(nodes, edges, snapshot=back)
    assert {(r.table_name, r.name) for r in spec.where("name is not null").collect()} == set(samples)


def test_whole_table_values(spark, rows):
    nodes, _ = graph(spark)
    found = plans.table_spec(nodes, "nodes", 1)
    assert rows(found.where("name = 'score'"), "number", "value") == [(1.0, "1.0"), (10.5, "10.5"), (2.0, "2.0")]
    assert rows(found.where("name = 'id'"), "value") == [("A",), ("B",), ("Z",)]


def test_snapshot_of_empty_tables(spark, rows):
    nodes, edges = graph(spark)
    found = plans.schema_snapshot(nodes.where("id = ''"), edges.where("subject = ''"))
    assert rows(found, "name", "samples")[:2] == [("_hidden", []), ("agent_type", [])]
    assert found.count() == 10
