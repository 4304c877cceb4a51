"""What the physical plans must and must not contain."""

import re
from pathlib import Path

import pytest

from kgloom import operators as ops
from kgloom import plans
from kgloom.registry import JOBS, ORACLES

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are missing")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    def store(name, schema):
        path = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(path)
        return spark.read.parquet(path)

    return store


EDGE = "subject string, predicate string, object string"


@needs_data
@pytest.mark.parametrize("name", sorted(set(JOBS) & set(ORACLES)))
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(JOBS[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|Arrow", text)
    assert "CartesianProduct" not in text


def test_one_exchange_builds_edges(stored):
    kg = stored("kg", "relation string, display_relation string, x_id string, x_source string, y_id string, y_source string")
    text = plan(plans.build_edges(kg))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "SortAggregate" not in text and "Sort " not in text
    assert len(re.findall(r"FileScan", text)) == 1


def test_one_exchange_checks_endpoints(stored):
    text = plan(ops.endpoint_check(stored("n", "id string, name string"), stored("e", EDGE)))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "Join" not in text
    assert "ReadSchema: struct<id:string>" in text


def test_keep_first_is_limited_before_the_shuffle(stored):
    text = plan(ops.keep_first(stored("n", "id string, o int"), ["id"], ["o"]))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_head_and_tail_are_limited_before_the_shuffle(stored):
    text = plan(plans.superfluous_value_counts(stored("n", "id string, _a string, _b string")))
    assert len(re.findall(r"WindowGroupLimit.*Partial", text)) == 2
    assert "ReadSchema: struct<_a:string,_b:string>" in text


def test_unique_merge_shuffles_once(stored):
    parts = [stored(f"m{i}", EDGE + ", source string") for i in range(4)]
    text = plan(plans.merge_edges(parts, unique_keys=True))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "Join" not in text


def test_merge_shuffles_and_reads_every_table_once(stored):
    parts = [stored(f"m{i}", EDGE + ", source string") for i in range(4)]
    text = plan(plans.merge_edges(parts))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"FileScan", text)) == 4


def test_snapshot_makes_few_cells_distinct(stored):
    text = plan(plans.schema_snapshot(stored("n", "id string, name string"), stored("e", EDGE)))
    # bounds are joined before cells are made distinct
    assert len(re.findall(r"BroadcastHashJoin .*ordinal", text)) >= 2


def test_patterns_are_hash_joined(stored):
    nodes, edges = stored("n", "id string"), stored("e", EDGE)
    sampled_nodes, _ = plans.sample_subgraph(nodes, edges, size=5_000, materialize=False)
    assert "NestedLoop" not in plan(sampled_nodes)


def test_rewriting_keeps_edges_on_the_splittable_side(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ops.rewrite_endpoints(stored("e", EDGE), ops.id_map(stored("n", "id string, identifier string"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin .*LeftOuter", text)
