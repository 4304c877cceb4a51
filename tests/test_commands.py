"""Commands from files to files."""

import json

import pytest

from kgloom import commands, sources


@pytest.fixture
def put(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


@pytest.fixture
def out(tmp_path):
    return lambda name: str(tmp_path / "out" / name)


def read(spark, path, *columns, sep="\t"):
    df = sources.read_delimited(spark, path, sep=sep)
    return sorted(tuple(r) for r in df.select(*columns).na.fill("-").collect())


RELATIONS = (
    "relation,display_relation,x_index,x_id,x_type,x_name,x_source,y_index,y_id,y_type,y_name,y_source",
    'protein_protein,ppi,0,9,gene/protein,"a, b",NCBI,1,8,gene/protein,b,NCBI',
    "disease_phenotype_positive,p,2,5,disease,d,MONDO,3,6,effect/phenotype,e,HPO",
    "disease_phenotype_negative,p,2,5,disease,d,MONDO,3,6,effect/phenotype,e,HPO",
    "indication,i,4,DB1,drug,d,DrugBank,5,1_2,disease,g,MONDO_grouped",
)


def test_build_edges(spark, put, out):
    commands.build_edges(spark, put("kg.csv", *RELATIONS), out("edges"))
    assert read(spark, out("edges"), "subject", "predicate", "object", "negated") == [
        ("DrugBank:DB1", "biolink:treats", "MONDO:0000001", "-"),
        ("DrugBank:DB1", "biolink:treats", "MONDO:0000002", "-"),
        ("MONDO:0000005", "biolink:has_phenotype", "HPO:0000006", "-"),
        ("NCBIGene:9", "biolink:interacts_with", "NCBIGene:8", "-"),
    ]


def test_predicate_mappings(spark, put, out):
    commands.predicate_mappings(spark, put("kg.csv", *RELATIONS), out("report"))
    report = [json.loads(r.value) for r in spark.read.text(out("report")).collect()]
    assert [r["predicate"] for r in report] == [
        "biolink:has_phenotype", "biolink:has_phenotype", "biolink:treats", "biolink:interacts_with",
    ]


def test_build_nodes(spark, put, out):
    nodes = put("n.csv", "node_index,node_id,node_type,node_name,node_source", "0,9,gene/protein,x,NCBI", "1,1_2,disease,y,MONDO_grouped")
    drug = put("d.csv", "node_index,description,category", "7,lost,c")
    disease = put("s.csv", "node_index,mondo_id", "1,1", "1,2")
    commands.build_nodes(spark, nodes, drug, disease, out("nodes"))
    assert read(spark, out("nodes"), "id", "category", "description") == [
        ("-", "-", "lost"), ("MONDO:0000001", "biolink:Disease", "-"),
        ("MONDO:0000002", "biolink:Disease", "-"), ("NCBIGene:9", "biolink:Gene", "-"),
    ]


def test_headers_and_columns(spark, put, out):
    commands.clean_nodes_header(spark, put("n.tsv", "id:ID\t:LABEL\tfoo:int", "1\tL\t2"), out("n"))
    assert read(spark, out("n"), "id", "__label", "_foo") == [("1", "L", "2")]
    edges = put("e.tsv", "subject:START\tobject\tbar", "1\t2\t3")
    commands.clean_edges_header(spark, edges, out("e"))
    assert read(spark, out("e"), "subject", "object", "_bar") == [("1", "2", "3")]
    commands.add_edge_columns(spark, put("a.tsv", "subject\tagent_type", "1\t", "2\tm"), out("a"), "infores:x")
    assert read(spark, out("a"), "subject", "agent_type", "primary_knowledge_source", "publications") == [
        ("1", "data_analysis_pipeline", "infores:x", "-"), ("2", "m", "infores:x", "-"),
    ]
    commands.fix_delimiter(spark, put("l.tsv", "id\tl", "1\ta\x1fb"), out("l"), "l")
    assert read(spark, out("l"), "id", "l") == [("1", "a|b")]


def test_labels(spark, put, out):
    path = put("h.tsv", 'id:ID\tCHEBI_ROLE_a:boolean\tMONDO_SUPERCLASS_b:boolean\tname', '1\ttrue\ttrue\t"x', "2\t\tfalse\ty")
    commands.bool_columns_to_labels(spark, path, out("h"))
    lines = sorted(r.value for r in spark.read.text(out("h")).collect())
    assert lines == ['1\t"x\ta\tb', "2\ty\t\t", "id\tname\tCHEBI_ROLE\tMONDO_SUPERCLASS"]


def graph(put):
    nodes = put("kg.nodes.tsv", "id\tcategory\t_v\tscore", "A:1\tc\tx\t1.5", "A:2\td\tx\t2.5", "B:9\tc\ty\t3.5")
    edges = put("kg.edges.tsv", "subject\tpredicate\tobject", "A:1\tp\tA:2", "A:2\tp\tC:3")
    return nodes, edges


def test_graph_commands(spark, put, out):
    nodes, edges = graph(put)
    assert [tuple(r) for r in commands.endpoint_check(spark, nodes, edges).collect()] == [("edges", "C:3"), ("nodes", "B:9")]
    commands.sample_subgraph(spark, nodes, edges, out("sample"), size=1, match="exact")
    assert read(spark, out("sample/kg.nodes_1.tsv"), "id") == [("A:1",), ("A:2",)]
    assert read(spark, out("sample/kg.edges_1.tsv"), "subject", "object") == [("A:1", "A:2")]
    commands.superfluous_value_counts(spark, nodes, out("counts"))
    assert read(spark, out("counts"), "_v", "_v_counts", sep=",") == [("x", "2"), ("x", "2"), ("y", "1"), ("y", "1")]
    assert [tuple(r)[1:] for r in commands.file_shapes(spark, [edges]).collect()] == [(3, 3)]


def test_snapshot_and_spec(spark, put, out):
    nodes, edges = graph(put)
    snapshot = commands.schema_snapshot(spark, nodes, edges, nodes_exclude=["_"])
    columns = json.loads(snapshot)["nodes"]
    assert [(c["name"], c["datatype"]) for c in columns] == [("id", "str"), ("category", "str"), ("score", "f64")]
    commands.generation_spec(spark, nodes, edges, out("spec"), snapshot=put("snapshot.json", snapshot))
    lines = {r.value for r in spark.read.text(out("spec")).collect()}
    assert {"nodes:", "      - A", "      - 1.5", "        num_rows: '@edges.num_rows'"} <= lines
    assert not any(line.strip() == "_v:" for line in lines)


def test_clean_graph(spark, put, out):
    nodes = put("raw/node_0.tsv", "id\tcategory\tidentifier\tname", "5\tAnatomy\tU:1\tone", "6\tAnatomy\tU:2\ttwo")
    put("edges/edge_1.tsv", "s\to\tp\tw", "5\t7\tPART\t1", "6\t5\tPART\t2")
    put("edges/edge_2.tsv", "s\to\tp\tw", "5\t9\tNEXT\t3")
    record = {"id": {"identifier": "U:1"}, "equivalent_identifiers": [], "type": ["t1", "t2"], "information_content": 1.0}
    found = put("nn.json", json.dumps({"U:1": record, "U:2": None}))
    terms = put("terms.tsv", "term\tancestors", "biolink:GrossAnatomicalStructure\ta|b")
    info = put("info.tsv", "s\tp\to\tf", "Anatomy\tPART\tAnatomy\tedge_1", "Gene\tNEXT\tGene\tedge_2")
    commands.clean_graph(spark, nodes, nodes.replace("raw/node_0.tsv", "edges"), found, terms, out("clean"), info)
    lines = sorted(r.value for r in spark.read.text(out("clean/nodes")).collect())
    assert lines == ["U:1\tt1\x1ft2\tone", "U:2\ta\x1fb\ttwo", "id\tcategory\tname"]
    assert read(spark, out("clean/edges"), "subject", "object", "predicate", "w", "file") == [
        ("5", "9", "NEXT", "3", "edge_2"), ("U:1", "7", "PART", "1", "edge_1"), ("U:2", "5", "PART", "2", "edge_1"),
    ]


def test_merges(spark, put, out):
    a = put("m1.tsv", "subject\tpredicate\tobject\tsource", "1\tp\tX:1\t", "2\tp\tX:1\ta")
    b = put("m2.tsv", "subject\tpredicate\tobject\tsource\tscore", "1\tp\tX:1\tb\t2")
    for unique in (False, True):
        commands.merge_edges(spark, [a, b], out(f"e{unique}"), unique)
        assert read(spark, out(f"e{unique}"), "subject", "source", "score") == [("1", "b", "2"), ("2", "a", "-")]
    n = put("n1.tsv", "id\tcategory\tname", "1\tc\tx")
    shape = commands.merge_nodes(spark, [n, put("n2.tsv", "id\tcategory\tgene", "1\tc\tg")], out("n"))
    assert tuple(shape.first()) == (1, 4)


def test_parquet_profile(spark, tmp_path, out):
    path = str(tmp_path / "p")
    spark.createDataFrame([("x", None)], "a string, b int").write.parquet(path)
    counts, shape = commands.profile_parquet(spark, [path, path], out("rows"))
    assert tuple(shape.first()) == (2, 2) and counts.count() == 2
    assert [r.value for r in spark.read.text(out("rows")).collect()] == ['{"a":"x","b":null}'] * 2


def test_late_cells_survive_text_to_text_jobs(spark, put, out):
    head = "subject\tpredicate\tobject\tversion"
    lines = [f"a{i}\tp\tb\t{i:03d}" for i in range(150)] + ["z\tp\tb\tv2.1"]
    edges = put("e1.tsv", head, *lines)
    commands.add_edge_columns(spark, edges, out("added"), "infores:x")
    commands.merge_edges(spark, [edges, put("e2.tsv", head, "y\tp\tb\t9007199254740993")], out("merged"))
    want = {*(x.split("\t")[3] for x in lines)}
    assert {r.version for r in spark.read.csv(out("added"), sep="\t", header=True).collect()} == want
    assert {r.version for r in spark.read.csv(out("merged"), sep="\t", header=True).collect()} == want | {"9007199254740993"}
