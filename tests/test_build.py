import itertools

import pytest
from pyspark.sql import functions as F

from kgloom import plans, sources
from kgloom.functions import vocab

KG = "relation string, display_relation string, x_id string, x_type string, x_source string, y_id string, y_type string, y_source string"


def kg(spark, *data):
    return spark.createDataFrame([(r, d, xi, "t", xs, yi, "t", ys) for r, d, xi, xs, yi, ys in data], KG)


def test_grouped_ids_multiply(spark, rows):
    df = kg(
        spark,
        ("r", "d", "1_2", "MONDO_grouped", "9", "GO"),
        ("r", "d", "8", "GO", "3_4_5", "MONDO_grouped"),
        ("r", "d", "1_2", "MONDO_grouped", "3_4_5", "MONDO_grouped"),
        ("r", "d", "1", None, "2", "GO"),
        ("r", "d", "1", "GO", "2", None),
        ("r", "d", None, "MONDO_grouped", "2", "GO"),
    )
    done = plans.explode_grouped(plans.explode_grouped(df, "x"), "y")
    want = [("1", "MONDO", "9", "GO"), ("2", "MONDO", "9", "GO")]
    want += [("8", "GO", i, "MONDO") for i in "345"]
    want += [(x, "MONDO", y, "MONDO") for x, y in itertools.product("12", "345")]
    want += [(None, "MONDO", "2", "GO")]
    assert sorted(rows(done, "x_id", "x_source", "y_id", "y_source"), key=str) == sorted(want, key=str)


QUALIFIED = [
    ("anatomy_protein_absent", "d", "1", "NCBI", "2", "UBERON"),
    ("disease_phenotype_negative", "d", "1", "MONDO", "2", "HPO"),
    ("drug_protein", "enzyme", "1", "DrugBank", "2", "NCBI"),
    ("drug_protein", "transporter", "3", "DrugBank", "4", "NCBI"),
    ("drug_protein", "carrier", "5", "DrugBank", "6", "NCBI"),
    ("unmapped", "d", "5", "OTHER", "6", "NCBI"),
]


@pytest.mark.parametrize("keep", [False, True])
def test_qualifiers(spark, rows, keep):
    done = plans.build_edges(kg(spark, *QUALIFIED), keep_overwritten=keep)
    assert done.columns == ["predicate", *vocab.RELATION_EDGE_CONSTANTS, "subject", "object"]
    lost = (lambda v: v) if keep else (lambda v: None)
    names = ("subject", "predicate", "negated", "subject_aspect_qualifier", "subject_direction_qualifier")
    assert rows(done, *names) == sorted(
        [
            ("NCBIGene:1", "biolink:expressed_in", lost("true"), None, None),
            ("MONDO:0000001", "biolink:has_phenotype", "true", None, None),
            ("DrugBank:1", "biolink:affected_by", None, lost("amount"), None),
            ("DrugBank:3", "biolink:affected_by", None, "transport", "increased"),
            ("DrugBank:5", "biolink:affected_by", None, None, None),
            ("OTHER", "unmapped", None, None, None),
        ]
    )


def test_first_row_in_source_order(spark, tmp_path, rows):
    lines = ["relation,display_relation,x_id,x_source,y_id,y_source"]
    positive, negative = "disease_phenotype_positive,d", "disease_phenotype_negative,d"
    lines += [f"{positive},1,MONDO,1,HPO", f"{negative},1,MONDO,1,HPO"]
    lines += [f"{negative},2,MONDO,1,HPO", f"{positive},2,MONDO,1,HPO"]
    # rows of grouped ids come first, wherever they stand
    lines += [f"{positive},3,MONDO,1,HPO", f"{negative},3_4,MONDO_grouped,1,HPO"]
    path = tmp_path / "kg.csv"
    path.write_text("\n".join(lines) + "\n")
    table = sources.with_ordinal(sources.read_delimited(spark, str(path), sep=","))
    done = plans.build_edges(table, order_by=["_ordinal"]).where("subject like 'MONDO%'")
    assert rows(done, "subject", "negated") == [
        ("MONDO:0000001", None),
        ("MONDO:0000002", "true"),
        ("MONDO:0000003", "true"),
        ("MONDO:0000004", "true"),
    ]


def test_default_order_and_extra_columns(spark, rows):
    df = kg(
        spark,
        ("disease_phenotype_positive", "d", "1", "MONDO", "1", "HPO"),
        ("disease_phenotype_negative", "d", "1", "MONDO", "1", "HPO"),
    ).withColumn("note", F.col("relation"))
    done = plans.build_edges(df)
    assert done.columns[:2] == ["predicate", "note"]
    assert rows(done, "negated", "note") == [("true", "disease_phenotype_negative")]


def test_relation_spelled_like_its_predicate(spark, rows):
    df = kg(
        spark,
        ("biolink:has_phenotype", "d", "1", "MONDO", "1", "HPO"),
        ("disease_phenotype_negative", "d", "1", "MONDO", "1", "HPO"),
    )
    assert rows(plans.build_edges(df), "predicate", "negated") == [("biolink:has_phenotype", None)]


def test_predicate_report(spark, rows):
    df = kg(spark, *QUALIFIED, *QUALIFIED)
    assert rows(plans.predicate_mappings(df), "relation", "predicate")[-1] == ("unmapped", None)
    assert plans.predicate_mappings(df).count() == len(QUALIFIED)


def test_nodes(spark, rows):
    nodes = spark.createDataFrame(
        [("1", "10", "gene/protein", "g", "NCBI"), ("2", "2_3", "disease", "d", "MONDO_grouped"), ("4", "4", "drug", "m", "DrugBank")],
        "node_index string, node_id string, node_type string, node_name string, node_source string",
    )
    drug = spark.createDataFrame([("4", "text", "c"), ("9", "lost", "c")], "node_index string, description string, category string")
    disease = spark.createDataFrame([("2", "2"), ("2", "3")], "node_index string, mondo_id string")
    done = plans.build_nodes(nodes, drug, disease)
    assert done.columns == ["category", "name", "id", "description", "drug_category", "mondo_id"]
    assert rows(done, "id", "category", "name", "description", "drug_category", "mondo_id") == [
        (None, None, None, "lost", "c", None),
        ("DrugBank:4", "biolink:SmallMolecule", "m", "text", "c", None),
        ("MONDO:0000002", "biolink:Disease", "d", None, None, "2"),
        ("MONDO:0000003", "biolink:Disease", "d", None, None, "3"),
        ("NCBIGene:10", "biolink:Gene", "g", None, None, None),
    ]


def test_position_order_equals_ordinal_order(spark, tmp_path, rows):
    """One number instead of a struct: the same first rows, by hash aggregation alone."""
    import random

    draw = random.Random(4)
    names = ["relation", "display_relation", "x_index", "x_id", "x_type", "x_name", "x_source", "y_index", "y_id", "y_type", "y_name", "y_source"]
    relations = [("drug_disease", "indication"), ("drug_disease", "contraindication"), ("disease_phenotype_negative", "phenotype absent"), ("disease_phenotype_positive", "phenotype present")]
    folder = tmp_path / "kg files"
    folder.mkdir()
    given = []
    for n in (3, 1, 2):
        lines = [",".join(names)]
        for _ in range(120):
            grouped = draw.random() < 0.4
            x = "_".join(str(draw.randrange(4)) for _ in range(3)) if grouped else str(draw.randrange(4))
            y = "_".join(str(draw.randrange(3)) for _ in range(2)) if draw.random() < 0.3 else str(draw.randrange(3))
            lines.append(",".join([*draw.choice(relations), "1", x, "disease", "n", "MONDO_grouped" if grouped else "MONDO", "2", y, "disease", "m", "MONDO_grouped" if "_" in y else "HPO"]))
        path = folder / f"{n}.csv"
        path.write_text("\n".join(lines) + "\n")
        given.append(str(path))
    scan = sources.read_delimited(spark, given, sep=",")
    for files in (None, given):
        by_struct = plans.build_edges(sources.with_ordinal(scan, files=files), order_by=["_ordinal"])
        by_number = plans.build_edges(sources.with_position(scan, files=files), order_by=["_position"])
        assert rows(by_number) == rows(by_struct) and by_number.columns == by_struct.columns
    plan = by_number._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "HashAggregate" in plan
    assert "SortAggregate" in by_struct._jdf.queryExecution().executedPlan().toString()
