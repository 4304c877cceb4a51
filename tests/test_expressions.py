import pytest
from pyspark.sql import functions as F

from kgloom.functions import mappings, text, vocab
from kgloom.functions.curie import PADDED_SOURCES, edge_curie, with_node_curie


def column(spark, values, expression, schema="v string"):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_pad_left_never_cuts(spark):
    assert column(spark, ["5", "1234567", "123456789", None], text.pad_left(F.col("v"))) == [
        "0000005",
        "1234567",
        "123456789",
        None,
    ]


def test_edge_curies(spark):
    cases = [
        ("NCBI", "7", "NCBIGene:7"),
        ("REACTOME", "R-1", "REACT:R-1"),
        ("HPO", "12", "HPO:0000012"),
        ("MONDO", "123456789", "MONDO:123456789"),
        ("UBERON", "1", "UBERON:0000001"),
        ("CTD", "C1", "CTD:C1"),
        ("GO", "9", "GO:9"),
        ("DrugBank", "DB1", "DrugBank:DB1"),
        ("OTHER", "1", "OTHER"),
        ("NCBI", None, "NCBI"),
        ("HPO\n", "1", "HPO\n"),
        ("", "5", ""),
    ]
    got = column(spark, [c[:2] for c in cases], edge_curie(F.col("s"), F.col("i")), "s string, i string")
    assert got == [c[2] for c in cases]
    with_empty = edge_curie(F.col("s"), F.col("i"), ["", *PADDED_SOURCES])
    assert column(spark, [("", "5")], with_empty, "s string, i string") == [":0000005"]


def test_node_curies_read_the_rewritten_value(spark):
    cases = [
        ("NCBI", "7", None, "NCBIGene:7"),
        ("MONDO_grouped", "1_2", "15", "MONDO:0000015"),
        ("MONDO_grouped", "1_2", None, "MONDO"),
        ("MONDO", "3", None, "MONDO:0000003"),
        ("NCBI", "REACTOME", None, "REACT:REACTOME"),
        (None, "1", None, None),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "s string, i string, m string")
    assert [r.s for r in with_node_curie(df, "s", "i", "m").collect()] == [c[3] for c in cases]


def test_every_relation_maps(spark):
    relations = [(r, "any", p) for r, p in vocab.RELATION_PREDICATES.items()]
    relations += [(r, d, p) for (r, d), p in vocab.DISPLAY_PREDICATES.items()]
    relations += [("drug_protein", "unknown", None), ("drug_protein", None, None), ("else", "x", None)]
    got = column(
        spark,
        [c[:2] for c in relations],
        mappings.predicate(F.col("r"), F.col("d"), F.lit(None).cast("string")),
        "r string, d string",
    )
    assert got == [c[2] for c in relations]


def test_node_categories(spark):
    given = [m for m, _ in vocab.NODE_TYPE_CATEGORIES] + ["a drug", "drug disease", "other", None]
    want = [c for _, c in vocab.NODE_TYPE_CATEGORIES] + ["biolink:SmallMolecule", "biolink:Disease", "other", None]
    assert column(spark, given, mappings.node_category(F.col("v"))) == want


def test_lists_and_prefixes(spark):
    assert column(spark, ["a\x1fb", "a,b", None], text.replace_list_separator(F.col("v"))) == ["a|b", "a,b", None]
    assert column(spark, ["x", "biolink:x", None], text.with_prefix(F.col("v"))) == ["biolink:x", "biolink:x", None]
    assert column(spark, ["a|b|", "a.b"], text.text_list(F.col("v"))) == [["a", "b", ""], ["a.b"]]
    repeats = text.drop_repeats(F.split("v", ","))
    assert column(spark, ["a,a,b,a,a", "a", "", "b,b"], repeats) == [["a", "b", "a"], ["a"], [""], ["b"]]
    assert column(spark, ["A:b:c", "none"], text.before_colon(F.col("v"))) == ["A", "none"]


@pytest.mark.parametrize("value, rounded", [(10.0, 10), (7.5, 8), (0.5, 1), (0.0, 0)])
def test_rounding(value, rounded):
    assert text.round_half_up(value) == rounded
