import json

import pytest
from pyspark.sql import functions as F

from kgloom import sinks, sources


def write(tmp_path, text, name="in.tsv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_delimited_scan(spark, tmp_path):
    path = write(tmp_path, 'a\tb\tc\n"x\ty"\t"say ""hi"""\t N/A \n1\t2\t3\t4\n5\n""\t\tz\n')
    df = sources.read_delimited(spark, path)
    assert [tuple(r) for r in df.collect()] == [
        ("x\ty", 'say "hi"', " N/A "),
        ("1", "2", "3"),
        ("5", None, None),
        (None, None, "z"),
    ]
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert sources.header_tail(df, 1) == ["b", "c"]


def test_headers_differing_by_case(spark, tmp_path):
    assert sources.read_delimited(spark, write(tmp_path, "Start\tstart\n1\t2\n")).columns == ["Start", "start"]


def test_inferred_types_fit_every_row(spark, tmp_path):
    lines = ["i\tf\tb\ts\td\tbig\tn"] + ["1\t1.5\ttrue\tx\t2020-01-01\t3000000000\t7"] * 150 + ["v2.1\tlate\tlate\ty\tz\t1\t8"]
    df = sources.read_delimited(spark, write(tmp_path, "\n".join(lines)), infer=True)
    assert dict(df.dtypes) == {**dict.fromkeys("ifbsd", "string"), "big": "bigint", "n": "bigint"}
    assert tuple(df.collect()[-1]) == ("v2.1", "late", "late", "y", "z", 1, 8)
    # whatever the file that holds it
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder, "a\tb\n1\t2.5\n", "1.tsv")
    write(folder, "a\tb\nx\t3\n", "2.tsv")
    both = sources.read_delimited(spark, str(folder), infer=True)
    assert sorted(tuple(r) for r in both.collect()) == [("1", 2.5), ("x", 3.0)]


def test_folders_of_unlike_headers(spark, tmp_path):
    write(tmp_path, "id\tcategory\nG:1\tGene\n", "1.tsv")
    write(tmp_path, "category\tid\textra\nDisease\tD:1\te\n", "2.tsv")
    with pytest.raises(Exception, match="[Hh]eader"):
        sources.read_delimited(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="[Hh]eader"):
        sources.read_lines_tsv(spark, str(tmp_path)).collect()
    found = sources.read_delimited(spark, str(tmp_path), headers="by_name").select("id", "category", "extra")
    assert sorted(tuple(r) for r in found.collect()) == [("D:1", "Disease", "e"), ("G:1", "Gene", None)]
    with pytest.raises(ValueError):
        sources.read_delimited(spark, str(tmp_path), headers="guess")


def test_typed_by_name(spark, tmp_path):
    write(tmp_path, "a\tb\tc\n1\ttrue\tx\n", "1.tsv")
    write(tmp_path, "b\ta\n\t2.5\n", "2.tsv")
    found = sources.read_delimited(spark, str(tmp_path), infer=True, headers="by_name")
    assert dict(found.dtypes) == {"a": "double", "b": "boolean", "c": "string"}


def test_raw_files_have_their_own_headers(spark, tmp_path):
    write(tmp_path, "id\tcat\tident\tname\n1\tA\tX:1\tn\n", "one.tsv")
    write(tmp_path, "i\tc\tx\tweight\tname\n2\tB\tY:1\t5\tm\n", "two.tsv")
    found = sources.read_raw_nodes(spark, str(tmp_path), file="file").orderBy("id")
    assert [r.asDict() for r in found.collect()] == [
        {"id": "1", "category": "A", "identifier": "X:1", "name": "n", "weight": None, "file": "one"},
        {"id": "2", "category": "B", "identifier": "Y:1", "name": "m", "weight": "5", "file": "two"},
    ]


def test_files_in_a_given_order(spark, tmp_path):
    paths = [write(tmp_path, f"a\n{x}1\n{x}2\n", f"{x}.tsv") for x in "abc"]
    given = [paths[2], paths[0], paths[1]]
    rows = sources.with_ordinal(sources.read_delimited(spark, given), files=given)
    assert [r.a for r in rows.orderBy("_ordinal").collect()] == ["c1", "c2", "a1", "a2", "b1", "b2"]


def test_strict_width(spark, tmp_path):
    good = write(tmp_path, "a\tb\n1\tx\n2\n\t\n", "good.tsv")
    df = sources.read_delimited(spark, good, infer=True, ragged="error")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, None)]
    for extra in ("1\t2\t3\n", "1\t2\t\n"):
        wide = write(tmp_path, "a\tb\n" + extra, "wide.tsv")
        with pytest.raises(Exception, match="more fields"):
            sources.read_delimited(spark, wide, ragged="error").select("a").collect()
        with pytest.raises(Exception, match="more fields"):
            sources.read_delimited(spark, wide, ragged="error").count()
    quoted = write(tmp_path, 'a\tb\n"x\ty"\n"p""\t"\tq\n', "quoted.tsv")
    assert [tuple(r) for r in sources.read_delimited(spark, quoted, ragged="error").collect()] == [
        ("x\ty", None), ('p"\t', "q"),
    ]
    with pytest.raises(ValueError):
        sources.read_delimited(spark, good, ragged="skip")


def test_multi_line(spark, tmp_path):
    path = write(tmp_path, 'a\tb\n"x\ny"\t1\n')
    assert [tuple(r) for r in sources.read_delimited(spark, path, multi_line=True).collect()] == [("x\ny", "1")]


ODD_CELLS = ["", "x", '"', '""', "a\nb", "\n", "\n\n\n", "l\r\nm", "t\tu", ' "q" ', "end\\", "a,b", 'say "\n" twice', "0", "ünï\n😀"]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("sep", ["\t", ","])
def test_records_over_many_blocks(spark, tmp_path, seed, sep):
    """Blocks of a few bytes, so that cells, quotes and records are cut anywhere; several files in one scan."""
    import csv
    import random

    draw = random.Random(seed)
    want, folder = [], tmp_path / "with blanks"
    folder.mkdir()
    for n in range(3):
        rows = [[draw.choice(ODD_CELLS) if draw.random() < 0.6 else "plain" for _ in range(3)] for _ in range(60)]
        rows = [r if any(r) else ["x", *r[1:]] for r in rows]
        with open(folder / f"{n} [x].tsv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, delimiter=sep, lineterminator=draw.choice(["\n", "\r\n"]), quoting=draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
            out.writerow(["one", "two\nlines", 'th"ree'])
            for r in rows:
                out.writerow(r)
                if draw.random() < 0.1:
                    f.write("\n")
        want += [tuple(c or None for c in r) for r in rows]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(draw.choice([7, 40, 300])))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = sources.read_delimited(spark, str(folder), sep=sep, multi_line=True, ordinal="at")
        assert found.columns == ["at", "one", "two\nlines", 'th"ree']
        got = [tuple(r)[1:] for r in found.orderBy("at").collect()]
        many = spark.read.text(str(folder)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want and many > 5


def test_a_record_over_blocks_and_stray_quotes(spark, tmp_path):
    """One cell longer than many blocks; quotes inside plain cells open nothing."""
    cell = "\n".join(f"line {i}" for i in range(3000))
    path = write(tmp_path, f'a\tb\n5" pipe\tx\n"{cell}"\t1\n6"\t"7"" x"\n"c"d\te\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {tuple(r) for r in sources.read_delimited(spark, path, multi_line=True).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {('5" pipe', "x"), (cell, "1"), ('6"', '7" x'), ('"c"d', "e")}


def test_multi_line_headers_types_and_widths(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder, 'n\tt\n1\t"x\ny"\n2\n', "1.tsv")
    other = write(folder, 'n\tt\n3\t\t4\n', "2.tsv")
    found = sources.read_delimited(spark, str(folder), multi_line=True, infer=True)
    assert dict(found.dtypes) == {"n": "bigint", "t": "string"}
    assert sorted(tuple(r) for r in found.collect()) == [(1, "x\ny"), (2, None), (3, None)]
    with pytest.raises(Exception, match="more fields"):
        sources.read_delimited(spark, other, multi_line=True, ragged="error").collect()
    write(folder, "t\tn\n1\t2\n", "3.tsv")
    with pytest.raises(Exception, match="header"):
        sources.read_delimited(spark, str(folder), multi_line=True).collect()
    named = sources.read_delimited(spark, str(folder), multi_line=True, headers="by_name")
    assert sorted(((r.n, r.t) for r in named.collect()), key=str) == [("1", "x\ny"), ("2", "1"), ("2", None), ("3", None)]


@pytest.mark.parametrize("name", ["a b.tsv", "50%20x.tsv", "x+y.tsv", "ü é.tsv", "q[1]{2}.tsv", "#1&2.tsv"])
def test_file_names_are_taken_as_they_are(spark, tmp_path, name):
    folder = tmp_path / "my files"
    folder.mkdir()
    path = write(folder, "id\tcat\tident\tname\n1\tA\tX:1\tn\n", name)
    plain = write(folder, "id\tcat\tident\tother\n2\tB\tY:1\to\n", "plain.tsv")
    for given in (str(folder), [sources.paths.literal(path), plain]):
        found = sources.read_delimited(spark, given, headers="by_name").orderBy("id")
        assert [(r.id, r.name, r.other) for r in found.collect()] == [("1", "n", None), ("2", None, "o")]
        assert [r.file for r in sources.read_raw_nodes(spark, given, file="file").orderBy("id").collect()] == [name.removesuffix(".tsv"), "plain"]
    tagged = sources.read_many(spark, [sources.paths.literal(path), plain]).orderBy("id")
    assert [r["_file"] for r in tagged.collect()] == [name, "plain.tsv"]
    edges = sources.read_raw_edges(spark, str(folder))
    assert sorted(r.subject for r in edges.collect()) == ["1", "2"]


def test_places_of_files_whose_names_end_alike(spark, tmp_path):
    paths = [write(tmp_path, f"a\n{x}\n", f"{x}.tsv") for x in ("a", "z a", "b")]
    for given in (paths, ["a.tsv", "z a.tsv", "b.tsv"]):
        rows = sources.with_ordinal(sources.read_delimited(spark, paths), files=given)
        assert [r.a for r in rows.orderBy("_ordinal").collect()] == ["a", "z a", "b"]


def test_raw_scans(spark, tmp_path):
    nodes = write(tmp_path, 'id\tcat\tident\tname\n1\tA\tX:1\t"quoted\n2\tA\n3\n4\tA\t\tz\n', "n.tsv")
    found = sources.read_raw_nodes(spark, nodes)
    assert found.columns == ["id", "category", "identifier", "name"]
    assert [tuple(r) for r in found.collect()] == [("1", "A", "X:1", '"quoted'), ("4", "A", "", "z")]
    edges = write(tmp_path, "s\to\tp\textra\n1\t2\tBINDS\te\n", "e.tsv")
    assert sources.read_raw_edges(spark, edges).first().asDict() == {
        "subject": "1", "object": "2", "predicate": "BINDS", "extra": "e",
    }
    with pytest.raises(ValueError):
        sources.read_raw_nodes(spark, write(tmp_path, "id\tcat\n1\t2\n", "short.tsv"))


def test_kgx_scans(spark, tmp_path):
    nodes = write(tmp_path, "category\tother\tid\nc\tx\t1\n\ty\t2\n", "n.tsv")
    assert [tuple(r) for r in sources.read_kgx_nodes(spark, nodes).collect()] == [("1", "c"), ("2", "")]
    head = "subject\tpredicate\tobject\tprimary_knowledge_source\tknowledge_level\tagent_type\n"
    edges = write(tmp_path, head + "s\tp\to\ti\tk\ta\n", "e.tsv")
    assert tuple(sources.read_kgx_edges(spark, edges).first()) == ("s", "p", "o", "i", None, "k", "a")
    with pytest.raises(ValueError, match="missing"):
        sources.read_kgx_edges(spark, nodes)
    for bad in ("id\tcategory\n1\n", "id\tcategory\n1\t2\t3\n"):
        with pytest.raises(Exception):
            sources.read_kgx_nodes(spark, write(tmp_path, bad, "bad.tsv")).collect()


def test_many_files(spark, tmp_path, rows):
    a, b = write(tmp_path, "x\ty\n1\t2\n", "a.tsv"), write(tmp_path, "z\tx\n4\t3\n", "b.tsv")
    assert rows(sources.read_many(spark, [a, b]), "_file", "x", "y", "z") == [("a.tsv", "1", "2", None), ("b.tsv", "3", None, "4")]


def test_lookups(spark, tmp_path, rows):
    info = write(tmp_path, "s\tp\to\tf\nA\tr\tB\tone\nA\tr\tB\ttwo\nC\tr\tD\tthree\n", "p.tsv")
    assert rows(sources.read_predicate_info(spark, info)) == [("A", "r", "B", "two"), ("C", "r", "D", "three")]
    cats = write(tmp_path, "c\tf\tn\nAnatomy\tnode_0\t1\nGene\tnode_1\t2\nX\tnode_2\tabout Anatomy\n", "c.tsv")
    assert rows(sources.read_category_info(spark, cats, ["Anatomy"])) == [("Anatomy", "node_0"), ("X", "node_2")]


def test_normalization_records(spark, tmp_path, rows):
    record = {
        "id": {"identifier": "U:1", "label": "one"},
        "equivalent_identifiers": [{"identifier": "U:1"}, {"identifier": "M:1", "label": "m"}],
        "type": ["t1", "t2"],
        "information_content": 90.9,
    }
    path = write(tmp_path, json.dumps({"U:0": record, "U:9": None}) + "\n", "n.json")
    found = sources.read_normalization(spark, path)
    assert rows(found, "identifier", "preferred_identifier", "label", "types") == [
        ("U:0", "U:1", "one", ["t1", "t2"]),
        ("U:9", None, None, None),
    ]
    assert found.where("identifier = 'U:0'").first().equivalent_identifiers[1].identifier == "M:1"


def test_ordinal_follows_the_file(spark, tmp_path):
    path = write(tmp_path, "v\n" + "".join(f"{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        found = sources.with_ordinal(sources.read_delimited(spark, path)).orderBy("_ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.v for r in found] == [str(i) for i in range(20_000)]


def test_delimited_round_trip(spark, tmp_path, rows):
    data = [("1", 'q"q', " blanks "), ("2", "tab\there", "back\\slash"), ("3", None, "x")]
    out = str(tmp_path / "out")
    sinks.write_delimited(spark.createDataFrame(data, "a string, b string, c string"), out)
    assert rows(sources.read_delimited(spark, out)) == data


def test_unquoted_round_trip(spark, tmp_path, rows):
    data = [("1", 'q"q', " b "), ("2", "", "back\\slash"), ("3", "'", '""')]
    out = str(tmp_path / "out")
    sinks.write_unquoted(spark.createDataFrame(data, "a string, b string, c string").coalesce(1), out)
    assert spark.read.text(out).first().value == "a\tb\tc"
    assert [r.value for r in spark.read.text(out).collect()][1:] == ["\t".join(d) for d in data]
    assert rows(sources.read_lines_tsv(spark, out)) == data


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 1)], "k string, v int")
    sinks.write_json(df, str(tmp_path / "j"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect())
    assert [json.loads(line) for line in lines] == [{"k": "a", "v": 1}, {"k": "b", "v": None}]


def test_lines_keep_their_order(spark, tmp_path):
    lines = spark.range(1000).select(F.format_string("%05d", "id").alias("line")).orderBy("line")
    sinks.write_lines(lines, str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).orderBy("value").collect()][:2] == ["00000", "00001"]
