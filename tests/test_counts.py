import pytest

from kgloom import operators as ops
from kgloom import plans


def counted(spark, sizes):
    data = [(f"v{i:02}",) for i, n in enumerate(sizes) for _ in range(n)]
    return spark.createDataFrame(data, "_c string")


@pytest.mark.parametrize("values, expected", [(3, 6), (15, 20), (25, 20)])
def test_head_and_tail(spark, values, expected):
    sizes = [1 + i % 4 for i in range(values)]
    done = plans.superfluous_value_counts(counted(spark, sizes)).orderBy("position").collect()
    order = sorted(range(values), key=lambda i: (-sizes[i], i))
    ranked = [(f"v{i:02}", sizes[i]) for i in order]
    assert [(r.value, r.counts) for r in done] == ranked[:10] + ranked[-10:]
    assert [r.position for r in done] == list(range(1, expected + 1))


def test_nulls_are_values(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", None)], "_a string, _b int")
    assert rows(ops.value_counts(df, ["_a", "_b"])) == sorted(
        [("_a", None, 2), ("_a", "a", 1), ("_b", "1", 1), ("_b", "2", 1), ("_b", None, 1)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_ignored_columns(spark):
    df = spark.createDataFrame([("x", "y", "z")], "a string, _b string, _c string")
    assert {r.column_name for r in plans.superfluous_value_counts(df, ignore=["_c"]).collect()} == {"_b"}


def test_wide(spark, rows):
    df = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1")], "_a string, _b string")
    wide = ops.wide_counts(plans.superfluous_value_counts(df, k=1), ["_a", "_b"])
    assert wide.columns == ["position", "_a", "_a_counts", "_b", "_b_counts"]
    assert rows(wide) == [(1, "x", 2, "1", 2), (2, "y", 1, "2", 1)]


def test_file_shapes(spark, tmp_path, rows):
    (tmp_path / "a.tsv").write_text("x\ty\tz\n1\t2\n\n4\t5\t6\t7\n")
    (tmp_path / "b.tsv").write_text("x")
    (tmp_path / "c.tsv").write_bytes(b"x\ty\r\n1\r2\t2\r\n")
    done = ops.file_shapes(spark, [str(tmp_path / n) for n in ("a.tsv", "b.tsv", "c.tsv")])
    assert [(r[0].rsplit("/", 1)[1], *r[1:]) for r in rows(done)] == [("a.tsv", 4, 3), ("b.tsv", 1, 1), ("c.tsv", 2, 2)]


def test_file_shapes_of_a_split_file(spark, tmp_path, rows):
    path = tmp_path / "long.tsv"
    path.write_text("a\tb\n" + "".join(f"{i}\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        done = rows(ops.file_shapes(spark, [str(path)]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[1:] for r in done] == [(50_001, 2)]


def test_parquet_profile(spark, tmp_path, rows):
    one, two, other = (str(tmp_path / n) for n in ("one", "two", "other"))
    spark.createDataFrame([("x", 1), ("x", 2)], "a string, b int").write.parquet(one)
    spark.createDataFrame([("y", 3)], "a string, b int").write.parquet(two)
    spark.createDataFrame([("y", 3)], "a string, b bigint").write.parquet(other)
    counts, shape, everything = plans.profile_parquet(spark, [one, two])
    assert rows(counts.where("column_name = 'a'"), "value", "counts", "rank") == [("x", 2, 1)]
    assert rows(shape) == [(3, 2)]
    assert everything.count() == 3
    with pytest.raises(ValueError, match="differs"):
        plans.profile_parquet(spark, [one, other])
