import itertools
import random

import pytest
from pyspark.sql import functions as F

from kgloom import plans
from kgloom.operators.merge import hot_keys, merge_tables, merged_layout


def folded(tables, keys):
    """Brute force: full outer joins one after the other, over lists of dicts."""
    found = sorted({tuple(r[k] for k in keys) for t in tables for r in t if all(r[k] is not None for k in keys)})
    result = []
    for key in found:
        matches = [[r for r in t if tuple(r[k] for k in keys) == key] or [None] for t in tables]
        result += [list(combination) for combination in itertools.product(*matches)]
    for i, table in enumerate(tables):
        for row in table:
            if any(row[k] is None for k in keys):
                result.append([row if j == i else None for j in range(len(tables))])
    return result


def expected(tables, keys, out):
    lines = []
    for combination in folded(tables, keys):
        line = []
        for name, cells in out:
            if name in keys:
                line.append(next(r[name] for r in combination if r is not None))
            else:
                values = [combination[i][c] for i, c in cells if combination[i] is not None]
                line.append(next((v for v in values if v is not None), None))
        lines.append(tuple(line))
    return sorted(lines, key=str)


def random_tables(seed, unique):
    rng = random.Random(seed)
    tables = []
    for names in (["v", "a"], ["v", "w"], ["v", "w", "b"]):
        rows, used = [], set()
        for _ in range(40):
            row = {"k": rng.choice([None, "1", "2", "3", "4", "5"]), "l": rng.choice(["x", "y", None])}
            key = (row["k"], row["l"])
            if unique and None not in key and key in used:
                continue
            used.add(key)
            row.update({n: rng.choice([None, "p", "q", "r"]) for n in names})
            rows.append(row)
        tables.append((names, rows))
    return tables


OUT = [
    ("k", []),
    ("l", []),
    ("v", [(0, "v"), (1, "v"), (2, "v")]),
    ("a", [(0, "a")]),
    ("w", [(1, "w")]),
    ("w_right", [(2, "w")]),
    ("b", [(2, "b")]),
]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", ["joined", "split", "unique"])
def test_equals_the_fold(spark, seed, mode):
    tables = random_tables(seed, unique=mode == "unique")
    frames = [
        spark.createDataFrame(
            [tuple(r[c] for c in ["k", "l", *names]) for r in rows],
            ", ".join(f"{c} string" for c in ["k", "l", *names]),
        )
        for names, rows in tables
    ]
    options = {"joined": {}, "split": {"split_rows": 1}, "unique": {"unique_keys": True}}[mode]
    merged = merge_tables(frames, ["k", "l"], ["v"], **options)
    assert merged.columns == [n for n, _ in OUT]
    got = sorted((tuple(r) for r in merged.collect()), key=str)
    assert got == expected([rows for _, rows in tables], ["k", "l"], OUT)


def test_hot_key_of_equal_rows_is_divided_and_whole(spark):
    copies = spark.range(20_000, numPartitions=8).select(F.lit("hot").alias("k"), F.lit("same").alias("a"))
    single = spark.createDataFrame([("hot", "1"), ("cold", "2")], "k string, b string")
    merged = merge_tables([copies, single], ["k"], split_rows=1_000)
    counted = merged.groupBy("k", "a", "b").count().collect()
    assert sorted(tuple(r) for r in counted) == sorted([("hot", "same", "1", 20_000), ("cold", None, "2", 1)], key=str)
    # the copies meet in more than one join partition
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_tables([copies, single], ["k"], split_rows=1_000)
        places = merged.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert places > 1


def test_unique_keys_are_checked(spark):
    twice = spark.createDataFrame([("1", "a"), ("1", "b")], "k string, v string")
    with pytest.raises(Exception, match="occurs twice"):
        merge_tables([twice], ["k"], unique_keys=True).collect()
    assert merge_tables([twice], ["k"]).count() == 2


def test_many_unique_tables(spark, rows):
    frames = [spark.createDataFrame([(1, i)], f"k int, c{i} int") for i in range(70)]
    merged = merge_tables(frames, ["k"], unique_keys=True)
    assert rows(merged) == [(1, *range(70))]


def test_second_collision_is_an_error():
    with pytest.raises(ValueError, match="collides again"):
        merged_layout([["k", "x"], ["k", "x"], ["k", "x"]], ["k"], [], None)
    assert list(merged_layout([["k", "x"], ["k", "x"]], ["k"], [], None)) == ["k", "x", "x_right"]


def test_mixed_types(spark, rows):
    a = spark.createDataFrame([(1, 5, 1)], "k int, v int, w int")
    b = spark.createDataFrame([(2, 1.5, "t")], "k int, v double, w string")
    for unique in (False, True):
        assert rows(merge_tables([a, b], ["k"], ["v", "w"], unique_keys=unique)) == [(1, "5", "1"), (2, "1.5", "t")]
    whole = spark.createDataFrame([(3, 9007199254740993)], "k int, v long")
    assert rows(merge_tables([a.select("k", "v"), whole], ["k"], ["v"])) == [(1, 5), (3, 9007199254740993)]


def test_hot_keys_are_bounded_by_shares(spark):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a = spark.range(1000).selectExpr("CASE WHEN id < 700 THEN 1 ELSE id END k", "id v")
    b = spark.range(100).selectExpr("id k", "id w")
    hashed = spark.range(1, 2).select(F.xxhash64(F.col("id"))).first()[0]
    found = {r["__hash"]: (r["__parts"], r["__divided"]) for r in hot_keys([a, b], ["k"]).collect()}
    assert found == {hashed: (-(-700 // -(-1000 // partitions)), 0)}
    assert {r["__hash"] for r in hot_keys([a, b], ["k"], split_rows=100).collect()} == {hashed}
    assert hot_keys([a.where("false"), b.where("false")], ["k"]).count() == 0


def test_hot_keys_are_found_among_many(spark):
    """More keys than a summary tracks."""
    many = spark.range(300_000, numPartitions=6).selectExpr("CASE WHEN id % 3 = 0 THEN -5 WHEN id % 5 = 0 THEN -7 ELSE id END k", "id v")
    found = {r["__hash"]: r["__parts"] for r in hot_keys([many], ["k"]).collect()}
    hashed = spark.createDataFrame([(-5,)], "k long").select(F.xxhash64("k")).first()[0]
    assert found[hashed] >= 2


def test_a_hot_key_in_several_tables(spark):
    """A third of one table, and several rows of two others; one table has none."""
    a = spark.range(3000, numPartitions=5).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END k", "id a")
    b = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z"), (-9, "w")], "k long, b string")
    c = spark.createDataFrame([(0, 1.5), (0, 2.5), (-9, None)], "k long, c double")
    d = spark.createDataFrame([], "k long, d string")
    merged = merge_tables([a, b, c, d], ["k"], split_rows=50)
    got = merged.groupBy("k", "b", "c").agg(F.count(F.lit(1)).alias("n"), F.count("a").alias("a"), F.count("d").alias("d"))
    hot = {tuple(r) for r in got.where("k = 0").collect()}
    assert hot == {(0, b, c, 1000, 1000, 0) for b in "xy" for c in (1.5, 2.5)}
    assert merged.where("k = -9").collect() == [(-9, None, "w", None, None)] and merged.where("k = 1").count() == 1
    assert merged.count() == 4 * 1000 + 2000 + 1


def test_one_exchange_for_all_tables(spark):
    tables = [spark.range(3).selectExpr("id k", f"id c{i}") for i in range(5)]
    plan = merge_tables(tables, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_many_wide_tables_plan_quickly(spark, tmp_path):
    import time

    names = ["subject", "predicate", "object", *[f"c{i}" for i in range(5)]]
    tables = []
    for i in range(26):
        head = ", ".join(f"{n} string" for n in [*names[:3], *[f"{n}_{i}" for n in names[3:]]])
        spark.createDataFrame([tuple(f"{i % 3}" for _ in names)], head).write.csv(f"{tmp_path}/{i}", sep="\t", header=True)
        tables.append(spark.read.schema(head).csv(f"{tmp_path}/{i}", sep="\t", header=True))
    plans.merge_edges(tables[:3])._jdf.queryExecution().executedPlan().toString()
    began = time.time()
    merged = plans.merge_edges(tables)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    took = time.time() - began
    assert plan.count("FileScan") == 26 and took < 10
    print(f"planned in {took:.1f} s")
    assert sorted(r.subject for r in merged.select("subject", "c3_4", "c0_25").collect()) == ["0", "1", "2"]


@pytest.mark.parametrize("unique", [False, True])
def test_nodes_always_have_a_name(spark, rows, unique):
    a = spark.createDataFrame([("1", "c", "s")], "id string, category string, source string")
    b = spark.createDataFrame([("1", "c", "t", "e")], "id string, category string, source string, EC string")
    merged = plans.merge_nodes([a, b], unique_keys=unique)
    assert merged.columns == ["id", "name", "category", "source", "EC"]
    assert rows(merged) == [("1", None, "c", "s", "e")]


def test_edges_coalesce_their_columns(spark, rows):
    schema = "subject string, predicate string, object string, evidence string, note string"
    a = spark.createDataFrame([("s", "p", "o", None, "n")], schema)
    b = spark.createDataFrame([("s", "p", "o", "e", "m")], schema)
    merged = plans.merge_edges([a, b])
    assert merged.columns == ["subject", "predicate", "object", "evidence", "note", "note_right"]
    assert rows(merged) == [("s", "p", "o", "e", "n", "m")]


def test_keys_of_unlike_types(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k bigint, v string")
    b = spark.createDataFrame([("1", "y"), ("z", "w")], "k string, u string")
    for unique in (False, True):
        assert rows(merge_tables([a, b], ["k"], unique_keys=unique)) == [("1", "x", "y"), ("z", None, "w")]
