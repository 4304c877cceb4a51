"""Merging many tables on shared keys: a fold of full outer joins, done at once."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import named

Layout = dict[str, list[tuple[int, str]]]

#: keys that a summary of frequent keys tracks for each shuffle partition, and at most
SHARE_DETAIL, MOST_TRACKED = 16, 1 << 19


def merged_layout(
    columns: list[list[str]], keys: list[str], coalesce: Iterable[str], leading: list[str] | None
) -> Layout:
    """Output columns in order, each with the (table, column) cells that feed it.

    Columns named in ``coalesce`` merge, first table first. Any other name met
    twice gets the suffix ``_right``; met a third time it is an error.
    """
    coalesce = set(coalesce)
    layout: Layout = {name: [] for name in (leading or keys)}
    for i, names in enumerate(columns):
        for name in names:
            if name in keys:
                continue
            if name not in layout:
                layout[name] = [(i, name)]
            elif name + "_right" in layout:
                raise ValueError(f"column {name!r} of table {i} collides again with {name + '_right'!r}")
            elif name in coalesce:
                layout[name].append((i, name))
            else:
                layout[name + "_right"] = [(i, name)]
    return layout


def merge_tables(
    dfs: list[DataFrame],
    keys: list[str],
    coalesce: Iterable[str] = (),
    leading: list[str] | None = None,
    unique_keys: bool = False,
    split_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Full outer merge of ``dfs`` on ``keys``, equal to joining them one by one.

    ``leading`` is the column order of the (empty) first table of the fold; it
    defaults to the keys. Null keys match nothing and keep their rows apart.

    All rows go through one exchange by key. With ``unique_keys`` every key
    occurs at most once per table (checked at run time) and one aggregation does.
    Otherwise duplicates multiply as in a join: the rows of a key come together
    as one run a table, and the product of the runs is put out as it is made.
    The keys of ``hot`` (``hot_keys`` of the tables, by default) are divided: one
    table's rows of such a key are parted, the other tables' are repeated.
    """
    if not dfs:
        raise ValueError("nothing to merge")
    dfs = _with_shared_key_types(dfs, keys)
    layout = merged_layout([df.columns for df in dfs], keys, coalesce, leading)
    types = {name: _common_type(dfs, cells) for name, cells in layout.items()}
    if unique_keys:
        merged = _merge_unique([df.where(_all_present(keys)) for df in dfs], keys, layout, types)
    else:
        hot = hot_keys(dfs, keys, split_rows) if hot is None else hot
        return _merge_runs(dfs, keys, layout, types, hot)
    for i, df in enumerate(dfs):
        if any(df.schema[k].nullable for k in keys):
            merged = merged.unionByName(_slots(df.where(~_all_present(keys)), i, keys, layout, types))
    return merged


def _with_shared_key_types(dfs: list[DataFrame], keys: list[str]) -> list[DataFrame]:
    """Keys of unlike types (say, inferred from different files) are compared as text."""
    unlike = [k for k in keys if len({df.schema[k].dataType for df in dfs}) > 1]
    if not unlike:
        return dfs
    return [df.withColumns({k: named(k).cast("string") for k in unlike}) for df in dfs]


def _all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys])


def _common_type(dfs: list[DataFrame], cells: list[tuple[int, str]]) -> T.DataType:
    """Type of a merged column: shared as is, mixed whole numbers long, else text, which loses nothing."""
    found = {dfs[i].schema[c].dataType for i, c in cells}
    if len(found) == 1:
        return found.pop()
    if found and all(isinstance(t, T.IntegralType) for t in found):
        return T.LongType()
    return T.StringType()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _slots(
    df: DataFrame, i: int, keys: list[str], layout: Layout, types: dict[str, T.DataType], beside: Iterable[str] = ()
) -> DataFrame:
    """Rows of table ``i`` alone, in the output layout, and the columns ``beside``.

    The many cells are written as text, which the driver's Python hands over at once.
    """
    out = []
    for name, cells in layout.items():
        own = name if name in keys else next((c for j, c in cells if j == i), None)
        if name in keys:
            out.append(_quoted(name))
        else:
            cell = "NULL" if own is None else _quoted(own)
            out.append(f"CAST({cell} AS {types[name].simpleString()}) AS {_quoted(name)}")
    return df.selectExpr(*out, *map(_quoted, beside))


def _merge_unique(
    dfs: list[DataFrame], keys: list[str], layout: Layout, types: dict[str, T.DataType]
) -> DataFrame:
    parts = [
        _slots(df, i, keys, layout, types).withColumn("__table", F.lit(i)) for i, df in enumerate(dfs)
    ]
    rows = reduce(DataFrame.unionByName, parts).repartition(*[named(k) for k in keys])
    first = [
        F.min_by(named(n), F.when(named(n).isNotNull(), F.col("__table"))).alias(n)
        for n in layout
        if n not in keys
    ]
    # 62 tables per word; a key repeated within a table leaves fewer bits than rows
    words = [
        F.bit_count(
            F.coalesce(
                F.bit_or(F.when(F.floor(F.col("__table") / 62) == w, F.expr("shiftleft(1L, __table % 62)"))),
                F.lit(0),
            )
        )
        for w in range((len(dfs) - 1) // 62 + 1)
    ]
    seen = reduce(lambda a, b: a + b, words)
    merged = rows.groupBy(*[named(k) for k in keys]).agg(
        *first, (seen == F.count("*")).alias("__unique")
    )
    repeated = F.raise_error(F.lit("a key occurs twice in one table: use unique_keys=False"))
    merged = merged.where(F.when(F.col("__unique"), F.lit(True)).otherwise(repeated.cast("boolean")))
    return merged.select(*[named(n) for n in layout])


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[named(k) for k in keys])


def hot_keys(dfs: list[DataFrame], keys: list[str], split_rows: int | None = None) -> DataFrame:
    """Keys whose rows one partition should not take alone, by hash: __hash, __parts, __divided.

    A key is hot when it holds more of a table's rows than an even share, the
    table's rows by the session's shuffle partitions; ``split_rows`` sets the
    share as a number of rows instead. ``__divided`` is the table whose rows are
    parted, into so many parts; the others repeat theirs.

    The counts come from summaries of the most frequent keys, which are merged
    over all tasks: one pass over the keys, which are not shuffled, and one row a
    table. Of one table there are fewer hot keys than partitions (or, with
    ``split_rows``, as many as the summary keeps). Counts may be off by a part of
    a share, and keys of equal hash are divided alike: this moves rows, and no
    result.
    """
    spark = dfs[0].sparkSession
    dfs = [df.where(_all_present(keys)) for df in _with_shared_key_types(dfs, keys)]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the error of a summary is a small part of the rows by what it tracks
    tracked = min(MOST_TRACKED, 1 << max(10, (SHARE_DETAIL * partitions).bit_length()))
    hashes = [df.select(F.lit(i).alias("__table"), _key_hash(keys).alias("__hash")) for i, df in enumerate(dfs)]
    top = F.expr(f"approx_top_k(__hash, {tracked // 2}, {tracked})").alias("top")
    found: dict[int, tuple[int, int]] = {}
    for row in reduce(DataFrame.unionAll, hashes).groupBy("__table").agg(F.count(F.lit(1)).alias("n"), top).collect():
        share = split_rows or max(1, -(-row["n"] // partitions))
        for item in row["top"]:
            parts = -(-item["count"] // share)
            if parts > 1 and (-parts, row["__table"]) < found.get(item["item"], (0, 0)):
                found[item["item"]] = (-parts, row["__table"])
    listed = [(h, -parts, table) for h, (parts, table) in found.items()]
    return spark.createDataFrame(listed, "__hash long, __parts int, __divided int")


def _merge_runs(
    dfs: list[DataFrame], keys: list[str], layout: Layout, types: dict[str, T.DataType], hot: DataFrame
) -> DataFrame:
    key_columns = [named(k) for k in keys]
    fed = [[n for n, cells in layout.items() if n not in keys and any(j == i for j, _ in cells)] for i in range(len(dfs))]
    tagged = []
    for i, df in enumerate(dfs):
        # content plus source partition: a rerun of the task gives the same part, and copies of one row still spread
        content = F.xxhash64(*[named(c) for c in df.columns])
        source = df.withColumns({"__content": content, "__origin": F.spark_partition_id()})
        slots = _slots(source, i, keys, layout, types, ["__content", "__origin"])
        tagged.append(slots.withColumn("__table", F.lit(i)))
    rows = reduce(DataFrame.unionAll, tagged).withColumn("__hash", _key_hash(keys))
    # fewer hot keys than partitions x tables
    rows = rows.join(F.broadcast(hot), "__hash", "left")
    own_part = F.pmod(F.pmod(F.col("__content"), F.col("__parts")) + F.col("__origin"), F.col("__parts")).cast("int")
    # rows without a whole key meet no other row: they go to parts of their own, a table's apart from the others'
    spread = 4 * int(dfs[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    alone = F.pmod(F.pmod(F.col("__content"), F.lit(spread)) + F.col("__origin"), F.lit(spread))
    alone = (-1 - F.col("__table") * spread - alone).cast("int")
    parts = (
        F.when(~_all_present(keys), F.array(alone))
        .when(F.col("__parts").isNull(), F.array(F.lit(0)))
        .when(F.col("__divided") == F.col("__table"), F.array(own_part))
        .otherwise(F.sequence(F.lit(0), F.col("__parts") - 1))
    )
    rows = rows.withColumn("__part", F.explode(parts)).repartition(*key_columns, "__part")
    runs = []
    for i in range(len(dfs)):
        row = ", ".join(["true AS __in", *map(_quoted, fed[i])])
        runs.append(F.expr(f"collect_list(CASE WHEN __table = {i} THEN struct({row}) END)").alias(f"__run{i}"))
    merged = rows.groupBy(*key_columns, "__part").agg(F.first("__divided").alias("__divided"), *runs)
    # a part that got none of the divided table's rows is no row of the result
    sizes = ", ".join(f"size(__run{i})" for i in range(len(dfs)))
    merged = merged.where(f"coalesce(get(array({sizes}), __divided) > 0, true)")
    # the product of the runs; one statement, as each step on a wide table takes the planner as long as the first
    views = " ".join(f"LATERAL VIEW OUTER explode(__run{i}) AS __row{i}" for i in range(len(dfs)))
    out = []
    for name, cells in layout.items():
        fed_by = [f"__row{i}.{_quoted(name)}" for i, _ in cells] or [f"CAST(NULL AS {types[name].simpleString()})"]
        out.append(_quoted(name) if name in keys else f"coalesce({', '.join(fed_by)}) AS {_quoted(name)}")
    return merged.sparkSession.sql(f"SELECT {', '.join(out)} FROM {{merged}} {views}", merged=merged)
