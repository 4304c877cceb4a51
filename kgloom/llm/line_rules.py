"""Quality rules: cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed; the distinct documents of a host (the ``source``) that
hold a line are counted; lines held by more documents than the limit are removed, and a
document that loses more than half of its words with them is rejected. Base rules
(length, repetition) come first.

Line rows are counted by (host, line) with partial aggregation and matched with the frequent
lines by a splittable join; the places of removed lines are gathered by row and joined with
the texts, which are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, table

#: a line in more documents of one host than this is boilerplate
MAX_DOCS = 20
#: a document that loses more than this share of its words is depleted
MAX_LOSS_PERCENT = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_BLANK = r"\A[\x20\x09-\x0D]*\z"
#: positions take the low bits, hashes the rest
_POS_BITS = 31
_POS = (1 << _POS_BITS) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS, -1), lambda w: w != "")


def _recurring(packed: Column) -> Column:
    """Of integers made of a hash and a position, those whose hash is not alone."""

    def keep(s: Column) -> Column:
        def shared(x: Column, i: Column) -> Column:
            own = F.shiftrightunsigned(x, _POS_BITS)
            same = lambda j: F.coalesce(F.shiftrightunsigned(F.get(s, j), _POS_BITS) == own, F.lit(False))
            return same(i + 1) | same(i - 1)

        return F.filter(s, shared)

    return _let(F.sort_array(packed), keep)


def repeated_window_words(word_list: Column) -> Column:
    """Words in three-word windows that occur twice or more in the list, each word once.

    Windows are found by sorting hashes. A hash shares its 64 bits with the position, so
    what the first hash pairs up is judged again by two others.
    """

    def packed(ws: Column, i: Column, salt: int) -> Column:
        hashed = F.xxhash64(F.lit(salt), F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
        return F.shiftleft(hashed, _POS_BITS).bitwiseOR(i.cast("long"))

    def again(ws: Column, found: Column, salt: int) -> Column:
        return _recurring(F.transform(found, lambda x: packed(ws, x.bitwiseAND(F.lit(_POS)).cast("int"), salt)))

    def covered(found: Column) -> Column:
        places = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(F.lit(_POS))))
        steps = lambda at: F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return _let(places, lambda at: F.aggregate(steps(at), F.lit(0).cast("long"), lambda a, x: a + x))

    def count(ws: Column) -> Column:
        windows = F.slice(F.transform(ws, lambda _, i: packed(ws, i, 0)), 1, F.greatest(F.size(ws) - 2, F.lit(0)))
        return _let(again(ws, again(ws, _recurring(windows), 1), 2), covered)

    return _let(word_list, count)


def base_counts(text: Column) -> dict[str, Column]:
    plain = F.coalesce(text, F.lit(""))
    filled = F.filter(F.split(plain, "\n", -1), lambda line: ~line.rlike(_BLANK))
    return {
        "word_chars": F.length(F.translate(plain, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(plain) - F.length(F.translate(plain, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": _let(filled, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "__words": _let(words(plain), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_window_words(w).alias("r"))),
    }


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE_CLASS, " "))


def without_lines(text: Column, places: Column) -> Column:
    """``text`` without its lines at ``places`` (from 0); other lines stay as they are."""

    def kept(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return _let(F.split(text, "\n", -1), kept)


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    max_docs: int = MAX_DOCS,
    max_loss_percent: int = MAX_LOSS_PERCENT,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """Counts, verdict and text without frequent lines (``clean_text``) for each row of ``docs`` (doc_id, text and the host column; others are ignored).

    A null text has no words, fails the base rules and stays null. A null host is a host of its own.
    Repeated rows count as documents each, and each gets its own result.
    """
    text = F.coalesce("text", F.lit(""))
    # two hashes name a row; equal rows share them, and their results
    row = [F.xxhash64(F.lit(i), "doc_id", F.col(host), "text").alias(f"__k{i}") for i in (1, 2)]
    based = docs.select(*row, "doc_id", F.col("text").alias("__text"), *[c.alias(n) for n, c in base_counts(F.col("text")).items()])
    filled = F.filter(
        F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda l: ~l["line"].rlike(_BLANK)
    )
    lines = F.transform(filled, lambda l: F.struct(l["at"].alias("at"), F.xxhash64(normalised(l["line"])).alias("line")))
    rows = docs.select(*row, F.col(host).alias("__host"), F.explode(lines).alias("l")).select("__k1", "__k2", "__host", "l.at", "l.line")
    lines_of = docs.select(
        F.col(host).alias("__host"),
        F.explode(
            F.array_distinct(
                F.transform(
                    F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: ~x.rlike(_BLANK)),
                    lambda x: F.xxhash64(normalised(x)),
                )
            )
        ).alias("line"),
    )
    frequent = lines_of.groupBy("__host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > max_docs)
    # a computed key keeps both inputs straight from a shuffle, so that hot lines can be split at run time
    key = F.xxhash64("__host", "line")
    frequent = frequent.select(key.alias("key"), F.col("__host").alias("host2"), F.col("line").alias("line2"), "n_docs")
    rows = rows.withColumn("key", key)
    same = (
        (rows["key"] == frequent["key"]) & rows["__host"].eqNullSafe(frequent["host2"]) & (rows["line"] == frequent["line2"])
    )
    removed = rows.join(frequent, same).groupBy("__k1", "__k2").agg(F.collect_set("at").alias("__removed"))
    # again a computed key, as equal rows may be many
    named = F.xxhash64("__k1", "__k2")
    removed = removed.select(named.alias("__of"), F.col("__k1").alias("__r1"), F.col("__k2").alias("__r2"), "__removed")
    of_row = (F.col("__own") == F.col("__of")) & (F.col("__k1") == F.col("__r1")) & (F.col("__k2") == F.col("__r2"))
    judged = (
        based.withColumn("__own", named)
        .join(removed, of_row, "left")
        .withColumn("clean_text", F.when(F.col("__removed").isNull(), F.col("__text")).otherwise(without_lines(F.col("__text"), F.col("__removed"))))
        .withColumn("n_words", F.col("__words.n"))
        .withColumn("n_left", F.when(F.col("__removed").isNull(), F.col("n_words")).otherwise(F.size(words(F.col("clean_text")))))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.col("__words.r").alias("n_repeat_words"),
            (F.col("n_words") - F.col("n_left")).alias("n_removed_words"), "clean_text",
        )
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    depleted = 100 * F.col("n_removed_words") > max_loss_percent * F.col("n_words")
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def op9_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("clean_text")


OP9_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT rid, doc_id, source, text, string_split(text, chr(10)) AS all_lines,
    list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM docs
), base AS (
  SELECT rid, doc_id, source, all_lines, ws, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(all_lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS filled FROM split
), grams AS (
  SELECT rid, i, ws[i:i + 2] AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM base)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT rid, count(DISTINCT i + d)::BIGINT AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY rid
), lines AS (
  SELECT rid, source, trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS line,
    len(list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT rid, source, unnest(filled) AS line FROM base)
), frequent AS (
  SELECT source, line FROM lines GROUP BY source, line HAVING count(DISTINCT rid) > 20
), removed AS (
  SELECT rid, sum(n)::BIGINT AS n FROM lines JOIN frequent
    ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.line = frequent.line GROUP BY rid
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS n_removed_words,
    n_words < 50 OR 100 * coalesce(repeats.n, 0) > 50 * n_words AS base_failed
  FROM base LEFT JOIN repeats USING (rid) LEFT JOIN removed USING (rid)
)
SELECT *, NOT base_failed AND NOT 100 * n_removed_words > 50 * n_words AS kept FROM judged
"""
