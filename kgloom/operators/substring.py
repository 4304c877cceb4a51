"""Substring-of-any matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .keys import own_shuffle


# Length of the pieces that are counted; shorter patterns are looked up whole.
GRAM = 5


def ids_containing(ids: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct ``id`` values that contain any ``id`` of an unbounded pattern set.

    Pieces of a few characters (grams) are counted over the distinct ids, and
    each pattern is looked up by that of its own grams which the ids hold least
    often: shared beginnings, such as the prefixes of identifiers, never lead to
    a candidate. A pattern with a gram that no id holds is out at once. Where an
    id holds an anchor, the stretches that its patterns would take up there (a
    few pairs of offset and length, however many patterns share them) are cut
    out and matched with the patterns on equality; no id is compared with every
    pattern.
    """
    wanted = patterns.select(named("id").alias("__piece")).where("__piece is not null").distinct()
    wanted = wanted.withColumn("__size", F.length("__piece"))
    # lengths of the patterns shorter than a gram: a few numbers
    short = wanted.where(F.col("__size") < GRAM).agg(F.collect_set("__size")).scalar()
    texts = ids.select("id").where("id is not null").distinct()
    counted = _grams(texts.withColumn("__lengths", F.array(F.lit(GRAM))), "id").groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.select(own_shuffle(F.col("__gram")).alias("__counted"), "__n")
    own = _grams(wanted.withColumn("__lengths", F.array(F.lit(GRAM))), "__piece", "__size")
    own = own.join(counted, F.col("__gram") == F.col("__counted"))
    place = F.struct("__gram", (F.col("__place") - 1).alias("__offset"))
    rarest = F.min_by(place, F.struct("__n", "__gram", "__place")).alias("__anchor")
    anchors = own.groupBy("__piece", "__size").agg(rarest, F.count(F.lit(1)).alias("__held"))
    anchors = anchors.where(F.col("__held") == F.col("__size") - GRAM + 1).select("__anchor.*", "__size")
    whole = wanted.where(F.col("__size") < GRAM).select(F.col("__piece").alias("__gram"), F.lit(0).alias("__offset"), "__size")
    shapes = anchors.unionAll(whole).groupBy("__gram").agg(F.collect_set(F.struct("__offset", "__size")).alias("__shapes"))
    shapes = shapes.select(own_shuffle(F.col("__gram")).alias("__wanted_gram"), "__shapes")
    # a frequent gram only grows the left side
    begins = _grams(texts.withColumn("__lengths", F.concat(short, F.array(F.lit(GRAM)))), "id")
    met = begins.join(shapes, F.col("__gram") == F.col("__wanted_gram")).select("id", "__place", F.inline("__shapes"))
    met = met.withColumn("__start", F.col("__place") - F.col("__offset"))
    met = met.where((F.col("__start") >= 1) & (F.col("__start") + F.col("__size") <= F.length("id") + 1))
    pieces = met.select("id", F.substring("id", F.col("__start"), F.col("__size")).alias("__piece"))
    wanted = wanted.select(own_shuffle(F.col("__piece")).alias("__wanted"))
    return pieces.join(wanted, F.col("__piece") == F.col("__wanted"), "left_semi").select("id").distinct()


def _grams(df: DataFrame, text: str, *beside: str) -> DataFrame:
    """(text, others, __place, __gram): the pieces of a text at every place in the lengths listed in ``__lengths``; one of
    no length is at the first place."""
    at_place = df.select(text, *beside, "__lengths", F.explode(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))).alias("__place"))
    each = at_place.select(text, *beside, "__place", F.explode("__lengths").alias("__length"))
    fits = (F.col("__place") + F.col("__length") <= F.length(text) + 1) & ((F.col("__length") > 0) | (F.col("__place") == 1))
    return each.where(fits).select(text, *beside, "__place", F.substring(text, F.col("__place"), F.col("__length")).alias("__gram"))
