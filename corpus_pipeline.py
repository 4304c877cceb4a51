"""Corpus pipeline: language ID, toxicity, near copies, repeated passages, packing.

Each stage takes what the one before it kept, written as Parquet and read again, so a stage
that fails is run again from its input and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgloom.llm import langid, packing, simhash, substring, toxicity
from kgloom.llm.bpe import public_path
from kgloom.session import materialized

#: a language that is less likely than this is no finding
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found: no text, no letter or no likely language means rejection."""
    found = langid.predict(docs, langid.learned(docs))
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(known).select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.predict(docs, toxicity.learned(docs, labels)).where("predicted = 0").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that others repeat; untouched texts stay as they are, and a document of which
    nothing is left goes."""
    found = substring.without_repeats(docs).where("n_removed < n_words")
    cut = F.col("n_removed") > 0
    changed = {"text": F.when(cut, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed["n_chars"] = F.when(cut, F.length("kept").cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns(changed).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    return packing.pack(docs, public_path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language_id),
    ("toxicity", toxicity_filter),
    ("near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: no SQL expresses the classifiers, the fingerprints or the tokens
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
