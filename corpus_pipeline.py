"""A corpus pipeline: language, near-duplicates, repeated passages, mix, sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspindle.llm import langid, mixing, packing, simhash, substring_dedup
from wattspindle.llm.common import Table, ship_code


def _apart(docs: DataFrame, names: set[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns renamed that a stage's own would replace, and a function that
    gives a stage's result the columns of ``docs`` again."""
    hidden = {c: f"__kept_{i}" for i, c in enumerate(docs.columns) if c.lower() in names}

    def restored(found: DataFrame) -> DataFrame:
        return found.select(*[F.col(f"`{hidden.get(c, c)}`").alias(c) for c in docs.columns])

    return docs.withColumnsRenamed(hidden), restored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with nothing in common with any learned language, go.

    Where nothing can be learned, because no row has a language, none are judged by it.
    """
    profiles = langid.learn(docs)
    given, restored = _apart(docs, {"lang_pred", "score"})
    found = langid.identify(given, profiles)
    known = F.col("score") > 0 if profiles.languages else F.lit(True)
    return restored(found.where(known))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows go; ``n_chars``, if there, follows the text where it changed."""
    given, restored = _apart(docs, {"n_words", "n_removed", "kept_sha256"})
    found = substring_dedup.remove_repeats(given)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", n_chars)
    return restored(found)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of fixed length."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", repeats),
    ("mixing", mix),
    ("best_fit_packing", sequences),
]

#: Fingerprints, profiles and tokens have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    ship_code(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = Table(stage(spark, docs, sf_dir), name).df
    return docs
