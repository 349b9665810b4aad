"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattspindle.llm import (
    ann,
    embed_dedup,
    html_extract,
    langid,
    line_dedup,
    merkle,
    mixing,
    packing,
    periodic,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from wattspindle.llm.common import read, ship_code
from wattspindle.llm.oracle import ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_dedup.remove_repeats(docs, digest=True)


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = langid.learn(docs)
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.linked(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    machine = toxicity.learn(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    found = toxicity.score(docs, machine)
    return found.select("doc_id", langid.held_out().alias("held_out"), "score", "predicted")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return substring_dedup.remove_repeats(docs, digest=True)


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(read(spark, sf_dir, "documents", *merkle.FIELDS))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    index = line_dedup.LineIndex(spark)
    index.insert(docs)
    return index.clean(docs, digest=True)
