"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from wattspindle.operators import chunking, harmonize, windows
from wattspindle.plans import marts
from wattspindle.plans.catalog import QUERIES
from wattspindle.session import materialize
from wattspindle.sources import adapters, messages


@pytest.fixture
def plan(capsys):
    def show(df, mode="formatted"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out

    return show


def test_rollup_shuffles_once_and_combines_before_the_shuffle(spark, sf_dir, plan):
    text = plan(windows.telemetry_windows(adapters.telemetry(spark, sf_dir)))
    assert text.count("partial_avg(rms_x") == 1
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_scan_reads_only_needed_columns_and_gets_the_filter(spark, sf_dir, plan):
    text = plan(QUERIES["price_batches_union"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "event_type", "value"}
    text = plan(adapters.price_quotes(spark, sf_dir).select("timestamp", "price_eur_mwh"))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "value"}


def test_silver_input_uses_hash_aggregation_and_skips_json(spark, sf_dir, plan):
    rollup = windows.rollup_chunks(adapters.telemetry_chunks(spark, sf_dir))
    text = plan(rollup.drop("sample_file", "total_samples"))
    assert "SortAggregate" not in text
    assert "props" not in text


def test_silver_joins_are_broadcast_only_after_a_size_check(spark, sf_dir, plan, monkeypatch):
    def joins():
        silver = harmonize.silver(
            adapters.silver_telemetry(spark, sf_dir),
            adapters.hourly_prices(spark, sf_dir),
            adapters.current_industrial(spark, sf_dir),
            country="DE",
        )
        return plan(silver)

    small = joins()
    assert "BroadcastHashJoin" in small
    assert "NestedLoop" not in small and "Cartesian" not in small
    monkeypatch.setattr("wattspindle.operators.lookups.lookup_join.__defaults__", ("left", None, 1))
    monkeypatch.setattr("wattspindle.operators.lookups.broadcast_bytes.__defaults__", (1,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = joins()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_facts_attach_percentiles_without_a_join(spark, sf_dir, plan):
    daily = materialize(
        marts.daily_metrics(
            harmonize.silver(
                adapters.silver_telemetry(spark, sf_dir),
                adapters.hourly_prices(spark, sf_dir),
                adapters.current_industrial(spark, sf_dir),
                country="DE",
            )
        ),
        "daily",
    )
    top = plan(marts.daily_facts(daily)).split("===== Subqueries =====")[0]
    assert "Join" not in top and "Exchange" not in top


def test_messages_are_parsed_once(spark, sf_dir, plan):
    parsed = messages.parse_messages(adapters.raw_messages(spark, sf_dir))
    text = plan(messages.describe_messages(parsed), "simple")
    assert text.count("from_json") == 1


def test_blocks_carry_only_their_own_samples(spark, sf_dir, plan):
    signals = materialize(adapters.signals(spark, sf_dir), "signals")
    text = plan(chunking.chunk_signals(signals, 8))
    generate = re.search(r"\(\d+\) Generate\n.*?\nArguments: (.*)", text, re.S).group(1)
    kept = re.search(r"\), \[(.*?)\], (?:true|false)", generate).group(1)
    assert "accel" not in kept
    assert "Exchange" not in text


@pytest.mark.parametrize("name", ["telemetry_window_15min", "signal_features", "filename_parse", "price_xml_parse"])
def test_no_python_workers(spark, sf_dir, plan, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|PythonUDF", text)


def test_skewed_key_join_splits_at_run_time(spark):
    """Far beyond the broadcast bound a hot key still joins completely."""
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("long").alias("k"), "id"
    )
    from wattspindle.operators.lookups import lookup_join

    joined = lookup_join(facts, spark.range(1000).selectExpr("id AS k", "id + 1 AS v"), "k", most=10)
    assert joined.where("v IS NULL OR v <> k + 1").count() == 0
    assert joined.count() == 30_000
