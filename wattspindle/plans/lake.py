"""The batch run: inputs to bronze, silver and mart tables under one root."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspindle.functions.risk import half_up
from wattspindle.operators.chunking import chunk_features
from wattspindle.operators.harmonize import harmonize_windows, silver
from wattspindle.operators.windows import first_price_per_window, rollup_chunks, telemetry_windows
from wattspindle.paths import LakePaths
from wattspindle.plans import ledger as ledgers
from wattspindle.plans import marts
from wattspindle.plans.ledger import Ledger
from wattspindle.schemas import (
    BRONZE_INDUSTRIAL,
    BRONZE_PRICES,
    BRONZE_TELEMETRY,
    DAILY_METRICS,
    MACHINE_DAILY,
    MACHINE_SUMMARY,
    SILVER,
    conform,
)
from wattspindle.session import setting
from wattspindle.sources import sinks
from wattspindle.sources.readers import read_parquet

BY_UNIT = ["machine_id", "operation"]
BATCH_ROWS_KEY = "spark.sql.parquet.columnarReaderBatchSize"
RECORDINGS_PER_BATCH = "32"


def _compact(ledger: Ledger, stage: str, rows: DataFrame, path: str) -> None:
    measures = {**ledgers.period("timestamp_15min"), **ledgers.fleet()}
    ledger.save(
        stage,
        lambda measured: sinks.write_compact(rows, path, BY_UNIT, "timestamp_15min", measured=measured),
        measures,
    )


def _flat(ledger: Ledger, stage: str, rows: DataFrame, path: str) -> None:
    ledger.save(stage, lambda measured: sinks.overwrite_flat(rows, path, measured))


def write_bronze(
    ledger: Ledger, paths: LakePaths, signals: DataFrame, prices: DataFrame, index: DataFrame
) -> None:
    """Recordings to 15-minute telemetry, plus prices and index as given."""
    telemetry = conform(rollup_chunks(chunk_features(signals)), BRONZE_TELEMETRY)
    # One recording holds 100,000 samples and more per axis. The scan decodes
    # this many rows at a time, so the default of 4096 would need gigabytes.
    with setting(signals.sparkSession, BATCH_ROWS_KEY, RECORDINGS_PER_BATCH):
        _compact(ledger, "bronze.telemetry", telemetry, paths.bronze("telemetry"))
    _flat(ledger, "bronze.prices", conform(prices, BRONZE_PRICES, strict=False), paths.bronze("prices"))
    _flat(ledger, "bronze.industrial", conform(index, BRONZE_INDUSTRIAL, strict=False), paths.bronze("industrial"))


def write_silver(
    spark: SparkSession, ledger: Ledger, paths: LakePaths, fill: str | None = "mean", country: str | None = None
) -> None:
    harmonized = silver(
        read_parquet(spark, paths.bronze("telemetry"), BRONZE_TELEMETRY),
        read_parquet(spark, paths.bronze("prices"), BRONZE_PRICES),
        read_parquet(spark, paths.bronze("industrial"), BRONZE_INDUSTRIAL),
        fill,
        country,
    )
    _compact(ledger, "silver", harmonized, paths.silver())


def write_marts(
    spark: SparkSession, ledger: Ledger, paths: LakePaths, first: str | None = None, last: str | None = None
) -> None:
    """Each model reads the written table of the one before, beginning with the staged rows."""
    rows = marts.with_load_time(marts.stage(read_parquet(spark, paths.silver(), SILVER), first, last))
    _flat(ledger, "staged", rows, paths.mart("staged"))
    staged = read_parquet(spark, paths.mart("staged"), rows.schema)
    daily_path, facts_path = paths.mart("daily_metrics"), paths.mart("machine_daily")
    _flat(ledger, "daily_metrics", conform(marts.daily_metrics(staged), DAILY_METRICS), daily_path)
    facts = marts.daily_facts(read_parquet(spark, daily_path, DAILY_METRICS))
    stamped = marts.with_load_time(facts, "created_at")
    _flat(ledger, "machine_daily", conform(stamped, MACHINE_DAILY), facts_path)
    summary = marts.machine_summary(read_parquet(spark, facts_path, MACHINE_DAILY))
    _flat(ledger, "machine_summary", conform(summary, MACHINE_SUMMARY), paths.mart("machine_summary"))


def run_batch(
    spark: SparkSession,
    root: str,
    signals: DataFrame,
    prices: DataFrame,
    index: DataFrame,
    first: str | None = None,
    last: str | None = None,
    fill: str | None = "mean",
    country: str | None = None,
    run: str | None = None,
) -> LakePaths:
    """All layers, in order. A rerun replaces every table and adds to the ledger.

    ``first`` and ``last`` bound what is staged, all rows by default. ``country`` chooses
    the market and the index; it may be left out where the inputs have one country only.
    The ledger has an entry for every table, under the name ``run`` or one of its own.
    """
    paths = LakePaths(root)
    ledger = Ledger(spark, paths.ledger(), run or uuid.uuid4().hex)
    write_bronze(ledger, paths, signals, prices, index)
    write_silver(spark, ledger, paths, fill, country)
    write_marts(spark, ledger, paths, first, last)
    return paths


def append_batch(
    paths: LakePaths,
    features: DataFrame,
    prices: DataFrame,
    fill: str | None = "ffill",
    country: str | None = None,
) -> None:
    """Add one batch of feature rows, prices and harmonised windows to bronze."""
    sinks.append_partitioned(features, paths.bronze("features"), ["machine_id"])
    sinks.append_flat(prices, paths.bronze("price_batches"))
    harmonized = harmonize_windows(telemetry_windows(features), prices, fill, country)
    sinks.append_partitioned(harmonized, paths.bronze("harmonized"), BY_UNIT)


def write_price_windows(quotes: DataFrame, path: str) -> None:
    """Quotes at two decimals to the first price of every 15-minute window."""
    rounded = quotes.withColumn("price_eur_mwh", half_up(F.col("price_eur_mwh"), 2))
    sinks.overwrite_flat(first_price_per_window(rounded), path)
