"""Rollups to the 15-minute and hourly grain. All aggregates merge map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspindle.constants import FALLBACK_SOURCE, WINDOW
from wattspindle.functions import timebase

AXES = ("x", "y", "z")


def telemetry_windows(
    features: DataFrame, ts: str = "timestamp", window: str = WINDOW, slide: str | None = None
) -> DataFrame:
    """Means, peaks and the anomaly flag per window, machine and operation.

    Works on batch and streaming frames alike; a slide makes the windows overlap.
    """
    bounds = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        features.groupBy(bounds.alias("window"), "machine_id", "operation")
        .agg(
            *[F.avg(f"rms_{a}").alias(f"avg_rms_{a}") for a in AXES],
            *[F.max(f"rms_{a}").alias(f"max_rms_{a}") for a in AXES],
            # Records without a label count as normal.
            F.coalesce(F.max("label"), F.lit(0)).alias("has_anomaly"),
            F.count(F.lit(1)).alias("n_records"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "machine_id",
            "operation",
            *[f"avg_rms_{a}" for a in AXES],
            *[f"max_rms_{a}" for a in AXES],
            "has_anomaly",
            "n_records",
        )
    )


def rollup_chunks(chunks: DataFrame) -> DataFrame:
    """Block features to the bronze telemetry grain.

    Blocks count equally, also the short last one of a recording.
    """
    return chunks.groupBy("timestamp_15min", "machine_id", "operation").agg(
        *[F.avg(f"rms_{a}").alias(f"avg_rms_{a}") for a in AXES],
        F.max("label").alias("has_anomaly"),
        F.sum("sample_count").alias("total_samples"),
        F.min("filename").alias("sample_file"),
    )


def first_price_per_window(prices: DataFrame, window: str = WINDOW) -> DataFrame:
    """Earliest quote of each window and country; equal instants resolve to the lowest price."""
    earliest = F.min(F.struct("timestamp", "price_eur_mwh", "source"))
    return (
        prices.groupBy(F.window("timestamp", window).alias("window"), "country_code")
        .agg(earliest.alias("quote"))
        .select(
            F.col("window.start").alias("timestamp"),
            F.col("window.end").alias("window_end"),
            "quote.price_eur_mwh",
            "country_code",
            "quote.source",
        )
    )


def hourly_mean(prices: DataFrame, stand_in: str = FALLBACK_SOURCE) -> DataFrame:
    """One price per hour and country: the mean of its real quotes.

    Quotes from ``stand_in`` count only in hours that have no other. The source is that
    of the quotes used, the first by name where several have been averaged. Quotes merge
    per source before the few rows of an hour meet.
    """
    by_source = prices.groupBy(
        timebase.hour_bucket("timestamp").alias("timestamp"), "country_code", "source"
    ).agg(F.sum("price_eur_mwh").alias("total"), F.count("price_eur_mwh").alias("n"))
    real = (F.coalesce(F.col("source"), F.lit("")) != stand_in) & (F.col("n") > 0)

    def mean(chosen: Column) -> Column:
        return F.try_divide(F.sum(F.when(chosen, F.col("total"))), F.sum(F.when(chosen, F.col("n"))))

    return by_source.groupBy("timestamp", "country_code").agg(
        F.when(F.max(real), F.min(F.when(real, F.col("source")))).otherwise(F.min("source")).alias("source"),
        F.coalesce(mean(real), mean(~real)).alias("price_eur_mwh"),
    )
