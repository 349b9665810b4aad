"""Telemetry, prices and production index on one 15-minute grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspindle.functions import risk, timebase
from wattspindle.operators.asof import asof_join
from wattspindle.operators.lookups import broadcast_bytes, lookup_join
from wattspindle.operators.prices import of_country, price_per_bucket
from wattspindle.schemas import SILVER, conform
from wattspindle.session import materialize


def join_prices(
    telemetry: DataFrame, prices: DataFrame, fill: str | None = "mean", country: str | None = None
) -> DataFrame:
    """Attach ``price_eur_mwh`` of one country by 15-minute bucket.

    ``country`` may be left out where the prices have one country only.
    ``fill``: ``"mean"`` gives windows without a quote the mean over all matched
    windows, ``"ffill"`` carries the latest earlier quote, None leaves NULL. With
    either fill the telemetry is read twice, so callers pass a written table.
    """
    if fill not in ("mean", "ffill", None):
        raise ValueError(f"unknown fill: {fill}")
    quotes = price_per_bucket(prices, country)
    if fill == "ffill":
        # Only the windows that there are ask for a price, and only once each.
        quotes = asof_join(
            telemetry.select("timestamp_15min").distinct(),
            quotes.where(F.col("price_eur_mwh").isNotNull()),
            "timestamp_15min",
            ["price_eur_mwh"],
        )
    lookup = materialize(quotes, "bucket-prices")
    small = broadcast_bytes(lookup) is not None
    joined = lookup_join(telemetry, lookup, "timestamp_15min", small=small)
    return _fill_with_mean(joined, telemetry, lookup, small) if fill == "mean" else joined


def _fill_with_mean(
    joined: DataFrame, telemetry: DataFrame, lookup: DataFrame, small: bool
) -> DataFrame:
    # Rows are counted per bucket first, so the buckets join, not the telemetry.
    counted = telemetry.groupBy("timestamp_15min").agg(F.count(F.lit(1)).alias("n"))
    matched = lookup_join(counted, lookup, "timestamp_15min", "inner", small=small)
    weighted = F.sum(F.col("price_eur_mwh") * F.col("n"))
    mean = matched.agg(F.try_divide(weighted, F.sum(F.when(F.col("price_eur_mwh").isNotNull(), F.col("n"))))).scalar()
    return joined.withColumn("price_eur_mwh", F.coalesce("price_eur_mwh", mean))


def harmonize_windows(
    windows: DataFrame, prices: DataFrame, fill: str | None = "ffill", country: str | None = None
) -> DataFrame:
    """Attach prices to window aggregates by the start of their window."""
    keyed = windows.withColumnRenamed("window_start", "timestamp_15min")
    return join_prices(keyed, prices, fill, country).withColumnRenamed("timestamp_15min", "window_start")


def join_index(
    facts: DataFrame, index: DataFrame, ts: str = "timestamp_15min", country: str | None = None
) -> DataFrame:
    """Attach one country's monthly production index; one value per month, so no row is added.

    ``country`` may be left out where the index has one country only.
    """
    monthly = of_country(index, country).groupBy(timebase.month_key("date").alias("month")).agg(
        F.avg("industrial_production_index").alias("industrial_production_index")
    )
    lookup = materialize(monthly, "monthly-index")
    keyed = facts.withColumn("month", timebase.month_key(ts))
    return lookup_join(keyed, lookup, "month").drop("month")


def enrich(facts: DataFrame) -> DataFrame:
    """Power estimate, cost and risk score, in the silver schema."""
    power = risk.estimated_power(F.col("avg_rms_x"), F.col("avg_rms_y"), F.col("avg_rms_z"))
    named = facts.select(
        "timestamp_15min",
        "machine_id",
        "operation",
        *[F.col(f"avg_rms_{a}").alias(f"vibration_rms_{a}") for a in ("x", "y", "z")],
        F.col("has_anomaly").cast("boolean").alias("has_anomaly"),
        F.col("price_eur_mwh").alias("energy_price_eur_mwh"),
        "industrial_production_index",
        power.alias("estimated_power_kwh"),
        risk.energy_cost(power, F.col("price_eur_mwh")).alias("energy_cost_eur"),
        F.col("has_anomaly").cast("double").alias("anomaly_risk_score"),
    )
    return conform(named, SILVER)


def silver(
    telemetry: DataFrame,
    prices: DataFrame,
    index: DataFrame,
    fill: str | None = "mean",
    country: str | None = None,
) -> DataFrame:
    """Bronze tables to the harmonized silver fact, one row per telemetry row."""
    return enrich(join_index(join_prices(telemetry, prices, fill, country), index, country=country))
