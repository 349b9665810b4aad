"""Silver to marts: staging, daily metrics, daily facts, period summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattspindle.constants import STABILITY_PERCENTILES
from wattspindle.functions import risk, signal
from wattspindle.operators.lookups import attach_one_row
from wattspindle.operators.quantiles import exact_quantiles

AXES = ("x", "y", "z")
DAILY_KEY = ["measurement_date", "machine_id", "operation"]
UNIT_KEY = ["machine_id", "operation"]


def stage(silver: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows within the closed timestamp range; a missing bound keeps everything on its side.

    A bare date as ``last`` means its midnight, so the rest of that day is out.
    """
    ts = F.col("timestamp_15min")
    if first is not None:
        silver = silver.where(ts >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        silver = silver.where(ts <= F.lit(last).cast("timestamp_ntz"))
    return silver


def with_load_time(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def daily_metrics(staged: DataFrame) -> DataFrame:
    """One row per day, machine and operation."""
    total = F.count(F.lit(1))
    anomalies = F.count_if(F.col("has_anomaly"))
    mean = {a: F.avg(f"vibration_rms_{a}") for a in AXES}
    price = F.col("energy_price_eur_mwh")
    return staged.groupBy(
        F.to_date("timestamp_15min").alias("measurement_date"), *UNIT_KEY
    ).agg(
        total.alias("total_measurements"),
        anomalies.alias("anomaly_count"),
        risk.rate_pct(anomalies, total).alias("anomaly_rate_pct"),
        *[mean[a].alias(f"avg_vibration_{a}") for a in AXES],
        *[F.max(f"vibration_rms_{a}").alias(f"max_vibration_{a}") for a in AXES],
        signal.magnitude(*mean.values()).alias("vibration_magnitude"),
        F.avg(price).alias("avg_energy_price"),
        F.min(price).alias("min_energy_price"),
        F.max(price).alias("max_energy_price"),
        F.sum("energy_cost_eur").alias("daily_energy_cost"),
        F.avg("estimated_power_kwh").alias("avg_power_consumption"),
        F.avg("industrial_production_index").alias("avg_industrial_index"),
        F.avg("anomaly_risk_score").alias("avg_anomaly_risk"),
    )


def with_health(daily: DataFrame) -> DataFrame:
    return daily.withColumn("machine_health_status", risk.daily_health(F.col("anomaly_rate_pct")))


def with_unit_cost(daily: DataFrame) -> DataFrame:
    cost = risk.daily_unit_cost(F.col("daily_energy_cost"), F.col("avg_power_consumption"))
    return daily.withColumn("cost_per_kwh", cost)


def with_stability(daily: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Stability class against the percentiles over all rows of ``daily``.

    ``daily`` is read several times and should be a written table. ``accuracy``
    opts in to sketched percentiles.
    """
    bounds = exact_quantiles(daily, "vibration_magnitude", STABILITY_PERCENTILES, accuracy)
    grade = risk.stability(F.col("vibration_magnitude"), F.col("p50"), F.col("p75"))
    return (
        attach_one_row(daily, bounds)
        .withColumn("vibration_stability", grade)
        .drop(*STABILITY_PERCENTILES)
    )


def daily_facts(daily: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Daily metrics with health class, stability class and unit cost."""
    return with_unit_cost(with_stability(with_health(daily), accuracy))


def machine_summary(facts: DataFrame) -> DataFrame:
    """One row per machine and operation. Means are over days, unweighted.

    Reads daily metrics only, so daily facts and plain daily metrics both serve.
    """
    return (
        facts.groupBy(*UNIT_KEY)
        .agg(
            F.min("measurement_date").alias("first_measurement"),
            F.max("measurement_date").alias("last_measurement"),
            F.count_distinct("measurement_date").alias("days_with_data"),
            F.sum("total_measurements").alias("total_measurements"),
            F.sum("anomaly_count").alias("total_anomalies"),
            risk.rate_pct(F.sum("anomaly_count"), F.sum("total_measurements")).alias(
                "overall_anomaly_rate"
            ),
            *[F.avg(f"avg_vibration_{a}").alias(f"overall_avg_vibration_{a}") for a in AXES],
            *[F.max(f"max_vibration_{a}").alias(f"peak_vibration_{a}") for a in AXES],
            F.avg("vibration_magnitude").alias("avg_vibration_magnitude"),
            F.avg("avg_energy_price").alias("avg_energy_price_overall"),
            F.sum("daily_energy_cost").alias("total_energy_cost"),
            F.avg("avg_power_consumption").alias("avg_power_consumption_overall"),
            F.avg("avg_industrial_index").alias("avg_industrial_index_overall"),
        )
        .withColumn("risk_level", risk.period_risk(F.col("overall_anomaly_rate")))
    )


def daily_trend(facts: DataFrame, days: int = 7) -> DataFrame:
    """Change against the previous recorded day and a trailing mean, per unit.

    Daily rows of one unit are bounded by the calendar, so a window per unit is safe.
    """
    order = Window.partitionBy(*UNIT_KEY).orderBy("measurement_date")
    trailing = order.rowsBetween(1 - days, Window.currentRow)
    return facts.select(
        *DAILY_KEY,
        "anomaly_rate_pct",
        "vibration_magnitude",
        (F.col("anomaly_rate_pct") - F.lag("anomaly_rate_pct").over(order)).alias("rate_change"),
        F.avg("vibration_magnitude").over(trailing).alias("trailing_magnitude"),
    )
