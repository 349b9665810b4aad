"""Reads on the marts: summaries, drill-downs, KPIs, inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattspindle.functions import risk
from wattspindle.operators.lookups import lookup_join
from wattspindle.plans.marts import UNIT_KEY

SUMMARY_COLUMNS = [
    *UNIT_KEY,
    "days_with_data",
    "total_measurements",
    "total_anomalies",
    "overall_anomaly_rate",
    *[f"overall_avg_vibration_{a}" for a in ("x", "y", "z")],
    *[f"peak_vibration_{a}" for a in ("x", "y", "z")],
    "avg_vibration_magnitude",
    "avg_energy_price_overall",
    "total_energy_cost",
    "avg_power_consumption_overall",
    "avg_industrial_index_overall",
    "risk_level",
]

DRILLDOWN_COLUMNS = [
    "measurement_date",
    *UNIT_KEY,
    "total_measurements",
    "anomaly_count",
    "anomaly_rate_pct",
    *[f"avg_vibration_{a}" for a in ("x", "y", "z")],
    *[f"max_vibration_{a}" for a in ("x", "y", "z")],
    "vibration_magnitude",
    "avg_energy_price",
    "daily_energy_cost",
    "avg_power_consumption",
    "avg_industrial_index",
    "machine_health_status",
    "vibration_stability",
    "cost_per_kwh",
]


def summary_report(summary: DataFrame) -> DataFrame:
    return summary.select(*SUMMARY_COLUMNS).orderBy(*UNIT_KEY)


def select_unit(
    facts: DataFrame, machine_id: str | None = None, operation: str | None = None
) -> DataFrame:
    """Rows of one machine and/or operation; None keeps all."""
    for column, wanted in (("machine_id", machine_id), ("operation", operation)):
        if wanted is not None:
            facts = facts.where(F.col(column) == F.lit(wanted))
    return facts


def daily_drilldown(
    facts: DataFrame, machine_id: str | None = None, operation: str | None = None
) -> DataFrame:
    """Daily facts of a selection, newest first."""
    rows = select_unit(facts, machine_id, operation).select(*DRILLDOWN_COLUMNS)
    return rows.orderBy(F.desc("measurement_date"), *UNIT_KEY)


def daily_table(facts: DataFrame) -> DataFrame:
    """Display form: dates as text, numbers at two decimals."""
    numbers = ["anomaly_rate_pct", "vibration_magnitude", "daily_energy_cost", "avg_power_consumption"]
    return facts.select(
        F.date_format("measurement_date", "yyyy-MM-dd").alias("measurement_date"),
        *UNIT_KEY,
        *[risk.half_up(F.col(c), 2).alias(c) for c in numbers],
        "machine_health_status",
    )


def machine_choices(summary: DataFrame) -> DataFrame:
    return summary.select("machine_id").distinct().orderBy("machine_id")


def operation_choices(summary: DataFrame, machine_id: str) -> DataFrame:
    picked = select_unit(summary, machine_id)
    return picked.select("operation").distinct().orderBy("operation")


def health_distribution(facts: DataFrame) -> DataFrame:
    """Days per health class and their share, per unit."""
    counts = facts.groupBy(*UNIT_KEY, "machine_health_status").agg(F.count(F.lit(1)).alias("days"))
    # A unit has one counted row per class, so its window is a handful of rows.
    all_days = F.sum("days").over(Window.partitionBy(*UNIT_KEY))
    return counts.select(
        *UNIT_KEY,
        "machine_health_status",
        "days",
        risk.rate_pct(F.col("days"), all_days).alias("share_pct"),
    )


def dominant_stability(facts: DataFrame) -> DataFrame:
    """Most common stability class per unit and its share; ties go to the first name."""
    counts = facts.groupBy(*UNIT_KEY, "vibration_stability").agg(F.count(F.lit(1)).alias("days"))
    ranked = F.struct((-F.col("days")).alias("rank"), F.col("vibration_stability").alias("name"))
    return (
        counts.groupBy(*UNIT_KEY)
        .agg(F.min(ranked).alias("top"), F.sum("days").alias("all_days"))
        .select(
            *UNIT_KEY,
            F.col("top.name").alias("dominant_stability"),
            risk.rate_pct(-F.col("top.rank"), F.col("all_days")).alias("share_pct"),
        )
    )


def fleet_kpis(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if(F.col("risk_level") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("risk_level") == "HIGH_RISK").alias("high_risk_count"),
        F.avg("overall_anomaly_rate").alias("avg_anomaly_rate"),
        F.avg("avg_vibration_magnitude").alias("avg_vibration"),
        F.sum("total_energy_cost").alias("total_cost"),
    )


def machine_kpis(summary: DataFrame) -> DataFrame:
    """Key figures of every unit, with cost per unit of power over the period."""
    return summary.select(
        *UNIT_KEY,
        "days_with_data",
        "total_anomalies",
        "total_measurements",
        "overall_anomaly_rate",
        "avg_vibration_magnitude",
        "total_energy_cost",
        "avg_power_consumption_overall",
        "avg_industrial_index_overall",
        risk.period_unit_cost(
            F.col("total_energy_cost"),
            F.col("avg_power_consumption_overall"),
            F.col("days_with_data"),
        ).alias("cost_per_kwh"),
    )


def risk_recommendations(summary: DataFrame, actions: DataFrame) -> DataFrame:
    """What to do about each unit: its class joined with the caller's table of actions.

    ``actions`` has one row per ``risk_level``; its other columns are up to the caller.
    A class without an action keeps its row.
    """
    return lookup_join(summary.select(*UNIT_KEY, "risk_level"), actions, "risk_level")


def daily_vs_average(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Each day against the period average of its unit. ``summary`` is a written table."""
    averages = summary.select(*UNIT_KEY, "overall_anomaly_rate", "avg_vibration_magnitude")
    return lookup_join(facts, averages, UNIT_KEY, "inner").select(
        "measurement_date",
        *UNIT_KEY,
        "anomaly_rate_pct",
        "overall_anomaly_rate",
        (F.col("anomaly_rate_pct") - F.col("overall_anomaly_rate")).alias("rate_deviation"),
        "vibration_magnitude",
        "avg_vibration_magnitude",
        (F.col("vibration_magnitude") - F.col("avg_vibration_magnitude")).alias(
            "magnitude_deviation"
        ),
    )


def cost_vibration_scatter(facts: DataFrame) -> DataFrame:
    """Points of the two scatter views with their size and colour dimensions."""
    return facts.select(
        "measurement_date",
        *UNIT_KEY,
        "vibration_magnitude",
        "daily_energy_cost",
        "anomaly_rate_pct",
        "avg_power_consumption",
        "machine_health_status",
        "vibration_stability",
    )


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over the rows that have both values; NULL where one of them
    never changes, as it has no correlation with anything then."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def cost_vibration_corr(facts: DataFrame) -> DataFrame:
    """Correlation of cost with magnitude and with anomaly rate, per unit."""
    return facts.groupBy(*UNIT_KEY).agg(
        correlation("vibration_magnitude", "daily_energy_cost").alias("magnitude_cost_corr"),
        correlation("anomaly_rate_pct", "daily_energy_cost").alias("rate_cost_corr"),
    )


def dataset_inventory(runs: DataFrame) -> DataFrame:
    """Files, anomalous files, normal files and samples per machine and operation."""
    return runs.groupBy(*UNIT_KEY).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.sum("label").alias("anomalies"),
        (F.count(F.lit(1)) - F.sum("label")).alias("normal"),
        F.sum("sample_count").alias("total_samples"),
    )


def inventory_pivot(inventory: DataFrame, machines: list[str] | None = None) -> DataFrame:
    """Files per operation (rows) and machine (columns), absent pairs as 0.

    Every machine of the inventory has a column. ``machines`` sets the order of those it
    names; others follow by name.
    """
    found = {r.machine_id for r in inventory.select("machine_id").distinct().collect()}
    named = [m for m in machines or [] if m in found]
    columns = named + sorted((found - set(named)), key=str)
    counts = inventory.groupBy("operation").pivot("machine_id", columns).agg(F.sum("total_files"))
    return counts.na.fill(0)


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """Grand totals over the whole inventory."""
    measures = ["total_files", "anomalies", "total_samples"]
    return inventory.agg(*[F.sum(c).alias(c) for c in measures])


def coverage_matrix(inventory: DataFrame) -> DataFrame:
    """Every machine with every operation, and whether the pair has data.

    The operations of the fleet are one array, taken from the aggregated
    inventory, that every machine spreads into rows.
    """
    operations = inventory.agg(F.collect_set("operation")).scalar()
    machines = inventory.select("machine_id").distinct()
    pairs = machines.withColumn("all", operations).select(
        "machine_id", F.explode("all").alias("operation")
    )
    return pairs.join(inventory, UNIT_KEY, "left").select(
        *UNIT_KEY,
        F.coalesce("total_files", F.lit(0)).alias("total_files"),
        F.col("total_files").isNotNull().alias("has_data"),
    )


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes; the quartiles come from ``exact_quantiles``."""
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
