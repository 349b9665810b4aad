from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wattspindle.operators import windows
from wattspindle.plans import marts, reports
from wattspindle.schemas import DAILY_METRICS, MACHINE_DAILY, MACHINE_SUMMARY, SILVER


def silver_row(ts, x=1.0, bad=False, price=10.0, power=1.0, machine="M01", op="OP00"):
    return (ts, machine, op, x, 0.0, 0.0, bad, price, 100.0, power, power * price / 1000, float(bad))


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


DAY = dt.datetime(2020, 1, 1)


def test_stage_bounds_are_closed_at_midnight(spark):
    last = dt.datetime(2021, 8, 31)
    rows = [silver_row(t) for t in (last, last + dt.timedelta(seconds=1), dt.datetime(2019, 2, 1))]
    staged = marts.stage(silver(spark, rows), "2019-02-01", "2021-08-31")
    assert {r["timestamp_15min"] for r in staged.collect()} == {last, dt.datetime(2019, 2, 1)}
    assert marts.stage(silver(spark, rows)).count() == 3


def test_daily_metrics_count_anomalies_and_survive_zero_power(spark):
    rows = [silver_row(DAY + dt.timedelta(minutes=15 * i), bad=i == 0, power=0.0) for i in range(20)]
    facts = marts.daily_facts(marts.daily_metrics(silver(spark, rows)))
    row = facts.first()
    assert (row["total_measurements"], row["anomaly_count"], row["anomaly_rate_pct"]) == (20, 1, 5.0)
    assert row["machine_health_status"] == "LOW_RISK"
    assert row["cost_per_kwh"] is None
    assert row["measurement_date"] == DAY.date()


def test_missing_anomaly_flag_is_not_an_anomaly(spark):
    base = [silver_row(DAY, bad=True), silver_row(DAY, bad=False)]
    df = silver(spark, base).withColumn(
        "has_anomaly", F.when(F.col("anomaly_risk_score") == 1.0, True)
    )
    assert marts.daily_metrics(df).first()["anomaly_count"] == 1


def test_stability_classes_split_at_fleet_percentiles(spark):
    rows = [silver_row(DAY, x=float(i), op=f"OP{i:02d}") for i in range(1, 6)]
    facts = marts.daily_facts(marts.daily_metrics(silver(spark, rows)))
    found = {r["operation"]: r["vibration_stability"] for r in facts.collect()}
    assert found == {
        "OP01": "STABLE", "OP02": "STABLE", "OP03": "MODERATE", "OP04": "UNSTABLE", "OP05": "UNSTABLE",
    }


def test_summary_totals_equal_daily_totals_and_average_days_unweighted(spark):
    rows = [silver_row(DAY, x=1.0)] * 3 + [silver_row(DAY + dt.timedelta(days=1), x=5.0, bad=True)]
    summary = marts.machine_summary(marts.daily_metrics(silver(spark, rows))).first()
    assert summary["total_measurements"] == 4
    assert summary["days_with_data"] == 2
    assert summary["overall_avg_vibration_x"] == 3.0
    assert summary["overall_anomaly_rate"] == 25.0
    assert summary["risk_level"] == "HIGH_RISK"


def test_every_daily_row_has_one_class(spark):
    rows = [
        silver_row(DAY + dt.timedelta(hours=i), x=float(i % 7), bad=i % 5 == 0, op=f"OP{i % 4:02d}")
        for i in range(200)
    ]
    facts = marts.daily_facts(marts.daily_metrics(silver(spark, rows)))
    distribution = reports.health_distribution(facts)
    total = distribution.agg(F.sum("days").alias("n")).first()["n"]
    assert total == facts.count()
    assert facts.where("machine_health_status IS NULL OR vibration_stability IS NULL").count() == 0


def test_dominant_class_ties_go_to_the_first_name(spark):
    facts = spark.createDataFrame(
        [("M01", "OP00", s) for s in ("UNSTABLE", "STABLE", "UNSTABLE", "STABLE", "MODERATE")],
        "machine_id string, operation string, vibration_stability string",
    )
    row = reports.dominant_stability(facts).first()
    assert (row["dominant_stability"], row["share_pct"]) == ("STABLE", 40.0)


def test_selection_values_are_data_not_sql(spark):
    facts = spark.createDataFrame([("M01", "OP00")], "machine_id string, operation string")
    assert reports.select_unit(facts, "M01' OR '1'='1").count() == 0
    assert reports.select_unit(facts).count() == 1
    assert reports.select_unit(facts, "M01", "OP00").count() == 1


def test_empty_table_gives_an_empty_fact_table(spark):
    assert marts.daily_facts(marts.daily_metrics(silver(spark, []))).count() == 0


def test_windows_take_the_highest_label_and_no_label_is_normal(spark):
    rows = [(DAY, 1.0, 0), (DAY, 3.0, None), (DAY, 5.0, 1), (DAY + dt.timedelta(hours=1), 1.0, None)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, rms_x double, label int").select(
        "*",
        F.col("rms_x").alias("rms_y"),
        F.col("rms_x").alias("rms_z"),
        F.lit("M01").alias("machine_id"),
        F.lit("OP00").alias("operation"),
    )
    rows = windows.telemetry_windows(df).orderBy("window_start").collect()
    assert [(r["avg_rms_x"], r["has_anomaly"]) for r in rows] == [(3.0, 1), (1.0, 0)]


def test_approximate_percentiles_are_opt_in(spark):
    rows = [silver_row(DAY, x=float(i), op=f"OP{i:02d}") for i in range(1, 6)]
    daily = marts.daily_metrics(silver(spark, rows))
    exact = marts.daily_facts(daily).select("operation", "vibration_stability").collect()
    rough = marts.daily_facts(daily, accuracy=1000).select("operation", "vibration_stability").collect()
    assert sorted(exact) == sorted(rough)


def test_load_time_is_filled(spark):
    assert marts.with_load_time(spark.range(1)).first()["loaded_at"] is not None


def test_mart_schemas_are_as_declared(spark):
    def typed(struct):
        return [(f.name, f.dataType) for f in struct.fields]

    daily = marts.daily_metrics(silver(spark, [silver_row(DAY)]))
    facts = marts.with_load_time(marts.daily_facts(daily), "created_at")
    assert typed(daily.schema) == typed(DAILY_METRICS)
    assert typed(facts.schema) == typed(MACHINE_DAILY)
    assert typed(marts.machine_summary(facts).schema) == typed(MACHINE_SUMMARY)


def test_a_flat_series_has_no_correlation(spark):
    rows = [
        ("M01", "OP00", 1.0, 2.0, 5.0), ("M01", "OP00", 1.0, 3.0, 6.0),
        ("M02", "OP00", 1.0, 2.0, 4.0), ("M02", "OP00", 2.0, 4.0, 2.0), ("M02", "OP00", 9.0, None, 7.0),
        ("M03", "OP00", 1.0, 2.0, None),
    ]
    columns = "machine_id string, operation string, vibration_magnitude double, daily_energy_cost double, anomaly_rate_pct double"
    found = reports.cost_vibration_corr(spark.createDataFrame(rows, columns)).collect()
    by_unit = {r.machine_id: (r.magnitude_cost_corr, r.rate_cost_corr) for r in found}
    assert by_unit["M01"][0] is None and abs(by_unit["M01"][1] - 1) < 1e-12
    assert abs(by_unit["M02"][0] - 1) < 1e-12 and abs(by_unit["M02"][1] + 1) < 1e-12
    assert by_unit["M03"] == (None, None)
