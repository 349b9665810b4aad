from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wattspindle.functions import naming, risk, signal, timebase


def value(spark, column, row="SELECT 1 AS one"):
    return spark.sql(row).select(column.alias("v")).first()["v"]


def test_rms_of_values_empty_and_missing(spark):
    floats = "SELECT CAST(array(3, -4) AS array<float>) AS a, CAST(array() AS array<float>) AS e, " \
             "CAST(NULL AS array<float>) AS n"
    assert value(spark, signal.rms("a"), floats) == pytest.approx(math.sqrt(12.5))
    assert value(spark, signal.rms("e"), floats) == 0.0
    assert value(spark, signal.rms("n"), floats) == 0.0


def test_rms_does_not_hide_a_missing_sample(spark):
    row = "SELECT CAST(array(1, NULL) AS array<float>) AS a"
    assert value(spark, signal.rms("a"), row) is None


def test_peak_and_deviation(spark):
    row = "SELECT CAST(array(1, -5, 3) AS array<float>) AS a, CAST(array(2) AS array<float>) AS b"
    assert value(spark, signal.peak("a", "b"), row) == 5.0
    mean = -1 / 3
    expected = math.sqrt(sum((x - mean) ** 2 for x in (1, -5, 3)) / 3)
    assert value(spark, signal.deviation("a"), row) == pytest.approx(expected)
    assert value(spark, signal.deviation("b"), row) == 0.0


def test_minute_bucket_keeps_zoneless_type_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:44:59.999999' AS ts")
        out = frame.select(
            timebase.minute_bucket("ts").alias("q"), timebase.hour_bucket("ts").alias("h")
        )
        assert [f.dataType.simpleString() for f in out.schema] == ["timestamp_ntz"] * 2
        assert out.first() == (dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 0))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_summer_time_end_maps_two_utc_hours_to_one_local_hour(spark):
    rows = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ '2020-10-25 00:00:00', TIMESTAMP_NTZ '2020-10-25 01:00:00')) AS ts"
    ).select(timebase.market_wall_clock("ts").alias("v"))
    assert {r["v"] for r in rows.collect()} == {dt.datetime(2020, 10, 25, 2, 0)}


def test_malformed_instant_is_null(spark):
    row = "SELECT 'not a time' AS bad, '2020-01-01T10:00:00.5' AS good"
    assert value(spark, timebase.parse_instant("bad"), row) is None
    assert value(spark, timebase.parse_instant("good"), row) == dt.datetime(2020, 1, 1, 10, 0, 0, 500000)


def test_position_instant_uses_resolution(spark):
    row = "SELECT TIMESTAMP_NTZ '2020-01-01 00:00:00' AS start, 3 AS p, 'PT15M' AS q, 'PT60M' AS h"
    quarter = timebase.position_instant(F.col("start"), F.col("p"), F.col("q"))
    hourly = timebase.position_instant(F.col("start"), F.col("p"), F.col("h"))
    assert value(spark, quarter, row) == dt.datetime(2020, 1, 1, 0, 30)
    assert value(spark, hourly, row) == dt.datetime(2020, 1, 1, 2, 0)


def test_period_and_nanos(spark):
    assert value(spark, timebase.parse_period(F.lit("2019-02"))) == dt.date(2019, 2, 1)
    assert value(spark, timebase.parse_period(F.lit("2019-Q1"))) is None
    nanos = F.lit(1_700_000_000_123_456_999)
    assert value(spark, timebase.micros_from_nanos(nanos)) == dt.datetime(
        2023, 11, 14, 22, 13, 20, 123456
    )


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("raw/OP01/good/M01_Aug_2019_OP00_007.h5", ("M01", "OP00", "007", dt.date(2019, 8, 1))),
        ("M02_Feb_2020_OP14.h5", ("M02", "OP14", None, dt.date(2020, 2, 1))),
        ("raw/OP03/M03_Feb2019_001.h5", ("M03", "OP03", "001", dt.date(2019, 2, 1))),
        ("raw/OP03/readme.h5", (None, None, None, None)),
        ("M01_Foo_2019_OP00_007.h5", ("M01", "OP00", "007", None)),
    ],
)
def test_run_names(spark, path, expected):
    files = spark.createDataFrame([(path,)], "path string")
    row = naming.with_run_parts(files).first()
    assert (row["machine_id"], row["operation"], row["run_id"], row["base_date"]) == expected


def test_label_from_path_ignores_case(spark):
    paths = "SELECT explode(array('a/BAD/x', 'a/good/x', 'a/Bad/x')) AS p"
    rows = spark.sql(paths).select(naming.label_from_path("p").alias("v")).collect()
    assert [r["v"] for r in rows] == [1, 0, 1]


def test_zone_codes_pass_unknown_through(spark):
    area = naming.zone_code(naming.market_area(F.lit("DE")))
    assert value(spark, area) == "10Y1001A1001A82H"
    assert value(spark, naming.zone_code(F.lit("XX"))) == "XX"


@pytest.mark.parametrize(
    ("rate", "daily", "period"),
    [
        (5.0, "LOW_RISK", "LOW_RISK"),
        (5.01, "MEDIUM_RISK", "LOW_RISK"),
        (10.0, "MEDIUM_RISK", "MEDIUM_RISK"),
        (20.0, "HIGH_RISK", "MEDIUM_RISK"),
        (20.01, "CRITICAL", "MEDIUM_RISK"),
        (25.0, "CRITICAL", "HIGH_RISK"),
        (40.0, "CRITICAL", "CRITICAL"),
    ],
)
def test_class_bounds(spark, rate, daily, period):
    assert value(spark, risk.daily_health(F.lit(rate))) == daily
    assert value(spark, risk.period_risk(F.lit(rate))) == period


def test_rates_round_half_up_and_survive_zero(spark):
    assert value(spark, risk.rate_pct(F.lit(201), F.lit(20_000))) == 1.01  # 1.005 exactly
    assert value(spark, risk.rate_pct(F.lit(1), F.lit(0))) is None
    assert value(spark, risk.daily_unit_cost(F.lit(5.0), F.lit(0.0))) is None


def test_rounding_keeps_values_beyond_decimals(spark):
    assert value(spark, risk.half_up(F.lit(1e30), 2)) == 1e30
    assert value(spark, risk.half_up(F.lit(float("inf")), 2)) == float("inf")
    assert value(spark, risk.half_up(F.lit(1.005), 2)) == 1.01
