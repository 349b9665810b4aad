from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattspindle.operators import harmonize, lookups, prices
from wattspindle.schemas import BRONZE_INDUSTRIAL, BRONZE_PRICES, BRONZE_TELEMETRY, SILVER


def at(hour, minute=0, day=1):
    return dt.datetime(2020, 1, day, hour, minute)


def telemetry(spark, *instants):
    rows = [(t, "M01", "OP00", 1.0, 2.0, 3.0, 1, 10, "f") for t in instants]
    return spark.createDataFrame(rows, BRONZE_TELEMETRY)


def quotes(spark, *pairs):
    return spark.createDataFrame([(t, p, "EXCHANGE", "DE") for t, p in pairs], BRONZE_PRICES)


def prices_by_slot(df):
    return {r["timestamp_15min"]: r["price_eur_mwh"] for r in df.collect()}


def test_mean_fill_covers_quarter_hours_and_gaps(spark):
    facts = telemetry(spark, at(0), at(0, 15), at(0, 30), at(1), at(2))
    joined = harmonize.join_prices(facts, quotes(spark, (at(0), 10.0), (at(1), 40.0)), "mean")
    assert prices_by_slot(joined) == {
        at(0): 10.0, at(0, 15): 25.0, at(0, 30): 25.0, at(1): 40.0, at(2): 25.0,
    }


def test_mean_is_weighted_by_matched_rows(spark):
    facts = telemetry(spark, at(0), at(0), at(1), at(5))
    joined = harmonize.join_prices(facts, quotes(spark, (at(0), 10.0), (at(1), 40.0)), "mean")
    assert prices_by_slot(joined)[at(5)] == pytest.approx(20.0)


def test_forward_fill_carries_across_gaps_and_days(spark):
    series = prices.forward_fill(quotes(spark, (at(22), 10.0), (at(3, day=3), 40.0)))
    found = {r["timestamp"]: r["price_eur_mwh"] for r in series.collect()}
    assert found[at(22)] == found[at(23, 45)] == found[at(12, day=2)] == found[at(2, 45, 3)] == 10.0
    assert found[at(3, day=3)] == found[at(3, 45, 3)] == 40.0
    assert len(found) == (2 + 24 + 4) * 4


def test_forward_fill_mode_leaves_no_quarter_hour_to_the_mean(spark):
    facts = telemetry(spark, at(0), at(0, 45), at(1, 15))
    joined = harmonize.join_prices(facts, quotes(spark, (at(0), 10.0), (at(1), 40.0)), "ffill")
    assert prices_by_slot(joined) == {at(0): 10.0, at(0, 45): 10.0, at(1, 15): 40.0}


def test_forward_fill_is_an_as_of_join_at_both_ends(spark):
    facts = telemetry(spark, at(0, 45), at(1), at(9, day=5))
    joined = harmonize.join_prices(facts, quotes(spark, (at(1), 10.0), (at(3), 40.0)), "ffill")
    assert prices_by_slot(joined) == {at(0, 45): None, at(1): 10.0, at(9, day=5): 40.0}


def test_two_prices_in_one_bucket_add_no_rows(spark):
    facts = telemetry(spark, at(0), at(1))
    two = quotes(spark, (at(0), 10.0), (at(0, 5), 30.0), (at(1), 5.0))
    assert prices.distinct_bucket_prices(two).count() == 3
    joined = harmonize.join_prices(facts, two, None)
    assert joined.count() == 2
    assert prices_by_slot(joined)[at(0)] == 20.0


def test_unknown_fill_is_refused(spark):
    with pytest.raises(ValueError):
        harmonize.join_prices(telemetry(spark, at(0)), quotes(spark, (at(0), 1.0)), "median")


def test_spine_flags_fallback_prices(spark):
    rows = prices.price_spine(quotes(spark, (at(0), 10.0), (at(2), 20.0))).collect()
    assert {(r["timestamp"], r["price_eur_mwh"], r["source"]) for r in rows} == {
        (at(0), 10.0, "EXCHANGE"), (at(1), 50.0, "MOCK"), (at(2), 20.0, "EXCHANGE"),
    }


def test_spine_of_a_fixed_period_needs_no_quotes(spark):
    bounds = prices.period_bounds(spark, ["DE", "FR"], "2020-01-01", "2020-01-03")
    rows = prices.price_spine(quotes(spark, (at(5), 7.0)), bounds=bounds).collect()
    assert len(rows) == 2 * 49
    assert {(r["country_code"], r["price_eur_mwh"]) for r in rows} == {
        ("DE", 7.0), ("DE", 50.0), ("FR", 50.0),
    }
    assert sum(r["source"] == "MOCK" for r in rows) == 97


def test_silver_schema_cost_and_row_count(spark):
    facts = telemetry(spark, at(0), at(0, 15), at(1))
    index = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1), "DE", 104.5, "S", "U")], BRONZE_INDUSTRIAL
    )
    result = harmonize.silver(facts, quotes(spark, (at(0), 100.0)), index)
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in SILVER]
    rows = result.collect()
    assert len(rows) == 3
    assert {r["estimated_power_kwh"] for r in rows} == {1.0}
    assert {r["energy_cost_eur"] for r in rows} == {0.1}
    assert {r["industrial_production_index"] for r in rows} == {104.5}
    assert {r["has_anomaly"] for r in rows} == {True}


def test_month_without_index_keeps_its_rows(spark):
    facts = telemetry(spark, at(0), dt.datetime(2020, 2, 1))
    index = spark.createDataFrame(
        [(dt.datetime(2020, 1, 15), "DE", 1.0, "S", "U")], BRONZE_INDUSTRIAL
    )
    rows = harmonize.join_index(facts, index).collect()
    assert sorted(r["industrial_production_index"] is None for r in rows) == [False, True]


def test_lookup_join_beyond_the_bound_gives_the_same_rows(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("long").alias("k"), "id"
    )
    lookup = spark.range(40).selectExpr("id AS k", "id * 2 AS twice")
    small = lookups.lookup_join(facts, lookup, "k")
    large = lookups.lookup_join(facts, lookup, "k", most=5)
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)
    assert small.count() == 3000


def test_a_broadcast_is_bounded_by_bytes_not_by_rows(spark):
    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    size = lookups.broadcast_bytes(rows)
    assert 100_000 < size < 120_000
    assert lookups.broadcast_bytes(rows, 100_000) is None and lookups.broadcast_bytes(rows, size) == size
    assert lookups.broadcast_bytes(rows.select("id"), 6000) == 100 * 48
    assert lookups.broadcast_bytes(rows.where("false")) == 0
    nested = rows.select(F.array("id").alias("a"))
    assert lookups.broadcast_bytes(nested) is None  # no bound can be told


def test_month_batches_start_inside_the_range(spark):
    bounds = spark.sql("SELECT DATE '2019-01-15' AS a, DATE '2019-03-31' AS b")
    rows = prices.month_batches(bounds, "a", "b").orderBy("month_start").collect()
    assert [tuple(r) for r in rows] == [
        (dt.date(2019, 2, 1), dt.date(2019, 2, 28)),
        (dt.date(2019, 3, 1), dt.date(2019, 3, 31)),
    ]


def test_two_countries_are_never_blended(spark):
    facts = telemetry(spark, at(0))
    two = quotes(spark, (at(0), 10.0)).unionByName(
        quotes(spark, (at(0), 90.0)).withColumn("country_code", F.lit("FR"))
    )
    with pytest.raises(ValueError):
        harmonize.join_prices(facts, two, None)
    assert prices_by_slot(harmonize.join_prices(facts, two, None, "FR")) == {at(0): 90.0}
    index = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1), c, v, "S", "U") for c, v in (("DE", 100.0), ("FR", 50.0))], BRONZE_INDUSTRIAL
    )
    with pytest.raises(ValueError):
        harmonize.join_index(facts, index)
    assert harmonize.join_index(facts, index, country="FR").first()["industrial_production_index"] == 50.0


def test_real_quotes_win_over_stand_ins(spark):
    from wattspindle.operators.windows import hourly_mean

    live = quotes(spark, (at(0), 10.0), (at(0, 30), 20.0))
    stand_in = quotes(spark, (at(0, 5), 50.0), (at(1), 50.0)).withColumn("source", F.lit("MOCK"))
    rows = hourly_mean(live.unionByName(stand_in)).collect()
    assert sorted((r["timestamp"], r["price_eur_mwh"], r["source"]) for r in rows) == [
        (at(0), 15.0, "EXCHANGE"), (at(1), 50.0, "MOCK"),
    ]
