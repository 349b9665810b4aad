from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspindle.operators import quantiles
from wattspindle.operators.quantiles import exact_quantiles

PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


@pytest.mark.parametrize(
    "values",
    [
        [7],
        [1, 2],
        [3] * 50,
        [5] * 400 + list(range(600)),
        [0.001 * i for i in range(1000)] + [1e9],
        [-4, -4, 0, 0.5, 9, 9, 9],
    ],
)
def test_exact_matches_interpolated_percentiles(spark, values):
    row = exact_quantiles(frame(spark, values), "v", PROBS).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-12)


def test_random_values_with_one_hot_value(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=4000).round(3), np.full(2000, 0.125)])
    rng.shuffle(values)
    df = frame(spark, values.tolist()).repartition(7)
    row = exact_quantiles(df, "v", PROBS).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)


def test_nulls_are_ignored_and_empty_gives_null(spark):
    assert exact_quantiles(frame(spark, [1, None, 3]), "v", {"m": 0.5}).first()["m"] == 2.0
    assert exact_quantiles(frame(spark, [None]), "v", {"m": 0.5}).first()["m"] is None


def test_sketch_stays_within_its_rank_error(spark):
    df = spark.range(10_001).selectExpr("CAST(id AS DOUBLE) AS v")
    row = exact_quantiles(df, "v", {"m": 0.5}, accuracy=100).first()
    assert abs(row["m"] - 5000) <= 100


def plain(values, p):
    """The interpolated percentile of a sorted list."""
    position = p * (len(values) - 1)
    low, high = values[math.floor(position)], values[math.ceil(position)]
    return low if low == high else low + (high - low) * (position - math.floor(position))


@pytest.mark.parametrize(
    "values",
    [
        [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, 1e-300, 1.0, 2.0, 4.0, 0.5],
        [7.0] * 500 + [8.0],
        [float(i % 7) for i in range(900)],
        [2.0**i for i in range(-60, 60)] + [-(3.0**i) for i in range(-30, 30)],
        [1.0 + i * 2**-52 for i in range(800)],
        [i / 3 for i in range(-1000, 1000)] + [1e12] * 3,
    ],
)
def test_zones_close_in_on_any_distribution(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    probs = {f"p{i}": i / 8 for i in range(9)}
    found = exact_quantiles(df, "v", probs, most=5).first()
    assert tuple(found) == tuple(plain(sorted(values), p) for p in probs.values())


def test_infinite_values_and_nan_are_the_greatest(spark):
    values = [1.0, 2.0, 3.0, math.inf, math.nan, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = exact_quantiles(df, "v", {"least": 0.0, "second": 0.2, "fifth": 0.8, "last": 1.0}).first()
    assert (found["least"], found["second"]) == (-math.inf, 1.0) and math.isnan(found["last"])


def test_zones_that_are_looked_into_are_small(spark):
    df = spark.range(50_000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    sizes = []
    narrowed = quantiles._narrowed

    def watch(values, zones):
        found = narrowed(values, zones)
        sizes.append(max(z.count for z in found))
        return found

    with pytest.MonkeyPatch.context() as m:
        m.setattr(quantiles, "_narrowed", watch)
        row = exact_quantiles(df, "v", {"p50": 0.5}, most=100).first()
    assert row["p50"] == (24_999.0**2 + 25_000.0**2) / 2
    assert sizes and sizes[-1] <= 100
