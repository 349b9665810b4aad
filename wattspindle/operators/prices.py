"""Regular price series: spines, fallback prices, forward fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspindle.constants import FALLBACK_PRICE, FALLBACK_SOURCE, WINDOW_MINUTES
from wattspindle.functions import timebase
from wattspindle.operators.asof import asof_join
from wattspindle.operators.lookups import lookup_join
from wattspindle.session import materialize


def time_spine(bounds: DataFrame, first: Column, last: Column, minutes: int, name: str) -> DataFrame:
    """Every instant from ``first`` to ``last`` per row of ``bounds``, in two steps.

    Days are spread first and slots second, so long periods are expanded by
    many tasks and no array holds more than one day or one row per day.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    days = bounds.select(
        "*",
        F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias("_day"),
        first.alias("_first"),
        last.alias("_last"),
    ).repartition("_day")
    midnight = F.col("_day").cast("timestamp_ntz")
    slots = F.sequence(midnight, midnight + F.make_dt_interval(F.lit(1)) - step, step)
    return (
        days.select("*", F.explode(slots).alias(name))
        .where(F.col(name).between(F.col("_first"), F.col("_last")))
        .drop("_day", "_first", "_last")
    )


def _bounds(prices: DataFrame) -> DataFrame:
    return prices.groupBy("country_code").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


def period_bounds(spark: SparkSession, countries: list[str], first: str, last: str) -> DataFrame:
    """The same fixed period for the given countries, as ``price_spine`` takes it."""
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in countries])).alias("country_code"),
        F.lit(first).cast("timestamp_ntz").alias("first"),
        F.lit(last).cast("timestamp_ntz").alias("last"),
    )


def price_spine(
    prices: DataFrame,
    fallback: float | None = FALLBACK_PRICE,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Every hour of each country's period, also the hours without a quote.

    Those hours get the fallback price and a source that says so, or stay NULL
    when ``fallback`` is None. The period is the quoted one unless ``bounds``
    gives another. ``prices`` is hourly and read more than once.
    """
    bounds = _bounds(prices) if bounds is None else bounds
    spine = time_spine(bounds, F.col("first"), F.col("last"), 60, "timestamp")
    hours = lookup_join(
        spine.select("country_code", "timestamp"), prices, ["country_code", "timestamp"]
    ).select("timestamp", "country_code", "price_eur_mwh", "source")
    if fallback is None:
        return hours
    return hours.withColumns(
        {
            "price_eur_mwh": F.coalesce("price_eur_mwh", F.lit(float(fallback))),
            "source": F.coalesce("source", F.lit(FALLBACK_SOURCE)),
        }
    )


def forward_fill(prices: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Regular slots where each slot carries the latest quote at or before it.

    Several quotes of one slot are averaged. The last quote holds for its hour. The quotes
    are written once, as the slots and the join read them.
    """
    quotes = prices.groupBy(
        "country_code", timebase.minute_bucket("timestamp", minutes).alias("timestamp")
    ).agg(F.avg("price_eur_mwh").alias("price_eur_mwh"))
    quotes = materialize(quotes, "quotes")
    last_slot = F.col("last") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(60 - minutes))
    slots = time_spine(_bounds(quotes), F.col("first"), last_slot, minutes, "timestamp")
    slots = slots.select("timestamp", "country_code")
    known = quotes.where(F.col("price_eur_mwh").isNotNull())
    return asof_join(slots, known, "timestamp", ["price_eur_mwh"], ("country_code",))


def of_country(rows: DataFrame, country: str | None) -> DataFrame:
    """The rows of one country. Without a choice the table must hold one country only."""
    if "country_code" not in rows.columns:
        return rows
    if country is not None:
        return rows.where(F.col("country_code") == country)
    if rows.select("country_code").distinct().limit(2).count() > 1:
        raise ValueError("several countries: name the one to use")
    return rows


def price_per_bucket(prices: DataFrame, country: str | None = None) -> DataFrame:
    """One price of one country per 15-minute bucket, so that joining it never adds rows.

    Several quotes of a bucket are averaged.
    """
    prices = of_country(prices, country)
    return prices.groupBy(timebase.minute_bucket("timestamp").alias("timestamp_15min")).agg(
        F.avg("price_eur_mwh").alias("price_eur_mwh")
    )


def distinct_bucket_prices(prices: DataFrame) -> DataFrame:
    """Distinct (bucket, price) pairs: the plain de-duplication, which keeps
    two rows where one bucket has two prices."""
    return prices.select(
        timebase.minute_bucket("timestamp").alias("timestamp_15min"),
        F.col("price_eur_mwh").cast("double").alias("price_eur_mwh"),
    ).distinct()


def month_batches(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """First and last day of every month that starts within the given dates."""
    opening = F.when(F.dayofmonth(first) == 1, F.col(first)).otherwise(
        F.add_months(F.trunc(first, "month"), 1)
    )
    months = F.when(
        opening <= F.col(last),
        F.sequence(opening, F.col(last), F.make_ym_interval(F.lit(0), F.lit(1))),
    )
    return bounds.select(F.explode(months).alias("month_start")).select(
        "month_start", F.last_day("month_start").alias("month_end")
    )
