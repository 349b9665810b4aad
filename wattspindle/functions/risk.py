"""Rates, classes and unit costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspindle.constants import DAILY_RATE_BOUNDS, LOWEST_RISK, PERIOD_RATE_BOUNDS


def half_up(value: Column, digits: int) -> Column:
    """Commercial rounding on the decimal value, as a double.

    Binary noise would decide ties such as 1.005 at random; the detour through
    ten decimals removes it. Values that no such decimal can hold stay as they are.
    """
    rounded = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(rounded, value.cast("double"))


def rate_pct(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals; NULL for an empty whole."""
    return half_up(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 2)


def _first_match(conditions: list[tuple[Column, str]], otherwise: str) -> Column:
    (condition, value), *rest = conditions
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def daily_health(rate: Column) -> Column:
    """Health class of one day; a bound itself belongs to the lower class."""
    return _first_match([(rate > bound, name) for bound, name in DAILY_RATE_BOUNDS], LOWEST_RISK)


def period_risk(rate: Column) -> Column:
    """Risk class of the whole period; a bound itself belongs to the higher class."""
    return _first_match([(rate >= bound, name) for bound, name in PERIOD_RATE_BOUNDS], LOWEST_RISK)


def stability(value: Column, p50: Column, p75: Column) -> Column:
    return _first_match([(value >= p75, "UNSTABLE"), (value >= p50, "MODERATE")], "STABLE")


def daily_unit_cost(cost: Column, mean_power: Column) -> Column:
    """Cost per thousand units of mean power, two decimals; NULL at zero power."""
    return half_up(F.try_divide(cost, mean_power / 1000.0), 2)


def period_unit_cost(cost: Column, mean_power: Column, days: Column) -> Column:
    return F.try_divide(cost, mean_power * days)


def estimated_power(x: Column, y: Column, z: Column) -> Column:
    """Mean of the three axes times one half."""
    return (x + y + z) / 3 * 0.5


def energy_cost(power: Column, price: Column) -> Column:
    return power * price / 1000
