"""Features of sample arrays, as native higher-order expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspindle.functions.risk import half_up


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _length(samples: Column) -> Column:
    return F.coalesce(F.size(samples), F.lit(0))


def _mean_of(samples: Column, value) -> Column:
    total = F.aggregate(samples, F.lit(0.0), lambda acc, s: acc + value(s.cast("double")))
    return total / F.size(samples)


def rms(samples: Column | str) -> Column:
    """Root mean square; 0.0 for a missing or empty array."""
    samples = _column(samples)
    filled = F.sqrt(_mean_of(samples, lambda s: s * s))
    return F.when(_length(samples) > 0, filled).otherwise(F.lit(0.0))


def peak(*axes: Column | str) -> Column:
    """Largest absolute sample over all given arrays; NULL when there is none."""
    tops = [F.array_max(F.transform(_column(a), F.abs)).cast("double") for a in axes]
    return tops[0] if len(tops) == 1 else F.greatest(*tops)


def deviation(samples: Column | str) -> Column:
    """Population standard deviation, two passes; 0.0 for a missing or empty array."""
    samples = _column(samples)
    mean = _mean_of(samples, lambda s: s)
    # The mean goes through a one-element array so that it is evaluated once,
    # not once per sample.
    spread = F.element_at(
        F.transform(
            F.array(mean),
            lambda m: F.sqrt(_mean_of(samples, lambda s: (s - m) * (s - m))),
        ),
        1,
    )
    return F.when(_length(samples) > 0, spread).otherwise(F.lit(0.0))


def sample_count(samples: Column | str) -> Column:
    return _length(_column(samples))


def head(samples: Column | str, count: int = 3) -> Column:
    return F.slice(_column(samples), 1, count)


def magnitude(x: Column, y: Column, z: Column) -> Column:
    """Length of the three-axis vector, three decimals."""
    return half_up(F.sqrt(x * x + y * y + z * z), 3)
