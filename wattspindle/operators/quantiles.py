"""Interpolated percentiles over a whole table without one task seeing it all."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A round cuts a zone into so many bins.
BINS = 1024
#: Zones of at most this many values are looked into.
MOST = 10_000


def sketched_quantiles(df: DataFrame, column: str, probs: dict[str, float], accuracy: int) -> DataFrame:
    """One row of approximate percentiles, rank error at most ``1 / accuracy``."""
    sketch = F.percentile_approx(column, list(probs.values()), accuracy)
    return df.agg(sketch.alias("q")).select(
        [F.col("q")[i].cast("double").alias(name) for i, name in enumerate(probs)]
    )


@dataclass(frozen=True)
class Zone:
    """The values from ``low`` to ``high``: how many there are, and how many are smaller."""

    low: float
    high: float
    before: int
    count: int

    def holds(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.count

    def is_one_value(self) -> bool:
        return not self.low < self.high  # also where both are NaN


def _magnitude(v: Column) -> Column:
    """A whole number that grows with ``v``: one for each power of two and sign.

    A logarithm may err at a power of two, but it never falls, and that is all it takes.
    """
    power = F.floor(F.log2(F.abs(v))) + 1100
    inner = F.when(v == 0, 0).otherwise(F.signum(v) * power)
    endless = F.when(v > 0, 5000).otherwise(-5000)
    return F.when(F.isnan(v), 9999).when(F.abs(v) == math.inf, endless).otherwise(inner).cast("int")


def _zones(rows: list, before: int) -> list[Zone]:
    """Bins in ascending order as zones, the first with ``before`` smaller values."""
    out = []
    for r in sorted(rows, key=lambda r: r["bin"]):
        out.append(Zone(r["low"], r["high"], before, r["n"]))
        before += r["n"]
    return out


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]


def _narrowed(values: DataFrame, zones: list[Zone]) -> list[Zone]:
    """Each zone cut into bins of equal width, in one pass over the values."""
    chosen, bins = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, z in enumerate(zones):
        inside = F.col("v").between(z.low, z.high)
        place = F.floor((F.col("v") - z.low) / (z.high - z.low) * BINS)
        chosen, bins = F.when(inside, i).otherwise(chosen), F.when(inside, place).otherwise(bins)
    binned = values.select("v", chosen.alias("zone"), bins.cast("int").alias("bin")).where("zone IS NOT NULL")
    found = binned.groupBy("zone", "bin").agg(*_counts()).collect()  # at most BINS + 1 rows a zone
    return [n for i, z in enumerate(zones) for n in _zones([r for r in found if r["zone"] == i], z.before)]


def exact_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], accuracy: int | None = None, most: int = MOST
) -> DataFrame:
    """One row with the interpolated percentiles of ``column``; NULLs are ignored.

    The built-in exact percentile keeps every distinct value in one buffer. Here the wanted
    ranks are closed in on: values are counted by sign and power of two, then the bins that
    hold a rank are cut into ``BINS`` again, until such a zone has ``most`` values or a single
    one. All counts combine before they are shuffled, no task sorts more than ``most`` values
    a zone, and the driver gets that many at most. NaN is greater than any number.
    ``accuracy`` switches to a sketch alone.

    Runs its passes, three for most tables, when it is called; ``df`` is read in each, so
    callers pass a written table.
    """
    if accuracy is not None:
        return sketched_quantiles(df, column, probs, accuracy)
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    zones = _zones(values.groupBy(_magnitude(F.col("v")).alias("bin")).agg(*_counts()).collect(), 0)
    total = sum(z.count for z in zones)
    positions = {name: p * (total - 1) for name, p in probs.items()} if total else {}
    ranks = {r for position in positions.values() for r in (math.floor(position), math.ceil(position))}

    def wanted(found: list[Zone]) -> list[Zone]:
        return [z for z in found if any(z.holds(r) for r in ranks)]

    zones = wanted(zones)
    while wide := [z for z in zones if z.count > most and not z.is_one_value()]:
        zones = [z for z in zones if z not in wide] + wanted(_narrowed(values, wide))
    by_rank = {r: z.low for z in zones if z.is_one_value() for r in ranks if z.holds(r)}
    for z in zones:
        if not z.is_one_value():
            before = z.before
            counted = values.where(F.col("v").between(z.low, z.high)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
            for r in sorted(counted.collect(), key=lambda r: r["v"]):
                by_rank |= {rank: r["v"] for rank in ranks if before <= rank < before + r["n"]}
                before += r["n"]
    row = []
    for name in probs:
        position = positions.get(name)
        if position is None:
            row.append(None)
            continue
        low, high = by_rank[math.floor(position)], by_rank[math.ceil(position)]
        # Equal ends also where they are infinite.
        row.append(low if low == high else low + (high - low) * (position - math.floor(position)))
    return df.sparkSession.createDataFrame([tuple(row)], ", ".join(f"`{name}` double" for name in probs))
