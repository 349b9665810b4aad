"""Backward as-of join: each row with the latest earlier row of another table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_DAY, _SIDE, _FOUND, _IN_DAY, _CARRIED = "__day", "__side", "__found", "__in_day", "__carried"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    columns: list[str],
    by: tuple[str, ...] = (),
    within: str | None = None,
) -> DataFrame:
    """``left`` with ``columns`` of the latest row of ``right`` at or before its ``ts``.

    Rows match inside equal values of ``by``; ``within``, an interval as ``6 hours``, leaves
    out matches that are older. Of right rows of one time the greatest by ``columns`` counts.
    Rows with a NULL time or a NULL in ``by`` match nothing; every left row comes out once.

    Both sides meet by day, so a task sorts one day of one key and never a whole history. A
    day without an earlier row of its own takes over the closing row of the last day that
    has one: these are as many rows as there are days. ``right`` is read twice.
    """
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"left has columns of these names: {sorted(clash)}")
    keys = [*by, _DAY]
    day = F.col(ts).cast("date").alias(_DAY)
    usable = F.col(ts).isNotNull()
    for c in by:
        usable = usable & F.col(c).isNotNull()
    found = F.struct(F.col(ts).alias("at"), *columns)
    quotes = right.where(usable).select(*by, ts, day, F.lit(0).alias(_SIDE), found.alias(_FOUND))
    asked = left.select("*", day, F.lit(1).alias(_SIDE))
    both = asked.unionByName(quotes, allowMissingColumns=True)
    # Right rows of a time come before left ones, the greatest of them last.
    so_far = (
        Window.partitionBy(*keys).orderBy(ts, _SIDE, _FOUND).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = both.withColumn(_IN_DAY, F.last(_FOUND, ignorenulls=True).over(so_far)).where(F.col(_SIDE) == 1)

    days = left.where(usable).select(*by, day).distinct().withColumn(_CARRIED, F.lit(None).cast(quotes.schema[_FOUND].dataType))
    closing = quotes.groupBy(*keys).agg(F.max(_FOUND).alias(_CARRIED))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)
    # A day may be there twice, once from each side; what comes before it is the same.
    carried = (
        closing.unionByName(days)
        .groupBy(*keys)
        .agg(F.max(_CARRIED).alias(_CARRIED))
        .withColumn(_CARRIED, F.last(_CARRIED, ignorenulls=True).over(before))
    )
    joined = merged.join(carried, keys, "left").withColumn(_FOUND, F.coalesce(_IN_DAY, _CARRIED))
    if within is not None:
        fresh = F.col(_FOUND)["at"] >= F.col(ts) - F.expr(f"INTERVAL {within}")
        joined = joined.withColumn(_FOUND, F.when(fresh, F.col(_FOUND)))
    return joined.select(*left.columns, *[F.col(_FOUND)[c].alias(c) for c in columns])
