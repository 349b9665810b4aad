"""Time arithmetic that keeps zone-less timestamps zone-less.

``date_trunc`` and ``unix_timestamp`` turn a zone-less timestamp into a zoned
one through the session zone, which breaks keys outside UTC. Buckets here
subtract an interval instead, which keeps the input type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspindle.constants import MARKET_TIMEZONE, SAMPLE_RATE_HZ, WINDOW_MINUTES


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def minute_bucket(ts: Column | str, minutes: int = WINDOW_MINUTES) -> Column:
    """Start of the bucket of ``minutes`` (a divisor of 60) that holds ``ts``."""
    ts = _column(ts)
    past = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts) % minutes, F.extract(F.lit("SECOND"), ts)
    )
    return ts - past


def hour_bucket(ts: Column | str) -> Column:
    return minute_bucket(ts, 60)


def month_key(ts: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_column(ts).cast("date"), "month")


def sample_instant(base: Column | str, index: Column | str, rate_hz: int = SAMPLE_RATE_HZ) -> Column:
    """Instant of the sample at ``index`` in a recording that starts at ``base``."""
    micros = _column(index).cast("long") * (1_000_000 // rate_hz)
    return F.timestamp_add("MICROSECOND", micros, _column(base))


def position_instant(start: Column, position: Column, resolution: Column) -> Column:
    """Instant of a 1-based position: quarter-hour steps for ``15M``, else hours."""
    step = F.when(F.contains(resolution, F.lit("15M")), F.lit(15)).otherwise(F.lit(60))
    return F.timestamp_add("MINUTE", (position - 1) * step, start)


def market_wall_clock(ts: Column | str, zone: str = MARKET_TIMEZONE) -> Column:
    """UTC to local wall-clock time without zone.

    Two UTC hours share one wall-clock hour when summer time ends, so joins use
    the UTC key and this is for display.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _column(ts).cast("timestamp_ntz"))


def utc_wall_clock(instant: Column | str) -> Column:
    """An instant as zone-less UTC time, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), _column(instant))


def parse_instant(text: Column | str, pattern: str | None = None) -> Column:
    """ISO-8601 text to a timestamp; malformed text gives NULL."""
    if pattern is None:
        return F.try_to_timestamp(_column(text))
    return F.try_to_timestamp(_column(text), F.lit(pattern))


def parse_month_name(month: Column, year: Column) -> Column:
    """``Aug`` and ``2019`` to the first of that month; other text gives NULL."""
    first = F.try_to_timestamp(F.concat(month, year, F.lit("01")), F.lit("MMMyyyydd"))
    return first.cast("date")


def parse_period(text: Column | str) -> Column:
    """``YYYY-MM`` to the first of that month."""
    return F.concat(_column(text), F.lit("-01")).try_cast("date")


def micros_from_nanos(nanos: Column | str) -> Column:
    """Nanosecond ticks to a zone-less microsecond timestamp."""
    micros = F.call_function("div", _column(nanos), F.lit(1000))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
