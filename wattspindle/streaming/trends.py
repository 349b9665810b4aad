"""Trends over the closed windows of a stream, in state kept per unit."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattspindle.constants import WINDOW_MINUTES
from wattspindle.operators.windows import AXES

# Executors get the processor itself and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = ["machine_id", "operation"]
#: Streams with such state need this store.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
DRIFT = 0.5
ALARM = 500.0
IDLE_HOURS = 24
STATE = (
    "first long, last long, n long, sum_t double, sum_y double, sum_tt double, sum_ty double, "
    "walk double, lowest double"
)
TREND = (
    "window_start timestamp, machine_id string, operation string, magnitude double, n_windows long, "
    "running_mean double, slope_per_hour double, shift_sum double, shifted boolean"
)
_HOUR = 3_600_000_000  # microseconds


class Trend(StatefulProcessor):
    """Running mean, least-squares slope and a one-sided change-point sum of a unit's windows.

    The state is nine numbers, however many windows there were. The change-point sum adds
    what a value exceeds the mean before it by, less ``drift``, and never falls below 0: it is
    a walk less its lowest point. A silence of more than ``idle_hours`` ends a trend, and a
    timer lets its state go.
    """

    def __init__(self, drift: float, alarm: float, idle_hours: float, window_minutes: float):
        self.drift, self.alarm = drift, alarm
        self.idle = int(idle_hours * _HOUR)
        self.window = int(window_minutes * _HOUR / 60)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trend", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # One row a window; windows of earlier batches closed before these.
        frame = pd.concat(list(rows)).sort_values("window_start")
        state = self.state.get() if self.state.exists() else None
        out = []
        for at, y in zip(frame["at"].tolist(), frame["magnitude"].tolist(), strict=True):
            if state is None or at - state[1] > self.idle:
                state = (at, at, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
            first, _, n, t1, y1, tt, ty, walk, lowest = state
            if n:
                walk += y - y1 / n - self.drift
                lowest = min(lowest, walk)
            t = (at - first) / _HOUR
            n, t1, y1, tt, ty = n + 1, t1 + t, y1 + y, tt + t * t, ty + t * y
            state = (first, at, n, t1, y1, tt, ty, walk, lowest)
            spread = n * tt - t1 * t1
            slope = (n * ty - t1 * y1) / spread if spread > 0 else None
            out.append((n, y1 / n, slope, walk - lowest, walk - lowest > self.alarm))
        self.state.update(state)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # A window that ends behind the watermark starts later than this silence allows.
        self.handle.registerTimer((state[1] + self.idle + 2 * self.window) // 1000)
        names = ["n_windows", "running_mean", "slope_per_hour", "shift_sum", "shifted"]
        made = pd.DataFrame(out, columns=names, index=frame.index)
        made["slope_per_hour"] = made["slope_per_hour"].astype("float64")
        columns = ["window_start", "machine_id", "operation", "magnitude"]
        yield pd.concat([frame[columns], made], axis=1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def trends(
    windows: DataFrame,
    drift: float = DRIFT,
    alarm: float = ALARM,
    idle_hours: float = IDLE_HOURS,
    window_minutes: float = WINDOW_MINUTES,
) -> DataFrame:
    """The trend of each unit at each closed window of ``windows``, an append stream.

    Values are magnitudes of the three mean axes; windows without one are left out. A unit
    may have NULL names. Windows close in the order of their end, so a trend sees them in
    order and its rows are final.
    """
    squares = sum((F.col(f"avg_rms_{a}") * F.col(f"avg_rms_{a}") for a in AXES[1:]), F.col("avg_rms_x") * F.col("avg_rms_x"))
    rows = windows.withColumn("magnitude", F.sqrt(squares)).where(F.col("magnitude").isNotNull())
    rows = rows.select("window_start", *UNIT, "magnitude", F.unix_micros("window_start").alias("at"))
    return rows.groupBy(*UNIT).transformWithStateInPandas(
        Trend(drift, alarm, idle_hours, window_minutes), TREND, "Append", "EventTime"
    )
