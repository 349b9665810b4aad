from __future__ import annotations

import datetime as dt
import time

import pytest

from wattspindle.schemas import layer_schema
from wattspindle.session import setting
from wattspindle.sources import readers
from wattspindle.streaming import streams, trends

FEATURES = layer_schema(
    "timestamp:ntz machine_id:string operation:string rms_x:double rms_y:double rms_z:double label:int"
)
T0 = dt.datetime(2024, 1, 1)


def records(*items):
    """(minute, machine, value) as feature rows; the magnitude is 3 times the value."""
    return [(T0 + dt.timedelta(minutes=m), u, "OP00", 1.0 * v, 2.0 * v, 2.0 * v, 0) for m, u, v in items]


def expected(items, closed, drift=0.5, idle_hours=24):
    """(minute, n, mean, slope, shift) of each closed window of one unit."""
    sums: dict[int, list] = {}
    for m, _, v in items:
        sums.setdefault(m // 15 * 15, []).append(3.0 * v)
    out, ts, ys, shift = [], [], [], 0.0
    for m in sorted(sums):
        if m + 15 > closed:
            continue
        y = sum(sums[m]) / len(sums[m])
        if ts and m - ts[-1] > idle_hours * 60:
            ts, ys, shift = [], [], 0.0
        if ys:
            shift = max(0.0, shift + y - sum(ys) / len(ys) - drift)
        ts, ys = [*ts, m], [*ys, y]
        hours = [(t - ts[0]) / 60 for t in ts]
        th, yh = sum(hours) / len(hours), sum(ys) / len(ys)
        spread = sum((t - th) ** 2 for t in hours)
        slope = sum((t - th) * (v - yh) for t, v in zip(hours, ys, strict=True)) / spread if spread else None
        out.append((m, len(ys), yh, slope, shift))
    return out


@pytest.fixture
def run(spark, tmp_path):
    def feed(items, **options):
        spark.createDataFrame(records(*items), FEATURES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
        source = readers.stream_files(spark, f"{tmp_path}/in", FEATURES, max_files=1)
        frame = trends.trends(streams.windowed(source), **options)
        with setting(spark, *trends.STATE_STORE):
            streams.run_available(streams.to_parquet(frame, f"{tmp_path}/out", f"{tmp_path}/ckpt", by=()))
        rows = spark.read.schema(frame.schema).parquet(f"{tmp_path}/out").orderBy("machine_id", "window_start").collect()
        return [
            ((r.window_start - T0).days * 1440 + (r.window_start - T0).seconds // 60, r.machine_id, r) for r in rows
        ]

    return feed


def check(found, items, closed, unit="M01", **options):
    mine = [(m, r) for m, u, r in found if u == unit]
    wanted = expected([i for i in items if i[1] == unit], closed, **options)
    assert [(m, r.n_windows) for m, r in mine] == [(w[0], w[1]) for w in wanted]
    for (_, r), (_, _, mean, slope, shift) in zip(mine, wanted, strict=True):
        assert r.running_mean == pytest.approx(mean) and r.shift_sum == pytest.approx(shift)
        assert r.slope_per_hour == (None if slope is None else pytest.approx(slope, abs=1e-9))


def test_state_goes_on_over_batches_and_a_restart(run):
    first = [(m, "M01", 1 + m / 100) for m in range(0, 120, 4)] + [(m, "M02", 2.0) for m in range(0, 100, 9)]
    second = [(m, "M01", 3.0) for m in range(120, 300, 7)] + [(m, None, 1.0) for m in range(150, 300, 10)]
    third = [(600, "M01", 1.0)]
    run(first)
    run(second)
    found = run(third)
    items = first + second + third
    check(found, items, 590)
    check(found, items, 590, "M02")
    check(found, items, 590, None)
    assert all(r.shift_sum == 0 and not r.shifted for _, u, r in found if u == "M02")


def test_a_shift_raises_the_sum_beyond_the_alarm(run):
    steady = [(m, "M01", 1.0) for m in range(0, 300, 15)]
    raised = [(m, "M01", 2.0) for m in range(300, 450, 15)]
    found = run([*steady, *raised, (900, "M01", 1.0)], alarm=8.0)
    flags = [(m, r.shifted) for m, _, r in found]
    assert not any(f for m, f in flags if m < 330) and all(f for m, f in flags if 400 <= m < 450)


def test_a_long_silence_starts_a_new_trend(run):
    items = [(0, "M01", 1.0), (20, "M01", 2.0), (200, "M01", 5.0), (215, "M01", 6.0), (600, "M02", 1.0)]
    run(items[:2], idle_hours=2)
    run([(190, "M02", 1.0)], idle_hours=2)  # the watermark goes on and the timer lets the state go
    found = run(items[2:], idle_hours=2)
    check(found, items, 590, idle_hours=2)
    assert [r.n_windows for _, u, r in found if u == "M01"] == [1, 2, 1, 2]
