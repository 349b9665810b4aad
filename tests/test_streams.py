from __future__ import annotations

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from wattspindle.operators.windows import telemetry_windows
from wattspindle.schemas import KAFKA_VALUE, layer_schema
from wattspindle.sources import readers
from wattspindle.streaming import streams

FEATURES = layer_schema(
    "timestamp:ntz machine_id:string operation:string rms_x:double rms_y:double rms_z:double label:int"
)
T0 = dt.datetime(2020, 1, 1, 12)


def rows(*minutes, label=0, machine="M01"):
    return [
        (T0 + dt.timedelta(minutes=m), machine, "OP00", float(m), 1.0, 1.0, label) for m in minutes
    ]


def drop_file(spark, path, data):
    """Add one Parquet file; arrival order is modification order."""
    spark.createDataFrame(data, FEATURES).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)


def source(spark, path, max_files=1):
    return readers.stream_files(spark, path, FEATURES, max_files=max_files)


def appended(spark, root, max_files=1):
    frame = streams.windowed(source(spark, f"{root}/in", max_files))
    return streams.run_available(streams.to_parquet(frame, f"{root}/out", f"{root}/ckpt"))


def starts(spark, root):
    out = spark.read.parquet(f"{root}/out")
    return {r["window_start"]: r["n_records"] for r in out.collect()}


def test_closed_windows_equal_the_batch_result(spark, tmp_path):
    data = rows(0, 5, 14, 16, 29, 31, 50, label=1) + rows(3, 20, 50, machine="M02")
    drop_file(spark, f"{tmp_path}/in", data)
    appended(spark, tmp_path)
    batch = telemetry_windows(spark.createDataFrame(data, FEATURES))
    closed = batch.where(F.col("window_end") <= T0 + dt.timedelta(minutes=40))
    key = ["window_start", "machine_id"]
    columns = [c for c in batch.columns if not c.startswith("window_")]
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.orderBy(*key).select(*columns).collect() == closed.orderBy(*key).select(*columns).collect()
    assert out.count() == 4  # the window up to minute 45 is still open at minute 40


def test_late_rows_inside_the_watermark_count_and_older_ones_are_dropped(spark, tmp_path):
    path = f"{tmp_path}/in"
    # Late rows are judged by the watermark of the batch before, so one batch
    # lies between reaching minute 40 and the late arrivals.
    drop_file(spark, path, rows(1, 50))
    drop_file(spark, path, rows(49))
    drop_file(spark, path, rows(2, 46))       # minute 2 is too late, minute 46 is not
    drop_file(spark, path, rows(120))         # closes everything before minute 110
    query = appended(spark, tmp_path)
    assert [n for _, n in sorted(starts(spark, tmp_path).items())] == [1, 3]
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for op in json.loads(progress.json if isinstance(progress.json, str) else json.dumps(progress))[
            "stateOperators"
        ]
    )
    assert dropped == 1


def test_restart_on_the_checkpoint_adds_no_duplicates(spark, tmp_path):
    path = f"{tmp_path}/in"
    drop_file(spark, path, rows(1, 50))
    appended(spark, tmp_path)
    before = starts(spark, tmp_path)
    appended(spark, tmp_path)
    assert starts(spark, tmp_path) == before
    drop_file(spark, path, rows(51, 200))
    appended(spark, tmp_path)
    after = starts(spark, tmp_path)
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == [1, 2]


def test_update_mode_keeps_the_newest_version_of_each_window(spark, tmp_path):
    path = f"{tmp_path}/in"
    drop_file(spark, path, rows(1, 2))
    drop_file(spark, path, rows(3, 20, label=1))
    frame = streams.windowed(source(spark, path))
    streams.run_available(streams.to_upserts(frame, f"{tmp_path}/out", f"{tmp_path}/ckpt"))
    latest = streams.latest_windows(spark, f"{tmp_path}/out", frame.schema).orderBy("window_start")
    assert [(r["n_records"], r["has_anomaly"]) for r in latest.collect()] == [(3, 1), (1, 1)]


def test_sliding_windows_overlap(spark, tmp_path):
    drop_file(spark, f"{tmp_path}/in", rows(12, 100))
    frame = streams.windowed(source(spark, f"{tmp_path}/in"), slide="5 minutes")
    streams.run_available(streams.to_parquet(frame, f"{tmp_path}/out", f"{tmp_path}/ckpt"))
    assert len(starts(spark, tmp_path)) == 3


def test_alerts_pass_only_anomalous_windows(spark, tmp_path):
    drop_file(spark, f"{tmp_path}/in", rows(1) + rows(20, label=1) + rows(100))
    frame = streams.alerts(streams.windowed(source(spark, f"{tmp_path}/in")))
    streams.run_available(streams.to_parquet(frame, f"{tmp_path}/out", f"{tmp_path}/ckpt"))
    assert len(starts(spark, tmp_path)) == 1


def record_alerts(spark, root):
    frame = streams.record_alerts(source(spark, f"{root}/in"))
    query = streams.run_available(streams.to_parquet(frame, f"{root}/out", f"{root}/ckpt", by=()))
    out = spark.read.schema(frame.schema).parquet(f"{root}/out").collect()
    found = [((r["window_start"] - T0).seconds // 60, r["machine_id"], r["rms_x"]) for r in out]
    return query, sorted(found, key=lambda f: (f[0], f[1] or "", f[2]))


def test_record_alerts_come_before_the_window_closes_and_once_across_restarts(spark, tmp_path):
    path = f"{tmp_path}/in"
    drop_file(spark, path, rows(1, 3) + rows(2, label=1))
    assert record_alerts(spark, tmp_path)[1] == [(0, "M01", 2.0)]  # the window is open until minute 25
    drop_file(spark, path, rows(5, 9, label=1) + rows(4, label=1, machine="M02"))
    drop_file(spark, path, rows(6, 16, label=1) + rows(7, label=1, machine=None))
    expected = [(0, None, 7.0), (0, "M01", 2.0), (0, "M02", 4.0), (15, "M01", 16.0)]
    assert record_alerts(spark, tmp_path)[1] == expected
    # Late records of a window with an alert stay silent as long as they are let in at all.
    drop_file(spark, path, rows(38, label=1))
    drop_file(spark, path, rows(14, label=1))
    drop_file(spark, path, rows(29, 39, label=1))
    assert record_alerts(spark, tmp_path)[1] == [*expected, (30, "M01", 38.0)]


def test_alert_state_ends_with_the_window(spark, tmp_path):
    path = f"{tmp_path}/in"
    drop_file(spark, path, rows(1, 20, 40, label=1))
    drop_file(spark, path, rows(300, label=1))
    drop_file(spark, path, rows(301, label=1))
    query, found = record_alerts(spark, tmp_path)
    assert [m for m, _, _ in found] == [0, 15, 30, 300 // 15 * 15]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_start_runs_messages_to_parquet_and_checks_its_arguments(spark, tmp_path):
    message = {
        "timestamp": "2020-01-01T10:00:00",
        "payload": {"machine_id": "M01", "operation": "OP00", "accel_x": [1], "accel_y": [1],
                    "accel_z": [1], "label": 0},
    }
    later = {**message, "timestamp": "2020-01-01T12:00:00"}
    values = [(json.dumps(m),) for m in (message, later)] + [("broken",)]
    spark.createDataFrame(values, KAFKA_VALUE).write.parquet(f"{tmp_path}/in")
    raw = readers.stream_files(spark, f"{tmp_path}/in", KAFKA_VALUE)
    with pytest.raises(ValueError):
        streams.start(raw, "parquet", f"{tmp_path}/c0")
    with pytest.raises(ValueError):
        streams.start(raw, "socket", f"{tmp_path}/c0")
    query = streams.start(
        raw, "parquet", f"{tmp_path}/c1", f"{tmp_path}/out", trigger={"availableNow": True}
    )
    query.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 1
    assert "aggregated_at" in out.columns


def test_start_keeps_a_table_and_alerts(spark, tmp_path):
    def message(minute, label):
        payload = {"machine_id": "M01", "operation": "OP00", "accel_x": [3], "accel_y": [0], "accel_z": [4], "label": label}
        return (json.dumps({"timestamp": f"2020-01-01T10:{minute:02}:00", "payload": payload}),)

    spark.createDataFrame([message(1, 0), message(3, 1), message(20, 0)], KAFKA_VALUE).write.parquet(f"{tmp_path}/in")
    raw = readers.stream_files(spark, f"{tmp_path}/in", KAFKA_VALUE)
    for sink in ("table", "alerts"):
        with pytest.raises(ValueError, match="path"):
            streams.start(raw, sink, f"{tmp_path}/c-{sink}")
        streams.start(raw, sink, f"{tmp_path}/c-{sink}", f"{tmp_path}/{sink}", {"availableNow": True}).awaitTermination()
    schema = streams.with_processing_time(streams.windowed(streams.message_features(raw))).schema
    rows = streams.latest_windows(spark, f"{tmp_path}/table", schema).orderBy("window_start").collect()
    assert [(r["n_records"], r["has_anomaly"], r["max_rms_z"]) for r in rows] == [(2, 1, 4.0), (1, 0, 4.0)]
    (alert,) = spark.read.parquet(f"{tmp_path}/alerts").collect()
    assert (alert["timestamp"].minute, alert["window_start"].minute, alert["peak_accel"]) == (3, 0, 4.0)


def test_console_sink_runs(spark, tmp_path):
    drop_file(spark, f"{tmp_path}/in", rows(1))
    frame = streams.windowed(source(spark, f"{tmp_path}/in"))
    query = streams.run_available(streams.to_console(frame, f"{tmp_path}/ckpt"))
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) == 1


def test_zoneless_time_is_cast_for_the_watermark(spark, tmp_path):
    drop_file(spark, f"{tmp_path}/in", rows(1))
    frame = streams.windowed(source(spark, f"{tmp_path}/in"))
    assert dict(frame.dtypes)["window_start"] == "timestamp"


def test_stream_reads_a_folder_table_like_a_file(spark, sf_dir, tmp_path):
    from wattspindle.plans.catalog import QUERIES

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["stream_window_update"](spark, str(tmp_path)).collect()
    assert sorted(found) == sorted(QUERIES["stream_window_update"](spark, sf_dir).collect())
