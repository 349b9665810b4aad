from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wattspindle.operators import chunking, windows
from wattspindle.schemas import SIGNALS

BASE = dt.datetime(2019, 8, 1)


def recording(spark, *lengths, label=0):
    rows = []
    for i, n in enumerate(lengths):
        samples = None if n is None else [float(k) for k in range(n)]
        rows.append((f"r{i}", "M01", "OP00", BASE, label, samples, samples, samples, f"f{i}"))
    return spark.createDataFrame(rows, SIGNALS)


def test_blocks_keep_the_short_tail(spark):
    rows = chunking.chunk_signals(recording(spark, 2500)).orderBy("chunk_index").collect()
    assert [r["sample_count"] for r in rows] == [1000, 1000, 500]
    assert [r["is_last_chunk"] for r in rows] == [False, False, True]
    assert [r["chunk_ts"] - BASE for r in rows] == [dt.timedelta(milliseconds=500 * i) for i in range(3)]
    assert [x for r in rows for x in r["accel_x"]] == [float(k) for k in range(2500)]


def test_exact_multiple_has_no_empty_tail(spark):
    assert chunking.chunk_signals(recording(spark, 2000)).count() == 2


def test_empty_and_missing_recordings_have_no_blocks(spark):
    signals = recording(spark, 0, None)
    assert chunking.chunk_signals(signals).count() == 0
    assert chunking.chunk_features(signals).count() == 0
    assert chunking.explode_samples(signals).count() == 0


def test_block_rms(spark):
    row = chunking.chunk_features(recording(spark, 3), size=2).orderBy("chunk_index").collect()
    assert row[0]["rms_x"] == pytest.approx(math.sqrt(0.5))
    assert row[1]["rms_x"] == pytest.approx(2.0)
    assert row[0]["timestamp_15min"] == BASE


def test_one_bad_run_flags_the_shared_window(spark):
    runs = recording(spark, 10).unionByName(recording(spark, 10, label=1))
    rolled = windows.rollup_chunks(chunking.chunk_features(runs)).collect()
    assert len(rolled) == 1
    assert (rolled[0]["has_anomaly"], rolled[0]["total_samples"]) == (1, 20)


def test_blocks_average_unweighted(spark):
    rolled = windows.rollup_chunks(chunking.chunk_features(recording(spark, 3), size=2)).first()
    assert rolled["avg_rms_x"] == pytest.approx((math.sqrt(0.5) + 2.0) / 2)


def test_samples_are_half_a_millisecond_apart(spark):
    rows = chunking.explode_samples(recording(spark, 4)).orderBy("sample_index").collect()
    assert [r["timestamp"] - BASE for r in rows] == [dt.timedelta(microseconds=500 * i) for i in range(4)]
    assert [r["accel_z"] for r in rows] == [0.0, 1.0, 2.0, 3.0]


def test_ordinals_of_one_very_long_run(spark):
    blocks = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 100).otherwise(F.lit(-1)).alias("run_id"),
        F.col("id").alias("chunk_index"),
    )
    marked = chunking.chunk_ordinals(blocks)
    last = {r["run_id"]: r["chunk_index"] for r in marked.where("is_last_chunk").collect()}
    brute = {}
    for r in blocks.collect():
        brute[r["run_id"]] = max(brute.get(r["run_id"], -1), r["chunk_index"])
    assert last == brute
    assert marked.count() == 6000


def test_unequal_axes_lose_no_sample(spark):
    axes = [([1.0, 2.0, 3.0], [4.0] * 5, None), ([], [1.0] * 5, [2.0] * 5)]
    rows = [(f"r{i}", "M01", "OP00", BASE, 0, x, y, z, "f") for i, (x, y, z) in enumerate(axes)]
    signals = spark.createDataFrame(rows, SIGNALS)
    blocks = chunking.chunk_signals(signals, size=2).orderBy("run_id", "chunk_index").collect()
    assert [(r["run_id"], r["sample_count"], r["is_last_chunk"]) for r in blocks] == [
        (run, n, n == 1) for run in ("r0", "r1") for n in (2, 2, 1)
    ]
    for run, (x, y, z) in enumerate(axes):
        for axis, whole in zip("xyz", (x, y, z), strict=True):
            own = [s for r in blocks if r["run_id"] == f"r{run}" for s in r[f"accel_{axis}"] or []]
            assert own == (whole or [])
    assert {r["n_samples"] for r in chunking.signal_features(signals).collect()} == {5}
