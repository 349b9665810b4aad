from __future__ import annotations

import datetime as dt
import json

import pytest

from wattspindle.schemas import STREAM_FEATURES, STREAM_WINDOWS
from wattspindle.sources import messages
from wattspindle.streaming import streams

FULL = {
    "timestamp": "2020-01-01T10:00:00", "source": "s", "filename": "f",
    "payload": {
        "operation": "OP01", "machine_id": "M01", "run_id": "7", "accel_x": [3, 4], "accel_y": [1],
        "accel_z": [], "label": 1, "n_samples": 2, "sampling_rate_hz": 2000,
    },
}
PRODUCER = {
    "timestamp": "2020-01-01T10:01:00", "filename": "p", "chunk_index": 4, "is_last_chunk": True,
    "payload": {"machine_id": "M02", "accel_x": [1], "accel_y": [1], "accel_z": [1], "label": 0},
}
OLDER = {"timestamp": "2020-01-01T10:02:00", "data": {"accel_x": [5.5]}}
BAD_TIME = {**FULL, "timestamp": "yesterday"}
NO_BODY = {"timestamp": "2020-01-01T10:03:00", "filename": "n"}


def raw(spark, *items):
    rows = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
    return spark.createDataFrame(rows, "value string")


ALL = (FULL, PRODUCER, OLDER, BAD_TIME, NO_BODY, '{"timestamp": "2020-01-01T10', "plain text")


def test_counts_of_good_and_bad_messages(spark):
    counts = messages.message_counts(messages.parse_messages(raw(spark, *ALL))).first()
    assert (counts["seen"], counts["processed"]) == (7, 4)


def test_defaults_for_missing_keys(spark):
    parsed = messages.parse_messages(raw(spark, *ALL))
    rows = {r["filename"]: r for r in messages.describe_messages(parsed).collect()}
    older = rows["Unknown"]
    assert (older["chunk"], older["machine_id"], older["label_name"]) == ("N/A", "Unknown", "Normal")
    assert (older["n_samples"], older["head_x"]) == (1, [5.5])
    assert (rows["p"]["chunk"], rows["p"]["machine_id"]) == ("4", "M02")
    assert rows["f"]["label_name"] == "Anomaly"


def test_malformed_time_is_null_and_not_an_error(spark):
    parsed = messages.parse_messages(raw(spark, BAD_TIME, FULL)).collect()
    assert [r["timestamp"] for r in parsed] == [None, dt.datetime(2020, 1, 1, 10)]


def test_first_messages_is_a_limit_over_valid_ones(spark):
    described = messages.describe_messages(messages.parse_messages(raw(spark, *ALL)))
    assert [r["filename"] for r in messages.first_messages(described, 2, ["filename"]).collect()] == [
        "Unknown", "f",
    ]


def test_features_of_every_message_form(spark):
    rows = {r["filename"]: r for r in streams.message_features(raw(spark, FULL, PRODUCER)).collect()}
    assert rows["f"]["rms_x"] == (12.5) ** 0.5
    assert (rows["f"]["rms_z"], rows["f"]["peak_accel"], rows["f"]["n_samples"]) == (0.0, 4.0, 2)
    assert (rows["p"]["operation"], rows["p"]["run_id"]) == (None, None)
    assert rows["p"]["processed_at"] is not None


def test_stream_schemas_are_as_declared(spark):
    def typed(struct):
        return [(f.name, f.dataType) for f in struct.fields]

    features = streams.message_features(raw(spark, FULL))
    windows = streams.with_processing_time(streams.windowed(features))
    assert typed(features.schema) == typed(STREAM_FEATURES)
    assert typed(windows.schema) == typed(STREAM_WINDOWS)


def test_a_reader_of_scalar_fields_decodes_no_arrays(spark):
    narrow = messages.parse_messages(raw(spark, *ALL), body=["machine_id", "label"])
    assert narrow.schema["payload"].dataType.fieldNames() == ["machine_id", "label"]
    assert "accel" not in narrow._jdf.queryExecution().executedPlan().toString()
    full = messages.parse_messages(raw(spark, *ALL)).select("timestamp", "payload.machine_id", "payload.label")
    assert narrow.select("timestamp", "payload.machine_id", "payload.label").collect() == full.collect()
    counts = messages.message_counts(messages.parse_messages(raw(spark, *ALL), body=["label"])).first()
    assert (counts["seen"], counts["processed"]) == (7, 4)
    with pytest.raises(ValueError, match="rpm"):
        messages.message_schema(["rpm", "label"])


def test_fields_unknown_to_the_schema_are_found_with_their_kind(spark):
    drifted = {**FULL, "site": "north", "payload": {**FULL["payload"], "rpm": 900, "tools": [1, "a"], "spare": None}}
    older = {**OLDER, "data": {**OLDER["data"], "rpm": 1.5, "axis": {"u": [1]}}}
    found = messages.unknown_fields(raw(spark, *ALL, drifted, drifted, older, '{"payload": 5, "site": true}', "[1]"))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("data", "axis", "OBJECT", 1), ("data", "rpm", "DECIMAL", 1), ("message", "site", "BOOLEAN", 1),
        ("message", "site", "STRING", 2), ("payload", "rpm", "BIGINT", 2), ("payload", "spare", "VOID", 2),
        ("payload", "tools", "ARRAY", 2),
    ]
    assert messages.unknown_fields(raw(spark)).collect() == []
