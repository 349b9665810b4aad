"""Structured Streaming: messages to features to 15-minute windows to sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wattspindle.constants import WATERMARK, WINDOW
from wattspindle.functions import signal
from wattspindle.operators.windows import telemetry_windows
from wattspindle.sources.messages import parse_messages, valid_messages
from wattspindle.sources.versioned import VersionedTable

WINDOW_KEY = ["window_start", "machine_id", "operation"]


def message_features(raw: DataFrame) -> DataFrame:
    """Messages to feature rows. Missing payload fields give NULL groups."""
    body = F.col("payload")
    return valid_messages(parse_messages(raw)).select(
        "timestamp",
        "filename",
        body["machine_id"].alias("machine_id"),
        body["operation"].alias("operation"),
        body["run_id"].alias("run_id"),
        body["label"].alias("label"),
        body["sampling_rate_hz"].alias("sampling_rate_hz"),
        *[signal.rms(body[f"accel_{a}"]).alias(f"rms_{a}") for a in ("x", "y", "z")],
        signal.peak(*[body[f"accel_{a}"] for a in ("x", "y", "z")]).alias("peak_accel"),
        body["n_samples"].alias("n_samples"),
        F.current_timestamp().alias("processed_at"),
    )


def windowed(
    features: DataFrame,
    window: str = WINDOW,
    slide: str | None = None,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Watermarked window aggregates. The watermark needs a zoned timestamp."""
    zoned = features.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return telemetry_windows(zoned.withWatermark("timestamp", watermark), "timestamp", window, slide)


def alerts(windows: DataFrame) -> DataFrame:
    """Windows with at least one anomalous record, once they are closed."""
    return windows.where(F.col("has_anomaly") == 1)


def record_alerts(features: DataFrame, window: str = WINDOW, lateness: str = WATERMARK) -> DataFrame:
    """One alert per unit and window, as soon as its first anomalous record arrives.

    Nothing waits for the window to close. A unit's window is remembered until no record of
    it can count any more: the watermark is ``lateness`` and a whole window behind, and a
    key that is kept as long as that outlives the window's last record. So there is no
    second alert, also across a restart. Of records that arrive together any one is the
    first. Records without time or label raise none; a unit may be NULL.
    """
    bad = features.where((F.col("label") == 1) & F.col("timestamp").isNotNull())
    zoned = bad.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return (
        # An interval text may name a unit twice; the parts add up.
        zoned.withWatermark("timestamp", f"{lateness} {window}")
        .withColumn("window_start", F.window("timestamp", window)["start"])
        .dropDuplicatesWithinWatermark(WINDOW_KEY)
    )


def with_processing_time(windows: DataFrame) -> DataFrame:
    return windows.withColumn("aggregated_at", F.current_timestamp())


def to_console(windows: DataFrame, checkpoint: str) -> DataStreamWriter:
    return (
        windows.writeStream.format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
    )


def to_parquet(
    windows: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ("machine_id", "operation")
) -> DataStreamWriter:
    """Closed windows only, each exactly once: file sink plus checkpoint.

    A unit has one row per window, so gathering each unit in one task cannot
    overload it and leaves one file per unit and batch.
    """
    if by:
        windows = windows.repartition(*by)
    writer = windows.writeStream.format("parquet").option("path", path)
    if by:
        writer = writer.partitionBy(*by)
    return writer.option("checkpointLocation", checkpoint).outputMode("append")


def window_table(spark: SparkSession, path: str, schema: T.StructType) -> VersionedTable:
    """The table that ``to_upserts`` keeps up to date; ``snapshot`` reads it."""
    return VersionedTable(spark, path, schema, WINDOW_KEY, "window_start")


def to_upserts(windows: DataFrame, path: str, checkpoint: str, writer: str = "windows") -> DataStreamWriter:
    """Changed windows of each micro-batch into one versioned table.

    A batch is one version, and a replayed one changes nothing, so restarts leave no
    duplicates. Streams that share a table need different names as ``writer``.
    """
    schema = windows.schema

    def save(batch: DataFrame, batch_id: int) -> None:
        window_table(batch.sparkSession, path, schema).upsert(batch, writer, batch_id)

    return (
        windows.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
    )


def latest_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newest state of every window written by ``to_upserts``, from one snapshot."""
    return window_table(spark, path, schema).snapshot()


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_until_idle(writer: DataStreamWriter) -> StreamingQuery:
    """Process batch after batch until no source has more, then stop.

    For sources that cap a batch but know no end of their own, where ``run_available``
    would take one batch.
    """
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def start(
    raw: DataFrame,
    sink: str,
    checkpoint: str,
    path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages to a sink; the caller waits or stops.

    ``"console"`` shows changed windows, ``"parquet"`` keeps closed ones, ``"table"`` the
    newest state of each in a versioned table, and ``"alerts"`` the alerts of records.
    """
    if sink not in ("console", "parquet", "table", "alerts"):
        raise ValueError(f"unknown sink: {sink}")
    if sink != "console" and not path:
        raise ValueError(f"the {sink} sink needs a path")
    features = message_features(raw)
    if sink == "alerts":
        writer = to_parquet(record_alerts(features), path, checkpoint, by=())
    else:
        windows = with_processing_time(windowed(features))
        to = {"console": lambda: to_console(windows, checkpoint), "table": lambda: to_upserts(windows, path, checkpoint)}
        writer = to[sink]() if sink in to else to_parquet(windows, path, checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
