"""Batch sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Measured = Callable[[DataFrame], DataFrame]


def gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a partition value in few tasks; adaptive execution splits large values."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def append_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    gathered(df, by).write.mode("append").partitionBy(*by).parquet(path)


def append_flat(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_flat(df: DataFrame, path: str, measured: Measured | None = None) -> None:
    """``measured`` is applied to the rows as they are written."""
    (measured(df) if measured else df).write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; running it again gives
    the same table."""
    (
        gathered(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_compact(
    df: DataFrame,
    path: str,
    by: list[str],
    order: str | None = None,
    mode: str = "overwrite",
    measured: Measured | None = None,
) -> None:
    """Partitioned write with few files per partition value; overwriting replaces
    the whole table.

    The rebalance hint gathers each value's rows, and adaptive execution splits
    the values that are too large for one task. ``order`` sorts the rows inside
    each file, so that range filters on it skip row groups. ``measured`` is applied to
    the rows as they are written.
    """
    rows = gathered(df, by)
    if order:
        rows = rows.sortWithinPartitions(*by, order)
    (
        (measured(rows) if measured else rows)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_messages(encoded: DataFrame, path: str) -> None:
    """JSON messages as text, one per line."""
    encoded.select("value").write.mode("append").text(path)


def write_kafka(encoded: DataFrame, servers: str, topic: str) -> None:
    """JSON messages to a Kafka topic. Needs the Kafka connector package."""
    (
        encoded.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def save_table(df: DataFrame, name: str) -> None:
    """Materialise a model as a managed table, replacing the previous one."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
