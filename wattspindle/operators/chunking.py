"""Cut recordings into blocks, or into samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspindle.constants import CHUNK_SAMPLES, SAMPLE_RATE_HZ
from wattspindle.functions import signal, timebase
from wattspindle.operators.lookups import lookup_join
from wattspindle.session import materialize

_AXES = ("x", "y", "z")


def longest_axis() -> Column:
    """Samples of the longest axis; a missing axis has none."""
    return F.greatest(*[signal.sample_count(f"accel_{a}") for a in _AXES])


def _blocks(size: int, rate_hz: int, fields) -> Column:
    """Array of one struct per block; ``fields(first, count)`` adds the payload.

    Building the structs before exploding keeps each output row at the size of
    its own block. Exploding block numbers and slicing afterwards would copy the
    whole recording into every row.
    """
    length = longest_axis()
    last = F.call_function("div", length - 1, F.lit(size))

    def block(i: Column) -> Column:
        first = i * size
        count = F.least(F.lit(size), length - first)
        return F.struct(
            i.cast("int").alias("chunk_index"),
            (i == last).alias("is_last_chunk"),
            timebase.sample_instant(F.col("base_ts"), first, rate_hz).alias("chunk_ts"),
            count.cast("int").alias("sample_count"),
            *fields(first, count),
        )

    return F.transform(F.sequence(F.lit(0), last), block)


def _cut(signals: DataFrame, size: int, rate_hz: int, fields) -> DataFrame:
    # An empty or missing recording has no blocks; sequence(0, -1) would count down.
    return signals.where(longest_axis() > 0).select(
        "run_id",
        "machine_id",
        "operation",
        "label",
        "filename",
        F.inline(_blocks(size, rate_hz, fields)),
    )


def chunk_signals(
    signals: DataFrame, size: int = CHUNK_SAMPLES, rate_hz: int = SAMPLE_RATE_HZ
) -> DataFrame:
    """One row per block of up to ``size`` samples, with the samples; the tail is kept.

    Axes may differ in length: blocks follow the longest, which ``sample_count`` counts,
    and a shorter axis has fewer or no samples in the last blocks.
    """

    def fields(first: Column, count: Column) -> list[Column]:
        return [
            F.slice(F.col(f"accel_{a}"), first + 1, count).alias(f"accel_{a}") for a in _AXES
        ]

    return _cut(signals, size, rate_hz, fields)


def chunk_features(
    signals: DataFrame, size: int = CHUNK_SAMPLES, rate_hz: int = SAMPLE_RATE_HZ
) -> DataFrame:
    """One row per block with its RMS per axis and its 15-minute bucket."""

    def fields(first: Column, count: Column) -> list[Column]:
        return [
            signal.rms(F.slice(F.col(f"accel_{a}"), first + 1, count)).alias(f"rms_{a}")
            for a in _AXES
        ]

    return _cut(signals, size, rate_hz, fields).withColumn(
        "timestamp_15min", timebase.minute_bucket("chunk_ts")
    )


def signal_features(signals: DataFrame) -> DataFrame:
    """Whole-recording features: RMS and deviation per axis, joint peak, length."""
    return signals.select(
        "run_id",
        "machine_id",
        "operation",
        "label",
        "filename",
        *[signal.rms(f"accel_{a}").alias(f"rms_{a}") for a in _AXES],
        *[signal.deviation(f"accel_{a}").alias(f"std_{a}") for a in _AXES],
        signal.peak(*[f"accel_{a}" for a in _AXES]).alias("peak_accel"),
        longest_axis().alias("n_samples"),
    )


def explode_samples(signals: DataFrame, rate_hz: int = SAMPLE_RATE_HZ) -> DataFrame:
    """One row per sample with its instant."""
    arrays = F.arrays_zip(*[F.col(f"accel_{a}").alias(f"accel_{a}") for a in _AXES])
    return signals.select(
        "run_id",
        "machine_id",
        "operation",
        "label",
        "base_ts",
        F.posexplode(arrays).alias("sample_index", "sample"),
    ).select(
        "run_id",
        "machine_id",
        "operation",
        "label",
        "sample_index",
        timebase.sample_instant("base_ts", "sample_index", rate_hz).alias("timestamp"),
        *[F.col(f"sample.accel_{a}").cast("double").alias(f"accel_{a}") for a in _AXES],
    )


def signal_head(signals: DataFrame, count: int = 3) -> DataFrame:
    """Length and leading samples of every recording."""
    return signals.select(
        "run_id",
        signal.sample_count("accel_x").alias("n_samples"),
        signal.head("accel_x", count).alias("head_x"),
    )


def chunk_ordinals(chunks: DataFrame, run: str = "run_id", index: str = "chunk_index") -> DataFrame:
    """Mark the last block of every run in a table of blocks.

    The last index is pre-aggregated and joined back, so no task holds all
    blocks of a run however long the run is. ``chunks`` is read twice.
    """
    ends = materialize(
        chunks.groupBy(run).agg(
            F.max(index).alias("last_index"), F.count(F.lit(1)).alias("n_chunks")
        ),
        "run-ends",
    )
    return lookup_join(chunks, ends, run).select(
        chunks["*"], "n_chunks", (F.col(index) == F.col("last_index")).alias("is_last_chunk")
    )
