"""Batch and streaming scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.functions.timebase import micros_from_nanos
from wattspindle.schemas import SIGNALS, conform


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet file or a (partitioned) directory, with its declared schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_nanos_parquet(spark: SparkSession, path: str, ts: str) -> DataFrame:
    """A Parquet file whose ``ts`` column is in nanoseconds, as other writers leave it.

    Relies on the session loading such columns as integers, as ours does.
    """
    return spark.read.parquet(path).withColumn(ts, micros_from_nanos(ts))


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """Recordings: one row per run with its three sample arrays."""
    return conform(read_parquet(spark, path), SIGNALS, strict=False)


def list_files(spark: SparkSession, tables: dict[str, str], limit: int | None = None) -> DataFrame:
    """Files of named Parquet tables: dataset, path, length and rows.

    Every table is read, one row per file comes out, with or without rows in it, and a
    table is a file or a folder of files. One that cannot be read has no row. ``limit``
    caps the listing, in the order of dataset and path so that the cap is repeatable.
    """
    path, length = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length")
    files = spark.createDataFrame([], "dataset string, path string, length long")
    counts = spark.createDataFrame([], "dataset string, path string, n_rows long")
    for name, place in tables.items():
        try:
            rows = spark.read.parquet(place)
        except AnalysisException:
            continue
        # The files by themselves, contents unread: no row tells of a file without any.
        present = spark.read.format("binaryFile").load(place).select(F.lit(name).alias("dataset"), path, length)
        files = files.unionByName(present.where(r"path not rlike '/_(common_)?metadata$'"))
        counted = rows.select(F.lit(name).alias("dataset"), path).groupBy("dataset", "path")
        counts = counts.unionByName(counted.agg(F.count(F.lit(1)).alias("n_rows")))
    listing = files.join(counts, ["dataset", "path"], "left").select(
        "path", "length", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "dataset"
    )
    return listing if limit is None else listing.orderBy("dataset", "path").limit(limit)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """A folder as a stream, at most ``max_files`` new files per trigger."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of files."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(place).isDirectory():
        return stream_files(spark, path, schema, max_files=max_files)
    return stream_files(spark, place.getParent().toString(), schema, place.getName(), max_files=max_files)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    max_offsets: int | None = None,
) -> DataFrame:
    """A Kafka topic as a stream of ``value`` strings, from the earliest offset.

    ``max_offsets`` caps the records of a trigger; without it a stream catches up.
    Needs the Kafka connector package on the cluster.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def concatenate(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def with_defaults(df: DataFrame, **values: str) -> DataFrame:
    """Add constant metadata columns, leaving the ones that already exist."""
    missing = {name: F.lit(value) for name, value in values.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df
