"""Data-quality reports, each from one pass over its table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspindle.constants import EXPECTED_YEARS
from wattspindle.functions import risk


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count, share and PASS/FAIL for each named column."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    )
    return counted.select("total", F.inline(rows)).select(
        "column_name",
        "null_count",
        F.coalesce(risk.rate_pct(F.col("null_count"), F.col("total")), F.lit(0.0)).alias("null_pct"),
        _status(F.col("null_count") == 0).alias("status"),
    )


def coverage_report(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value of ``column`` after a join."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(column).isNull()).alias("missing_records"),
    ).withColumn(
        "missing_pct",
        F.coalesce(risk.rate_pct(F.col("missing_records"), F.col("total_records")), F.lit(0.0)),
    )


def range_report(df: DataFrame, ts: str, years: tuple[int, int] = EXPECTED_YEARS) -> DataFrame:
    """Time range, rows stuck at the epoch year, and whether the range starts in
    the expected years."""
    first_year = F.year("min_ts")
    return df.agg(
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
        F.count_if(F.year(ts) == 1970).alias("epoch_rows"),
    ).select(
        "min_ts",
        "max_ts",
        "epoch_rows",
        _status(F.col("epoch_rows") == 0).alias("epoch_status"),
        _status(first_year.between(*years)).alias("range_status"),
    )


def run_summary(df: DataFrame, ts: str = "timestamp_15min") -> DataFrame:
    """Rows, distinct machines and operations, time range.

    The distinct counts run on the pre-aggregated (machine, operation) pairs, so
    the large table is aggregated once and nothing is expanded per distinct column.
    """
    pairs = df.groupBy("machine_id", "operation").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    return pairs.agg(
        F.sum("n").alias("total_records"),
        F.count_distinct("machine_id").alias("machines"),
        F.count_distinct("operation").alias("operations"),
        F.min("first").alias("min_ts"),
        F.max("last").alias("max_ts"),
    )


def stage_report(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows of every named input and layer of a run."""
    counts = [df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n_rows")) for name, df in stages.items()]
    first, *rest = counts
    for count in rest:
        first = first.unionByName(count)
    return first


def validate_dataset(df: DataFrame, name: str) -> DataFrame:
    """One row: records, columns, nulls over all columns, PASS or WARN."""
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    return df.agg(
        F.lit(name).alias("dataset"),
        F.count(F.lit(1)).alias("records"),
        F.lit(len(df.columns)).alias("column_count"),
        sum(nulls[1:], nulls[0]).alias("null_values"),
    ).withColumn("status", F.when(F.col("records") > 0, F.lit("PASS")).otherwise(F.lit("WARN")))


def validate_layer(spark: SparkSession, datasets: dict[str, str]) -> DataFrame:
    """Validate every named Parquet path; a path that cannot be read is a FAIL row."""
    report = None
    for name, path in datasets.items():
        try:
            row = validate_dataset(spark.read.parquet(path), name)
        except AnalysisException:
            row = spark.range(1).select(
                F.lit(name).alias("dataset"),
                F.lit(0).cast("long").alias("records"),
                F.lit(0).alias("column_count"),
                F.lit(0).cast("long").alias("null_values"),
                F.lit("FAIL").alias("status"),
            )
        report = row if report is None else report.unionByName(row)
    return report


def presence_report(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Files, bytes and rows per expected dataset, absent ones with none.

    ``files`` comes from ``list_files``; ``expected`` has one ``dataset`` name per row.
    """
    found = files.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("bytes"), F.sum("n_rows").alias("n_rows")
    )
    return expected.join(found, "dataset", "left").select(
        "dataset",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("file_count", "bytes", "n_rows")],
        F.col("file_count").isNotNull().alias("present"),
    )
