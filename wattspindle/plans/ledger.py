"""What a run wrote, measured while it was written, and kept as a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattspindle.session import new_scratch_path
from wattspindle.sources.versions import Versions

ENTRY = "run string, stage string, n_rows long, metrics map<string, string>, recorded_at string"
ATTEMPTS = 20
#: Rows that are measured when they are written.
Measured = Callable[[DataFrame], DataFrame]


def period(ts: str) -> dict[str, Column]:
    """First and last time of the rows."""
    return {"first": F.min(ts), "last": F.max(ts)}


def fleet() -> dict[str, Column]:
    """Machines and operations. Their names are gathered, which a fleet's size bounds."""
    return {
        "machines": F.size(F.collect_set("machine_id")),
        "operations": F.size(F.collect_set("operation")),
    }


class Ledger:
    """Entries of the stages of runs: rows and measures taken by the write itself.

    A stage is written once and not read again to be counted: the rows pass a set of
    aggregates on their way into the files. An entry is made after the write has succeeded
    and never changes, so a stage that was written twice has two entries, the later of which
    counts. ``path`` holds the entries of all runs.
    """

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path.rstrip("/"), run
        self._entries = Versions(spark, path)

    def note(self, stage: str, n_rows: int, metrics: dict | None = None) -> dict:
        """Add an entry."""
        given = {k: str(v) for k, v in (metrics or {}).items() if v is not None}
        entry = {
            "run": self.run, "stage": stage, "n_rows": n_rows, "metrics": given,
            "recorded_at": dt.datetime.now(dt.UTC).isoformat(timespec="microseconds"),
        }
        for _ in range(ATTEMPTS):
            try:
                self._entries.commit(self._entries.latest() + 1, entry)
                return entry
            except FileExistsError:
                continue
        raise RuntimeError(f"no entry of {self.path} was to be had")

    def save(
        self, stage: str, write: Callable[[Measured], None], measures: dict[str, Column] | None = None
    ) -> dict:
        """Let ``write`` write a stage in one job, and note it.

        ``write`` is given a function that measures the rows it is applied to: the last
        thing before the files, as tasks before a shuffle may run, and count, again.
        ``measures`` are aggregates other than distinct counts, by name.
        """
        seen = Observation()
        columns = [F.count(F.lit(1)).alias("n_rows"), *[c.alias(k) for k, c in (measures or {}).items()]]
        write(lambda rows: rows.observe(seen, *columns))
        found = dict(seen.get)
        return self.note(stage, found.pop("n_rows"), found)

    def materialize(
        self, rows: DataFrame, stage: str, measures: dict[str, Column] | None = None
    ) -> DataFrame:
        """``rows``, written as an intermediate table, noted and read back."""
        path = new_scratch_path(self.spark, stage)
        self.save(stage, lambda measured: measured(rows).write.parquet(path), measures)
        return self.spark.read.schema(rows.schema).parquet(path)

    def note_input(self, rows: DataFrame, stage: str) -> dict:
        """Note the rows of an input table; Parquet tells them by its footers."""
        return self.note(stage, rows.count())

    def entries(self, run: str | None = None) -> DataFrame:
        """All entries, or those of one run."""
        try:
            found = self.spark.read.schema(ENTRY).json(f"{self.path}/_versions/[0-9]*.json")
        except AnalysisException:  # no entry yet
            found = self.spark.createDataFrame([], ENTRY)
        return found if run is None else found.where(F.col("run") == run)

    def stages(self) -> DataFrame:
        """(stage, n_rows, metrics) of this run, the latest entry of each stage."""
        newest = F.max_by(F.struct("n_rows", "metrics"), "recorded_at").alias("entry")
        return self.entries(self.run).groupBy("stage").agg(newest).select("stage", "entry.*")


def run_summary(ledger: Ledger, stage: str) -> DataFrame:
    """Rows, machines, operations and period of a stage, as its write measured them."""
    metric = F.col("metrics")
    return ledger.stages().where(F.col("stage") == stage).select(
        F.col("n_rows").alias("total_records"),
        metric["machines"].cast("long").alias("machines"),
        metric["operations"].cast("long").alias("operations"),
        metric["first"].cast("timestamp_ntz").alias("min_ts"),
        metric["last"].cast("timestamp_ntz").alias("max_ts"),
    )
