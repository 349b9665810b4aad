"""A table of rows by key that batches update, kept as Parquet files under numbered versions.

The table is divided by day. Each day has at most one base, in which a key is once, and a few
changes on top, one from each batch that touched the day. A batch writes its rows once and
commits a manifest that names them; when a day has gathered enough changes, base and changes
are merged into a new base, in a version of its own. Readers take one version: its files
never change, and a day without changes is read as it lies.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.sources.sinks import gathered
from wattspindle.sources.versions import Versions

_DAY, _ORDER, _PLACE = "__day", "__order", "__place"
#: A writer that meets others tries again so often.
ATTEMPTS = 20


class VersionedTable:
    """Upserts of batches, each applied once, and snapshots of any kept version.

    ``keys`` identify a row, ``day`` names the column whose date decides the partition; a key
    must stay on its day. A batch has a key once, as the update mode of a stream does, and of
    the rows of a key that of the latest batch counts. ``merge_after`` changes on a day make
    it due for a merge; ``keep`` versions stay readable, and files that only older ones name
    are deleted. Days are those of UTC, whatever the zone of the session.

    Writers need not know of each other: a version number goes to one of them, the others
    add their rows to the newer version. A merge that meets a newer version is left to the
    next batch. What a crash leaves behind is in no version; ``remove_orphans`` deletes it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        day: str,
        merge_after: int = 8,
        keep: int = 3,
    ):
        self.spark, self.path, self.keys, self.day = spark, path.rstrip("/"), list(keys), day
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self.merge_after, self.keep = merge_after, keep
        self.versions = Versions(spark, path)

    # Reading

    def manifest(self, version: int | None = None) -> tuple[int, dict]:
        """A version's number and manifest; number 0 and no days before the first batch."""
        number = self.versions.latest() if version is None else version
        if number == 0:
            return 0, {"schema": self.schema.simpleString(), "applied": {}, "days": {}}
        found = self.versions.read(number)
        if found["schema"] != self.schema.simpleString():
            raise ValueError(f"the table has the columns {found['schema']}")
        return number, found

    def snapshot(
        self, version: int | None = None, first: str | None = None, last: str | None = None
    ) -> DataFrame:
        """The rows of a version, the newest by default; ``first`` and ``last`` are days, as
        ``2024-01-31``, and spare the reading of files outside of them."""
        days = self.manifest(version)[1]["days"]
        wanted = {
            d: files
            for d, files in days.items()
            if (first is None or d >= f"{_DAY}={first}") and (last is None or d <= f"{_DAY}={last}")
        }
        return self._rows(wanted)

    def _read(self, folders: list[tuple[str, str]]) -> DataFrame:
        """The rows of days of write folders."""
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/data/{folder}/{day}" for day, folder in folders]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _rows(self, days: dict[str, list[str]]) -> DataFrame:
        """The current rows of days; their folders are in the order of writing, base first."""
        settled = self._read([(d, files[0]) for d, files in days.items() if len(files) == 1])
        by_order: dict[int, list] = defaultdict(list)
        for d, files in days.items():
            for i, folder in enumerate(files if len(files) > 1 else []):
                by_order[i].append((d, folder))
        if not by_order:
            return settled
        layers = [self._read(f).withColumn(_ORDER, F.lit(i)) for i, f in by_order.items()]
        changed = layers[0]
        for layer in layers[1:]:
            changed = changed.unionByName(layer)
        newest = Window.partitionBy(*self.keys).orderBy(F.desc(_ORDER))
        current = changed.withColumn(_PLACE, F.row_number().over(newest)).where(f"{_PLACE} = 1")
        return settled.unionByName(current.drop(_ORDER, _PLACE))

    # Writing

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Rows in a new folder, and its days."""
        folder = uuid.uuid4().hex
        dated = rows.select(*self.schema.fieldNames(), self._day_of().alias(_DAY))
        gathered(dated, [_DAY]).write.partitionBy(_DAY).parquet(f"{self.path}/data/{folder}")
        return folder, [d for d in self.versions.folders(f"data/{folder}") if d.startswith(_DAY)]

    def _day_of(self) -> Column:
        if isinstance(self.schema[self.day].dataType, T.TimestampType):
            return F.expr(f"date_from_unix_date(cast(floor(unix_seconds(`{self.day}`) / 86400) as int))")
        return F.col(self.day).cast("date")

    def upsert(self, rows: DataFrame, writer: str, batch: int) -> bool:
        """Apply batch number ``batch`` of a writer; False where it had been applied before.

        A writer's batches come in ascending order, as those of a stream do.
        """
        if self.manifest()[1]["applied"].get(writer, -1) >= batch:
            return False
        folder, days = self._write(rows)
        for _ in range(ATTEMPTS):
            number, manifest = self.manifest()
            if manifest["applied"].get(writer, -1) >= batch:  # a twin of this writer was faster
                self.versions.delete(f"data/{folder}")
                return False
            manifest["applied"][writer] = batch
            for d in days:
                manifest["days"].setdefault(d, []).append(folder)
            try:
                self.versions.commit(number + 1, manifest)
            except FileExistsError:
                continue
            self.merge()
            return True
        raise RuntimeError(f"no version of {self.path} was to be had for batch {batch} of {writer}")

    def merge(self, least: int | None = None) -> list[str]:
        """Merge the days with ``least`` changes or more; returns those merged."""
        least = self.merge_after if least is None else least
        number, manifest = self.manifest()
        due = {d: files for d, files in manifest["days"].items() if len(files) > least}
        if due:
            folder, _ = self._write(self._rows(due))
            manifest["days"] |= {d: [folder] for d in due}
            try:
                self.versions.commit(number + 1, manifest)
            except FileExistsError:
                self.versions.delete(f"data/{folder}")
                return []
        self._forget()
        return sorted(due)

    @staticmethod
    def _folders(manifest: dict) -> set[str]:
        return {folder for files in manifest["days"].values() for folder in files}

    def _forget(self) -> None:
        """Let go of versions beyond ``keep`` and of the files that only they name."""
        numbers = self.versions.numbers()
        kept, old = numbers[-self.keep :], numbers[: -self.keep]
        if not old:
            return
        needed = set().union(*[self._folders(self.versions.read(n)) for n in kept])
        unneeded = set().union(*[self._folders(self.versions.read(n)) for n in old]) - needed
        # Versions go first: a reader that finds one finds its files.
        self.versions.forget(kept[0])
        for folder in unneeded:
            self.versions.delete(f"data/{folder}")

    def remove_orphans(self) -> int:
        """Delete folders that no version names. Only while no batch is being written."""
        needed = set().union(*[self._folders(self.versions.read(n)) for n in self.versions.numbers()])
        orphans = [f for f in self.versions.folders("data") if f not in needed]
        for folder in orphans:
            self.versions.delete(f"data/{folder}")
        return len(orphans)
