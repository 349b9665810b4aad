"""A log of messages in Parquet files that streams read by offset, without a broker.

Every append is a segment: its files lie in a folder of their own, and a numbered manifest
names them with their rows and the offset of the first. The offset of a message is its place
in the log. ``message_log`` is a streaming source over it: it tells the newest offset, at most
a given number of messages after the one told before, cuts the messages of a batch into
partitions by file and row, and reads only those rows.

The log must lie in a store that ``pyarrow`` can open by its address, as driver and executors
read it without Spark.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from wattspindle.sources.versions import Versions

# Executors get the reader itself and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOURCE = "message_log"
SCHEMA = "value string, offset long"
#: Messages that one task reads at most.
PER_TASK = 100_000
_MANIFEST = re.compile(r"(\d{12})\.json")
_PLAN = re.compile(r"(\d{20})\.planned")


def append_messages(messages: DataFrame, path: str, attempts: int = 20) -> tuple[int, int]:
    """Add the ``value`` of each row as one segment; returns its first offset and the next one.

    Of writers that meet, one takes the place and the others come behind it. Offsets follow
    the files, in the order of their names, and the rows in them.
    """
    spark = messages.sparkSession
    versions, folder = Versions(spark, path), f"data/{uuid.uuid4().hex}"
    messages.select(F.col("value").cast("string")).write.parquet(f"{versions.path}/{folder}")
    rows = spark.read.parquet(f"{versions.path}/{folder}").groupBy(F.col("_metadata.file_name").alias("file"))
    counts = sorted((r["file"], r["n"]) for r in rows.agg(F.count("*").alias("n")).collect())
    for _ in range(attempts):
        number = versions.latest()
        begin = versions.read(number)["end"] if number else 0
        end = begin + sum(n for _, n in counts)
        files = [[f"{folder}/{name}", n] for name, n in counts]
        try:
            versions.commit(number + 1, {"begin": begin, "end": end, "files": files})
        except FileExistsError:
            continue
        return begin, end
    raise RuntimeError(f"no place in {path} was to be had")


class LogReader(DataSourceStreamReader):
    """Offsets and partitions of one stream.

    The engine does not say where a batch begins when it asks for the newest offset, so the
    reader notes, under the stream's ``group``, each offset before it tells it, and goes on
    from the note after a restart. A stop between note and batch makes the next batch larger
    by one step; the engine's checkpoint decides what is read, every message once.
    """

    def __init__(self, path: str, group: str, cap: int | None, per_task: int):
        self.address, self.group, self.cap, self.per_task = path, group, cap, per_task
        self.segments: dict[int, dict] = {}
        self.told: int | None = None

    def _open(self) -> tuple[pa.fs.FileSystem, str]:
        address = self.address if "://" in self.address else re.sub("^file:", "", self.address)
        return pa.fs.FileSystem.from_uri(address)

    def _names(self, folder: str, pattern: re.Pattern) -> list[int]:
        store, root = self._open()
        found = store.get_file_info(pa.fs.FileSelector(f"{root}/{folder}", allow_not_found=True))
        return sorted(int(m[1]) for m in (pattern.fullmatch(f.base_name) for f in found) if m)

    def _segments(self) -> list[dict]:
        """All segments so far; a manifest never changes and is read once."""
        store, root = self._open()
        for number in self._names("_versions", _MANIFEST):
            if number not in self.segments:
                with store.open_input_stream(f"{root}/_versions/{number:012d}.json") as source:
                    self.segments[number] = json.loads(source.read())
        return [self.segments[n] for n in sorted(self.segments)]

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def latestOffset(self) -> dict:
        segments = self._segments()
        end = segments[-1]["end"] if segments else 0
        if self.cap is None:
            return {"offset": end}
        if self.told is None:
            self.told = max(self._names(f"_groups/{self.group}", _PLAN), default=0)
        step = min(end, self.told + self.cap)
        if step > self.told:
            store, root = self._open()
            folder = f"{root}/_groups/{self.group}"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{step:020d}.planned") as note:
                note.write(b"")
            self.told = step
        return {"offset": self.told}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Some rows of a file each: (file, rows to skip, rows to take, offset of the first)."""
        first, last, out = start["offset"], end["offset"], []
        for segment in self._segments():
            if segment["end"] <= first or segment["begin"] >= last:
                continue
            at = segment["begin"]
            for file, rows in segment["files"]:
                low, high = max(first, at), min(last, at + rows)
                for begin in range(low, high, self.per_task):
                    take = min(self.per_task, high - begin)
                    out.append(InputPartition((file, begin - at, take, begin)))
                at += rows
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        name, first, left, offset = partition.value
        store, root = self._open()
        with pa.parquet.ParquetFile(store.open_input_file(f"{root}/{name}")) as file:
            begin, skip, groups = 0, 0, []
            for i in range(file.num_row_groups):
                rows = file.metadata.row_group(i).num_rows
                if begin + rows > first and begin < first + left:
                    skip = skip if groups else first - begin
                    groups.append(i)
                begin += rows
            for batch in file.iter_batches(row_groups=groups, columns=["value"]):
                part = batch.slice(skip, left)
                skip = max(0, skip - batch.num_rows)
                if part.num_rows:
                    offsets = pa.array(range(offset, offset + part.num_rows), pa.int64())
                    values = part.column(0).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([values, offsets], names=["value", "offset"])
                    offset, left = offset + part.num_rows, left - part.num_rows
                if not left:
                    return

    def commit(self, end: dict) -> None:
        """Forget notes that the engine has gone beyond."""
        if self.cap is None:
            return
        store, root = self._open()
        for old in self._names(f"_groups/{self.group}", _PLAN):
            if old < end["offset"]:
                store.delete_file(f"{root}/_groups/{self.group}/{old:020d}.planned")


class MessageLog(DataSource):
    """``message_log``, with the options ``path``, ``group``, ``maxMessages`` and ``perTask``."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        cap = self.options.get("maxMessages")
        return LogReader(
            self.options["path"],
            self.options.get("group", "default"),
            int(cap) if cap else None,
            int(self.options.get("perTask", PER_TASK)),
        )


def stream_log(
    spark: SparkSession,
    path: str,
    group: str = "default",
    max_messages: int | None = None,
    per_task: int = PER_TASK,
) -> DataFrame:
    """A log as a stream of (value, offset), from its first message on.

    ``max_messages`` caps what a trigger takes; streams that share a log need a ``group``
    each then. Without it a trigger takes all there is.
    """
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(SOURCE).option("path", path).option("group", group).option("perTask", per_task)
    if max_messages is not None:
        reader = reader.option("maxMessages", max_messages)
    return reader.load()
