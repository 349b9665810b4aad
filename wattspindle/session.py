"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"

_SQL_SETTINGS = {
    # Facts are stored without a zone, so the session must not shift them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Nanosecond timestamps load as integers and are converted on read.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Call-site capture costs several driver round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_LOCAL_SETTINGS = {
    "spark.driver.memory": "8g",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
}

_CLUSTER_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.executor.memory": "8g",
    "spark.executor.cores": "4",
    # AQE merges small shuffle partitions, so start wide.
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Stream state lives off-heap on local disk and in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Adaptive execution does not merge the partitions of stateful streams, and each
# one commits its state in every batch, so a stream wants fewer.
_STREAM_SETTINGS = {"spark.sql.shuffle.partitions": "400"}


def create_session(
    app_name: str = "wattspindle",
    local: bool = True,
    cores: int | str = "*",
    streaming: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session. Callers own it; nothing here ever stops one."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(_SQL_SETTINGS)
    if local:
        builder = builder.master(f"local[{cores}]")
        settings.update(_LOCAL_SETTINGS)
    else:
        settings.update(_CLUSTER_SETTINGS)
        settings.update(_STREAM_SETTINGS if streaming else {})
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("WARN")
    return session


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    A local session without one uses its warehouse folder; a cluster session must
    name a folder that every executor can reach.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """Where intermediate tables of this application lie."""
    return f"{shared_root(spark)}/wattspindle-{spark.sparkContext.applicationId}"


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Used where several branches read one expensive result: the branches then
    scan only the columns they need instead of recomputing it, and a lost
    executor costs a re-read instead of a re-run of the whole lineage.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_layers: dict[tuple, tuple[str, StructType]] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of a table's files; another content shows in one of them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, rest = [], [place]
    while rest:
        for status in store.listStatus(rest.pop()):
            if status.isDirectory():
                rest.append(status.getPath())
            else:
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def layer(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """A table built from ``inputs``, written once in an application for each state of them.

    Whoever asks first has it built; later ones read it, as long as the files of the inputs
    are the same. Layers of states that are gone, and all at the end of the application, may
    be deleted with the scratch folder of the application.
    """
    key = (spark.sparkContext.applicationId, name, *[_files(spark, p) for p in inputs])
    if key not in _layers:
        rows = build()
        path = new_scratch_path(spark, name)
        rows.write.parquet(path)
        _layers[key] = (path, rows.schema)
    path, schema = _layers[key]
    return spark.read.schema(schema).parquet(path)
