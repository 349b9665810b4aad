"""Shared pieces: tables in the shared folder, ranks without hot groups, components."""

from __future__ import annotations

import io
import math
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.session import shared_root

#: A word is a maximal run of anything but ASCII white space; ``bytes.split()`` cuts alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Null identifiers order before all others.
NULL_ID = -(2**63)
MB = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in a local session without one, the warehouse."""
    return shared_root(spark)


class Table:
    """A table written to the shared folder: it cuts lineage and outlives executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/llm/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """For tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let executors import this package, wherever the driver has it from; once a session.

    The package's sources go as one archive to the shared folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(top.rglob("*.py")):
            packed.write(source, f"{top.name}/{source.relative_to(top)}")
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/code-{uuid.uuid4().hex}.zip")
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = store.create(path)
    out.write(bytearray(archive.getvalue()))
    out.close()
    context.addPyFile(store.makeQualified(path).toString())
    _shipped.add(context.applicationId)


def partitions(spark: SparkSession, amount: float, per_partition: float) -> int:
    """Enough partitions for ``amount``, never fewer than the session's own number."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(amount / per_partition))


def schema_of(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


def extended(df: DataFrame, spec: str) -> T.StructType:
    """The schema of ``df`` with the columns of ``spec`` behind it."""
    return T.StructType([*df.schema.fields, *schema_of(spec).fields])


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that a result would clash with, in any spelling Spark sees as the same."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def id_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches where their texts reach ``limit`` bytes; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        yield batch.slice(begin)


def rank_in(
    df: DataFrame, keys: list[str], order: list[str], name: str, seed: int = 0, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Number the rows of each key from 0, in the order of a seeded hash of ``order``.

    A key may hold any share of the rows: its rows are dealt to 256 drawers by the
    hash, drawers are counted with map-side sums, and only within a drawer are rows
    sorted. Rows that agree in every order column go by ``ties``; those that agree in them
    too are alike and may swap numbers.
    """
    drawn = df.withColumn("__hash", F.xxhash64(F.lit(seed), *order))
    drawn = drawn.withColumn("__drawer", F.expr("pmod(__hash, 256)"))
    counts = drawn.groupBy(*keys, "__drawer").agg(F.count("*").alias("__n"))
    # One row per key: the running sums of at most 256 drawers, in a map.
    before = counts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("__drawer", "__n"))).alias("__drawers")
    )
    before = before.select(
        *keys,
        F.explode(
            F.expr(
                "transform(__drawers, (x, i) -> struct(x.__drawer as __drawer, "
                "aggregate(slice(__drawers, 1, i), 0L, (s, y) -> s + y.__n) as __before))"
            )
        ).alias("__d"),
    ).select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__d.__drawer").alias("__at"), "__d.__before"
    )
    inside = Window.partitionBy(*keys, "__drawer").orderBy("__hash", *order, *ties)
    ranked = drawn.withColumn("__rank", F.row_number().over(inside) - 1)
    same = F.col("__drawer") == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return ranked.join(before, same).select(
        *df.columns, (F.col("__rank") + F.col("__before")).alias(name)
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link to another: the smallest node reachable.

    Large-star and small-star rounds turn each component into a star around its
    smallest node, in a number of rounds that grows with the logarithm of its size.
    Minima are combined map-side, hubs are split by the skew join, every round is
    written to the shared folder, and nothing is collected but a count and a checksum.
    """
    table = Table(edges.select("a", "b").where("a <> b").distinct(), "links")
    seen = _checksum(table.df)
    while True:
        if not seen[0]:
            break
        old = table.df
        both = old.union(old.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("x"), F.col("m").alias("y"))
            .where("x <> y")
            .distinct()
        )
        nearest = large.groupBy("x").agg(F.min("y").alias("m"))
        small = (
            large.join(nearest, "x")
            .select(F.explode(F.array("x", "y")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        new = Table(small, "links")
        table.drop()
        table, before, seen = new, seen, _checksum(new.df)
        if before == seen:
            break
    stars = table.df
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select("b", "b").distinct()
    )


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def deal(sizes: dict[int, int], leaves: int, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First group and number of groups of each leaf, and the number of groups in all.

    Leaves that follow each other share a group up to ``room`` rows; larger ones get
    several groups of their own.
    """
    first, parts = np.zeros(leaves, np.int64), np.ones(leaves, np.int64)
    group = held = 0
    for leaf in range(leaves):
        size = sizes.get(leaf, 0)
        if held and held + size > room:
            group, held = group + 1, 0
        first[leaf], parts[leaf] = group, max(1, -(-size // room))
        held += size
        if parts[leaf] > 1:
            group, held = group + int(parts[leaf]), 0
    return first, parts, group + 1
