"""Text tables to typed ones, with a channel for the rows that cannot be read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.functions.timebase import parse_instant
from wattspindle.schemas import conform

_REJECTED, _REASONS, _RAW = "rejected", "reasons", "raw"
REASON = "array<struct<column_name: string, reason: string>>"


@dataclass
class Ingested:
    """``accepted`` rows in the declared schema; ``rejects`` as they came, with reasons;
    ``total`` and ``rejected`` rows and ``by_reason``, counted by the write."""

    accepted: DataFrame
    rejects: DataFrame
    total: int
    rejected: int
    by_reason: dict[tuple[str, str], int]


def ingest(raw: DataFrame, schema: T.StructType, path: str, required: tuple[str, ...] = ()) -> Ingested:
    """Write ``raw``, a table of texts, as typed rows and rejects, in one pass over it.

    A row is rejected as a whole if a text of it does not read as its column's type
    (``unparsable``) or a ``required`` column has none (``missing``); all its reasons are
    kept. A NULL elsewhere is a value like any other, empty text is not. Columns that ``raw``
    lacks are NULL; those that the schema lacks are kept with rejects only.

    Rows and rejects are two partitions of one table under ``path``. The counts come from the
    write: they need no second reading and no job of their own. For columns of simple types.
    """
    if clash := {_REJECTED, _REASONS, _RAW} & set(schema.fieldNames()):
        raise ValueError(f"names that the table needs itself: {sorted(clash)}")
    texts = {f.name: F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None) for f in schema.fields}
    typed = {}
    for f in schema.fields:
        text = texts[f.name].cast("string")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            typed[f.name] = parse_instant(text).cast(f.dataType)
        else:
            typed[f.name] = text.try_cast(f.dataType)
    tests = {}
    for f in schema.fields:
        tests[(f.name, "unparsable")] = texts[f.name].isNotNull() & typed[f.name].isNull()
        if f.name in required:
            tests[(f.name, "missing")] = texts[f.name].isNull()
    reasons = F.array_compact(
        F.array(
            *[
                F.when(test, F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("reason")))
                for (c, r), test in tests.items()
            ]
        )
    ).cast(REASON)
    kept = F.map_from_arrays(
        F.array(*[F.lit(c) for c in raw.columns]), F.array(*[F.col(f"`{c}`").cast("string") for c in raw.columns])
    )
    split = raw.select(*[c.alias(n) for n, c in typed.items()], reasons.alias(_REASONS), kept.alias(_RAW))
    bad = F.size(_REASONS) > 0
    split = split.withColumn(_RAW, F.when(bad, F.col(_RAW))).withColumn(_REJECTED, bad)

    seen = Observation()
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(_REJECTED).alias("rejected")]
    for i, (c, r) in enumerate(tests):
        of = F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("reason"))
        counts.append(F.count_if(F.array_contains(_REASONS, of)).alias(f"n{i}"))
    split.observe(seen, *counts).write.partitionBy(_REJECTED).parquet(path)
    found = seen.get
    written = raw.sparkSession.read.schema(split.schema).parquet(path)
    return Ingested(
        accepted=conform(written.where(~F.col(_REJECTED)), schema),
        rejects=written.where(_REJECTED).select(_REASONS, _RAW),
        total=found["total"],
        rejected=found["rejected"],
        by_reason={test: found[f"n{i}"] for i, test in enumerate(tests) if found[f"n{i}"]},
    )


def reject_report(found: Ingested) -> DataFrame:
    """(column_name, reason, n_rows) of all rejects; a row counts under each of its reasons."""
    each = found.rejects.select(F.inline(_REASONS))
    return each.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
