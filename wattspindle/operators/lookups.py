"""Equi-joins of facts with a side that is expected to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.constants import BROADCAST_BYTES

#: What a row takes in a broadcast besides its values: header, null bits, hash entry.
_ROW = 40
_VARIABLE = (T.StringType, T.BinaryType)
_FIXED = (T.NumericType, T.BooleanType, T.DatetimeType, T.TimestampNTZType)


def broadcast_bytes(lookup: DataFrame, most: int = BROADCAST_BYTES) -> int | None:
    """What ``lookup`` takes in memory, or None where no bound can be told or it exceeds ``most``.

    Rows are counted first. Texts are measured only if the rows alone would fit, so a table
    that is too large is not read for its size.
    """
    fields = lookup.schema.fields
    if not all(isinstance(f.dataType, (*_VARIABLE, *_FIXED)) for f in fields):
        return None
    size = lookup.count() * (_ROW + 8 * len(fields))
    texts = [F.octet_length(f"`{f.name}`") for f in fields if isinstance(f.dataType, _VARIABLE)]
    if texts and size <= most:
        # A value is padded to words.
        total = sum((F.coalesce(F.sum(t + 8), F.lit(0)) for t in texts[1:]), F.coalesce(F.sum(texts[0] + 8), F.lit(0)))
        size += lookup.agg(total).first()[0]
    return size if size <= most else None


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: str | list[str],
    how: str = "left",
    small: bool | None = None,
    most: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` with ``lookup``, broadcasting it only when its size allows it.

    ``small`` says whether ``broadcast_bytes`` found a size; without it the lookup is
    measured, so it should be cheap to read. A larger one is joined by a shuffle, in which
    adaptive execution splits the partitions of hot keys on the fact side.
    """
    if broadcast_bytes(lookup, most) is not None if small is None else small:
        lookup = F.broadcast(lookup)
    return facts.join(lookup, keys, how)


def attach_one_row(facts: DataFrame, row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every fact, as a scalar subquery."""
    packed = row.select(F.struct("*").alias("packed")).scalar()
    return facts.withColumn("_row", packed).select(*facts.columns, "_row.*")
