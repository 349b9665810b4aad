"""JSON sensor messages: build, parse, filter. Works on batch and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.functions import naming, signal, timebase
from wattspindle.schemas import MESSAGE, MESSAGE_BODY


def message_schema(body: list[str] | None = None) -> T.StructType:
    """The schema of a message whose body has the named fields, by default all of them."""
    known = set(MESSAGE_BODY.fieldNames())
    if body is not None and not set(body) <= known:
        raise ValueError(f"not fields of a message body: {sorted(set(body) - known)}")
    wanted = [f for f in MESSAGE_BODY.fields if body is None or f.name in body]
    return T.StructType(
        [
            T.StructField(f.name, T.StructType(wanted) if f.dataType == MESSAGE_BODY else f.dataType)
            for f in MESSAGE.fields
        ]
    )


def parse_messages(raw: DataFrame, value: str = "value", body: list[str] | None = None) -> DataFrame:
    """JSON text to columns. The body is ``payload`` or, in older messages,
    ``data``; malformed text gives NULL columns and a malformed time gives NULL.

    ``body`` names the body's fields to decode: the parser skips the others, so that a
    reader of scalar fields builds no sample arrays.
    """
    message = F.from_json(F.col(value).cast("string"), message_schema(body), {"mode": "PERMISSIVE"})
    # A generator is evaluated once per row; a plain projection would let the
    # optimizer parse again in every filter and field that refers to it.
    return raw.select(F.inline(F.array(message))).select(
        timebase.parse_instant("timestamp").alias("timestamp"),
        "source",
        "filename",
        "chunk_index",
        "is_last_chunk",
        F.coalesce("payload", "data").alias("payload"),
    )


def unknown_fields(raw: DataFrame, value: str = "value") -> DataFrame:
    """(place, field, kind, n_messages): fields that the schema does not know.

    Senders change before schemas do. The text is opened as a VARIANT, which keeps every
    field with the type it came with; ``place`` is ``message`` or the name of the body.
    Fields that are null count with the kind ``VOID``; malformed text has none.
    """
    opened = raw.select(F.try_parse_json(F.col(value).cast("string")).alias("message"))
    bodies = [f.name for f in MESSAGE.fields if f.dataType == MESSAGE_BODY]
    places = {"message": ("$", MESSAGE.fieldNames()), **{b: (f"$.{b}", MESSAGE_BODY.fieldNames()) for b in bodies}}
    found = F.array(
        *[
            F.struct(
                F.lit(place).alias("place"),
                F.array(*[F.lit(k) for k in known]).alias("known"),
                F.try_variant_get("message", path, "map<string, variant>").alias("fields"),
            )
            for place, (path, known) in places.items()
        ]
    )
    fields = opened.select(F.inline(found)).select("place", "known", F.explode("fields").alias("field", "content"))
    fields = fields.where(~F.array_contains("known", F.col("field")))
    # An array or object is told as such, whatever it holds.
    kind = F.regexp_extract(F.schema_of_variant("content"), r"^[A-Z]+", 0)
    return fields.groupBy("place", "field", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_messages"))


def valid_messages(parsed: DataFrame) -> DataFrame:
    """Messages that carry a body."""
    return parsed.where(F.col("payload").isNotNull())


def describe_messages(parsed: DataFrame) -> DataFrame:
    """Readable fields of valid messages, with defaults for missing keys."""
    body = F.col("payload")
    samples = F.coalesce(body["accel_x"], F.array().cast("array<float>"))
    label = F.coalesce(body["label"], F.lit(0))
    return valid_messages(parsed).select(
        F.coalesce("filename", F.lit("Unknown")).alias("filename"),
        F.coalesce(F.col("chunk_index").cast("string"), F.lit("N/A")).alias("chunk"),
        F.coalesce(body["machine_id"], F.lit("Unknown")).alias("machine_id"),
        label.alias("label"),
        naming.label_name(label).alias("label_name"),
        F.size(samples).alias("n_samples"),
        signal.head(samples).alias("head_x"),
    )


def first_messages(described: DataFrame, count: int, order: list[str]) -> DataFrame:
    """The first ``count`` messages in the given order."""
    return described.orderBy(*order).limit(count)


def message_counts(parsed: DataFrame) -> DataFrame:
    """Messages seen and messages with a body."""
    return parsed.agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if(F.col("payload").isNotNull()).alias("processed"),
    )


def encode_blocks(blocks: DataFrame, sent_at: str = "chunk_ts") -> DataFrame:
    """Blocks of samples to JSON messages, one ``value`` per block."""
    body = F.struct("machine_id", "accel_x", "accel_y", "accel_z", "label")
    iso = F.date_format(sent_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    message = F.struct(
        iso.alias("timestamp"),
        "filename",
        "chunk_index",
        "is_last_chunk",
        body.alias("payload"),
    )
    return blocks.select(F.to_json(message).alias("value"))
