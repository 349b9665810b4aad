"""Explicit schemas of every layer; readers never infer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "ntz": T.TimestampNTZType(),
    "floats": T.ArrayType(T.FloatType()),
}


def layer_schema(spec: str) -> T.StructType:
    """``"name:type name:type"`` to a struct type."""
    pairs = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SIGNALS = layer_schema(
    "run_id:string machine_id:string operation:string base_ts:ntz label:int "
    "accel_x:floats accel_y:floats accel_z:floats filename:string"
)
CHUNK_FEATURES = layer_schema(
    "timestamp_15min:ntz machine_id:string operation:string rms_x:double rms_y:double "
    "rms_z:double label:int filename:string sample_count:int"
)
BRONZE_TELEMETRY = layer_schema(
    "timestamp_15min:ntz machine_id:string operation:string avg_rms_x:double "
    "avg_rms_y:double avg_rms_z:double has_anomaly:int total_samples:long sample_file:string"
)
BRONZE_PRICES = layer_schema(
    "timestamp:ntz price_eur_mwh:double source:string country_code:string"
)
BRONZE_INDUSTRIAL = layer_schema(
    "date:ntz country_code:string industrial_production_index:double source:string unit:string"
)
SILVER = layer_schema(
    "timestamp_15min:ntz machine_id:string operation:string vibration_rms_x:double "
    "vibration_rms_y:double vibration_rms_z:double has_anomaly:boolean "
    "energy_price_eur_mwh:double industrial_production_index:double "
    "estimated_power_kwh:double energy_cost_eur:double anomaly_risk_score:double"
)

STREAM_FEATURES = layer_schema(
    "timestamp:timestamp filename:string machine_id:string operation:string run_id:string "
    "label:int sampling_rate_hz:int rms_x:double rms_y:double rms_z:double peak_accel:double "
    "n_samples:int processed_at:timestamp"
)
STREAM_WINDOWS = layer_schema(
    "window_start:timestamp window_end:timestamp machine_id:string operation:string "
    "avg_rms_x:double avg_rms_y:double avg_rms_z:double max_rms_x:double max_rms_y:double "
    "max_rms_z:double has_anomaly:int n_records:long aggregated_at:timestamp"
)
_DAILY = (
    "measurement_date:date machine_id:string operation:string total_measurements:long "
    "anomaly_count:long anomaly_rate_pct:double avg_vibration_x:double avg_vibration_y:double "
    "avg_vibration_z:double max_vibration_x:double max_vibration_y:double max_vibration_z:double "
    "vibration_magnitude:double avg_energy_price:double min_energy_price:double "
    "max_energy_price:double daily_energy_cost:double avg_power_consumption:double "
    "avg_industrial_index:double avg_anomaly_risk:double"
)
DAILY_METRICS = layer_schema(_DAILY)
MACHINE_DAILY = layer_schema(
    f"{_DAILY} machine_health_status:string vibration_stability:string cost_per_kwh:double "
    "created_at:timestamp"
)
MACHINE_SUMMARY = layer_schema(
    "machine_id:string operation:string first_measurement:date last_measurement:date "
    "days_with_data:long total_measurements:long total_anomalies:long overall_anomaly_rate:double "
    "overall_avg_vibration_x:double overall_avg_vibration_y:double overall_avg_vibration_z:double "
    "peak_vibration_x:double peak_vibration_y:double peak_vibration_z:double "
    "avg_vibration_magnitude:double avg_energy_price_overall:double total_energy_cost:double "
    "avg_power_consumption_overall:double avg_industrial_index_overall:double risk_level:string"
)

# One message schema that covers the stream form, the producer form (chunk
# position, fewer payload fields) and the older form with the body under ``data``.
MESSAGE_BODY = layer_schema(
    "operation:string machine_id:string run_id:string accel_x:floats accel_y:floats "
    "accel_z:floats label:int n_samples:int sampling_rate_hz:int"
)
MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("is_last_chunk", T.BooleanType()),
        T.StructField("payload", MESSAGE_BODY),
        T.StructField("data", MESSAGE_BODY),
    ]
)
KAFKA_VALUE = T.StructType([T.StructField("value", T.StringType())])


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select, order and cast columns to a layer schema.

    Between own layers a value that does not fit is an error. Where tables come in,
    ``strict=False`` makes it NULL; ``sources.ingest`` keeps such rows apart instead.
    """

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return column
        return (column.cast(field.dataType) if strict else column.try_cast(field.dataType)).alias(field.name)

    return df.select([typed(field) for field in schema.fields])
