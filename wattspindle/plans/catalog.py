"""Named queries over the star-schema test tables, one per operator family."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspindle.constants import SLIDE, WATERMARK, WINDOW
from wattspindle.functions import naming, timebase
from wattspindle.operators import chunking, harmonize, prices, quality, quantiles, windows
from wattspindle.operators.lookups import attach_one_row
from wattspindle.plans import ledger, marts, reports
from wattspindle.schemas import layer_schema
from wattspindle.session import layer, materialize, new_scratch_path, setting
from wattspindle.sources import adapters, documents, ingest, message_log, messages, readers, sinks
from wattspindle.streaming import streams, trends

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
]
SIGNAL_CHUNK = 8
COUNTRY = "DE"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
#: What to do about a risk class, as a caller of the recommendations would give it.
ACTIONS = [("CRITICAL", "A1", 1), ("HIGH_RISK", "A2", 10), ("MEDIUM_RISK", "A3", 45), ("LOW_RISK", "A4", None)]
UNIT = ["machine_id", "operation"]
PEAKS = "max_rms_x max_rms_y max_rms_z"

QUERIES: dict[str, Query] = {}


def publish(df: DataFrame, digits: int = 6, exact: tuple[str, ...] = ()) -> DataFrame:
    """Engine-neutral output: rounded doubles, dates as text, zone-less times.

    ``exact`` names doubles that are copied or converted, not computed, and need
    no rounding.
    """

    def plain(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if field.name in exact:
            return name
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            decimal = f"try_cast({name} AS DECIMAL(38, 10))"
            return f"CAST(round({decimal}, {digits}) AS DOUBLE) AS {name}"
        if isinstance(field.dataType, T.DateType):
            return f"date_format({name}, 'yyyy-MM-dd') AS {name}"
        if isinstance(field.dataType, T.TimestampType):
            return f"CAST({name} AS TIMESTAMP_NTZ) AS {name}"
        return name

    return df.selectExpr(*[plain(field) for field in df.schema.fields])


def query(digits: int = 6, exact: str = ""):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return publish(build(spark, sf_dir), digits, tuple(exact.split()))

        QUERIES[build.__name__] = run
        return build

    return register


# Layers shared by the queries -------------------------------------------------


def _layer(spark: SparkSession, sf_dir: str, name: str, tables: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer that several queries read, written once for each state of its input tables."""
    return layer(spark, name, [f"{sf_dir}/{t}.parquet" for t in tables.split()], build)


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "silver-telemetry", "events", lambda: adapters.silver_telemetry(spark, sf_dir))


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "bronze-prices", "events", lambda: adapters.hourly_prices(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "bronze-index", "orders", lambda: adapters.industrial(spark, sf_dir))


def _built_silver(spark: SparkSession, sf_dir: str, fill: str | None) -> DataFrame:
    index = adapters.moved_to_events(_index(spark, sf_dir))
    return harmonize.silver(_telemetry(spark, sf_dir), _prices(spark, sf_dir), index, fill, COUNTRY)


def _silver(spark: SparkSession, sf_dir: str, fill: str | None = "mean") -> DataFrame:
    return _layer(spark, sf_dir, f"silver-{fill}", "events orders", lambda: _built_silver(spark, sf_dir, fill))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: marts.daily_metrics(_silver(spark, sf_dir))
    return _layer(spark, sf_dir, "daily-metrics", "events orders", build)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "machine-daily", "events orders", lambda: marts.daily_facts(_daily(spark, sf_dir)))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: marts.machine_summary(_daily(spark, sf_dir))
    return _layer(spark, sf_dir, "machine-summary", "events orders", build)


LAYERS: dict[str, Query] = {
    "telemetry": _telemetry,
    "prices": _prices,
    "index": _index,
    "silver": _silver,
    "silver_unfilled": lambda spark, sf_dir: _silver(spark, sf_dir, None),
    "daily": _daily,
    "facts": _facts,
    "summary": _summary,
}


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dataset_inventory(adapters.telemetry(spark, sf_dir))


# Windows and prices -----------------------------------------------------------


@query(exact=PEAKS)
def telemetry_window_15min(spark, sf_dir):
    return windows.telemetry_windows(adapters.telemetry(spark, sf_dir))


@query()
def telemetry_window_rollup(spark, sf_dir):
    return windows.rollup_chunks(adapters.telemetry_chunks(spark, sf_dir))


@query(4)
def price_hourly_resample(spark, sf_dir):
    return adapters.hourly_prices(spark, sf_dir).orderBy("timestamp")


@query()
def price_first_per_window(spark, sf_dir):
    quotes = adapters.price_quotes(spark, sf_dir).withColumn(
        "price_eur_mwh", F.round("price_eur_mwh", 2)
    )
    return windows.first_price_per_window(quotes)


@query(4)
def price_spine_fallback(spark, sf_dir):
    return prices.price_spine(_prices(spark, sf_dir))


@query(4)
def price_spine_gaps(spark, sf_dir):
    return prices.price_spine(_prices(spark, sf_dir), fallback=None)


@query(4)
def price_forward_fill_15min(spark, sf_dir):
    return prices.forward_fill(_prices(spark, sf_dir))


@query(exact="price_eur_mwh")
def price_bucket_distinct(spark, sf_dir):
    return prices.distinct_bucket_prices(adapters.price_quotes(spark, sf_dir))


@query(exact="price_eur_mwh")
def price_batches_union(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")

    def batch(kind: str) -> DataFrame:
        quotes = events.where(F.col("event_type") == kind).select(
            F.col("ts").alias("timestamp"), F.col("value").alias("price_eur_mwh")
        )
        return readers.with_defaults(quotes, source=kind.upper())

    batches = readers.concatenate(*[batch(kind) for kind in EVENT_TYPES])
    return readers.with_defaults(batches, source="UNUSED", country_code=COUNTRY)


@query(4)
def price_describe(spark, sf_dir):
    hourly = _prices(spark, sf_dir)
    quartiles = quantiles.exact_quantiles(
        hourly, "price_eur_mwh", {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    )
    return attach_one_row(reports.describe_column(hourly, "price_eur_mwh"), quartiles)


# Harmonised facts and marts ---------------------------------------------------


@query()
def harmonize_mean_fill(spark, sf_dir):
    return harmonize.join_prices(
        _telemetry(spark, sf_dir), _prices(spark, sf_dir), "mean", COUNTRY
    ).select("timestamp_15min", *UNIT, "avg_rms_x", "price_eur_mwh")


@query()
def harmonize_ffill(spark, sf_dir):
    return harmonize.join_prices(
        _telemetry(spark, sf_dir), _prices(spark, sf_dir), "ffill", COUNTRY
    ).select("timestamp_15min", *UNIT, "avg_rms_x", "price_eur_mwh")


@query(exact=PEAKS)
def harmonize_windows(spark, sf_dir):
    return harmonize.harmonize_windows(
        windows.telemetry_windows(adapters.telemetry(spark, sf_dir)),
        _prices(spark, sf_dir),
        country=COUNTRY,
    )


@query(2, exact="avg_rms_x avg_rms_y avg_rms_z")
def monthly_index_join(spark, sf_dir):
    return harmonize.join_index(
        adapters.telemetry_long(spark, sf_dir), _index(spark, sf_dir), country=COUNTRY
    )


@query(4)
def silver_enriched(spark, sf_dir):
    return _silver(spark, sf_dir)


@query(4)
def stage_range_filter(spark, sf_dir):
    return marts.stage(_silver(spark, sf_dir), "2024-01-05", "2024-01-20")


@query(4)
def machine_daily_metrics(spark, sf_dir):
    return _daily(spark, sf_dir)


@query(4)
def machine_daily_fact(spark, sf_dir):
    return _facts(spark, sf_dir)


@query(4)
def machine_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


# Reports ----------------------------------------------------------------------


@query(4)
def summary_report(spark, sf_dir):
    return reports.summary_report(_summary(spark, sf_dir))


@query(4)
def daily_drilldown(spark, sf_dir):
    return reports.daily_drilldown(_facts(spark, sf_dir), "M01", "click")


@query(2)
def daily_table(spark, sf_dir):
    return reports.daily_table(marts.with_health(_daily(spark, sf_dir)))


@query(4)
def daily_trend(spark, sf_dir):
    return marts.daily_trend(_daily(spark, sf_dir))


@query()
def health_distribution(spark, sf_dir):
    return reports.health_distribution(marts.with_health(_daily(spark, sf_dir)))


@query()
def stability_mode(spark, sf_dir):
    return reports.dominant_stability(marts.with_stability(_daily(spark, sf_dir)))


@query(4)
def fleet_kpis(spark, sf_dir):
    return reports.fleet_kpis(_summary(spark, sf_dir))


@query(4)
def machine_kpis(spark, sf_dir):
    return reports.machine_kpis(_summary(spark, sf_dir))


@query()
def risk_recommendations(spark, sf_dir):
    actions = spark.createDataFrame(ACTIONS, "risk_level string, action_code string, within_days int")
    return reports.risk_recommendations(_summary(spark, sf_dir), actions)


@query(4)
def daily_vs_average(spark, sf_dir):
    return reports.daily_vs_average(_daily(spark, sf_dir), _summary(spark, sf_dir))


@query(4)
def cost_vibration_scatter(spark, sf_dir):
    return reports.cost_vibration_scatter(_facts(spark, sf_dir))


@query()
def cost_vibration_corr(spark, sf_dir):
    return reports.cost_vibration_corr(_daily(spark, sf_dir))


@query()
def selector_machines(spark, sf_dir):
    return reports.machine_choices(_summary(spark, sf_dir))


@query()
def selector_operations(spark, sf_dir):
    return reports.operation_choices(_summary(spark, sf_dir), "M02")


@query()
def dataset_inventory(spark, sf_dir):
    return _inventory(spark, sf_dir)


@query()
def inventory_pivot(spark, sf_dir):
    return reports.inventory_pivot(materialize(_inventory(spark, sf_dir), "inventory"), ["M02", "M01"])


@query()
def inventory_totals(spark, sf_dir):
    return reports.inventory_totals(_inventory(spark, sf_dir))


@query()
def coverage_matrix(spark, sf_dir):
    # Not every machine does every operation, so some pairs are empty.
    able = F.substring("operation", 3, 2).cast("long") % 4
    machine = F.concat(F.lit("M0"), (F.least(F.col("run_id").cast("long") % 4, able) + 1).cast("string"))
    runs = adapters.signals(spark, sf_dir).withColumn("machine_id", machine)
    counted = runs.withColumn("sample_count", chunking.longest_axis())
    inventory = materialize(reports.dataset_inventory(counted), "inventory")
    return reports.coverage_matrix(inventory)


def _paths(sf_dir: str, *names: str) -> dict[str, str]:
    return {name: f"{sf_dir}/{name}.parquet" for name in names}


# Data quality -----------------------------------------------------------------


@query()
def quality_nulls(spark, sf_dir):
    key_columns = [
        "timestamp_15min", *UNIT, "vibration_rms_x", "energy_price_eur_mwh",
        "industrial_production_index",
    ]
    return quality.null_report(_silver(spark, sf_dir, fill=None), key_columns)


@query()
def quality_coverage(spark, sf_dir):
    joined = harmonize.join_prices(
        _telemetry(spark, sf_dir), _prices(spark, sf_dir), None, COUNTRY
    )
    return quality.coverage_report(joined, "price_eur_mwh")


@query()
def quality_range(spark, sf_dir):
    return quality.range_report(adapters.telemetry(spark, sf_dir), "timestamp")


def _ledger(spark: SparkSession) -> ledger.Ledger:
    return ledger.Ledger(spark, new_scratch_path(spark, "ledger"), "run")


@query()
def run_summary(spark, sf_dir):
    """What the write of silver measured."""
    book = _ledger(spark)
    measures = {**ledger.period("timestamp_15min"), **ledger.fleet()}
    book.materialize(_built_silver(spark, sf_dir, None), "silver", measures)
    return ledger.run_summary(book, "silver")


@query()
def stage_rows(spark, sf_dir):
    """Rows that went into a run and rows of each of its layers, as their writes counted them."""
    book = _ledger(spark)
    book.note_input(adapters.telemetry(spark, sf_dir), "telemetry")
    book.note_input(adapters.price_quotes(spark, sf_dir), "quotes")
    hourly = book.materialize(adapters.hourly_prices(spark, sf_dir), "prices")
    index = book.materialize(adapters.industrial(spark, sf_dir), "index")
    silver = harmonize.silver(
        adapters.silver_telemetry(spark, sf_dir), hourly, adapters.moved_to_events(index), None, COUNTRY
    )
    written = book.materialize(silver, "silver")
    book.materialize(marts.daily_metrics(written), "daily")
    return book.stages().select("stage", "n_rows")


READINGS = layer_schema("timestamp:ntz machine_id:string operation:string rms_x:double label:int")


@query()
def ingest_rejects(spark, sf_dir):
    """Rejected rows by column and reason, and the accepted ones as a line of their own."""
    path = new_scratch_path(spark, "readings")
    found = ingest.ingest(adapters.raw_readings(spark, sf_dir), READINGS, path, ("timestamp", "machine_id"))
    accepted = found.accepted.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("labels"))
    lines = ingest.reject_report(found).withColumn("labels", F.lit(None).cast("long"))
    return lines.unionByName(accepted.withColumns({"column_name": F.lit(""), "reason": F.lit("accepted")}))


@query(exact="rms_x")
def ingest_accepted(spark, sf_dir):
    path = new_scratch_path(spark, "readings")
    return ingest.ingest(adapters.raw_readings(spark, sf_dir), READINGS, path, ("timestamp", "machine_id")).accepted


@query()
def staged_load_time(spark, sf_dir):
    staged = marts.with_load_time(marts.stage(_silver(spark, sf_dir, fill=None)))
    return staged.agg(F.count(F.lit(1)).alias("n_rows"), F.count("loaded_at").alias("n_stamped"))


@query(4)
def mart_table(spark, sf_dir):
    """The period summary saved as a table and read back by name."""
    name = f"machine_summary_{uuid.uuid4().hex}"
    sinks.save_table(_summary(spark, sf_dir), name)
    return spark.table(name)


@query()
def layer_validation(spark, sf_dir):
    return quality.validate_layer(spark, _paths(sf_dir, *TABLES, "absent"))


@query()
def dataset_presence(spark, sf_dir):
    names = F.array(*[F.lit(name) for name in [*TABLES, "absent"]])
    expected = spark.range(1).select(F.explode(names).alias("dataset"))
    report = quality.presence_report(readers.list_files(spark, _paths(sf_dir, *TABLES, "absent")), expected)
    return report.select("dataset", "n_rows", "present", (F.col("bytes") > 0).alias("has_bytes"))


@query()
def file_listing(spark, sf_dir):
    files = readers.list_files(spark, _paths(sf_dir, *TABLES), limit=5)
    return files.select("dataset", "n_rows")


# Signals, names, messages, documents ------------------------------------------


@query()
def signal_chunk_rms(spark, sf_dir):
    return chunking.chunk_features(adapters.signals(spark, sf_dir), SIGNAL_CHUNK)


@query()
def signal_window_rollup(spark, sf_dir):
    chunks = chunking.chunk_features(adapters.signals(spark, sf_dir), SIGNAL_CHUNK)
    return windows.rollup_chunks(chunks)


@query()
def signal_features(spark, sf_dir):
    return chunking.signal_features(adapters.signals(spark, sf_dir))


@query(exact="accel_x accel_y accel_z")
def signal_samples(spark, sf_dir):
    return chunking.explode_samples(adapters.signals(spark, sf_dir))


@query(exact="head_0 head_1 head_2")
def signal_head(spark, sf_dir):
    heads = chunking.signal_head(adapters.signals(spark, sf_dir))
    first = [
        F.try_element_at("head_x", F.lit(i + 1)).cast("double").alias(f"head_{i}") for i in range(3)
    ]
    return heads.select("run_id", "n_samples", *first)


@query()
def chunk_ordinals(spark, sf_dir):
    blocks = adapters.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("run_id"), F.col("turn").alias("chunk_index")
    )
    return chunking.chunk_ordinals(blocks)


@query()
def filename_parse(spark, sf_dir):
    parsed = naming.with_run_parts(adapters.run_files(spark, sf_dir))
    return parsed.select("*", naming.label_from_path("path").alias("label")).drop("path")


@query()
def message_parse(spark, sf_dir):
    raw = adapters.raw_messages(spark, sf_dir)
    parsed = messages.parse_messages(raw, body=["operation", "run_id", "n_samples"])
    return messages.valid_messages(parsed).select(
        "timestamp", "filename", "payload.operation", "payload.run_id", "payload.n_samples"
    )


@query()
def message_describe(spark, sf_dir):
    parsed = messages.parse_messages(adapters.raw_messages(spark, sf_dir))
    return messages.describe_messages(parsed).select(
        "filename", "chunk", "machine_id", "label", "label_name", "n_samples",
        F.try_element_at("head_x", F.lit(1)).alias("head_0"),
    )


@query()
def message_counts(spark, sf_dir):
    return messages.message_counts(messages.parse_messages(adapters.raw_messages(spark, sf_dir), body=["label"]))


@query()
def message_drift(spark, sf_dir):
    """Fields that newer senders add, here to some messages, on both levels."""
    return messages.unknown_fields(adapters.drifted_messages(spark, sf_dir))


@query()
def message_first(spark, sf_dir):
    parsed = messages.parse_messages(adapters.raw_messages(spark, sf_dir))
    described = messages.describe_messages(parsed)
    return messages.first_messages(described, 5, ["filename"]).select("filename", "label_name")


@query()
def message_encode(spark, sf_dir):
    blocks = chunking.chunk_signals(adapters.signals(spark, sf_dir), SIGNAL_CHUNK)
    parsed = messages.parse_messages(messages.encode_blocks(blocks))
    return parsed.select(
        "timestamp", "filename", "chunk_index", "is_last_chunk", "payload.machine_id",
        "payload.label", F.size("payload.accel_x").alias("n_samples"),
    )


@query(4)
def price_xml_parse(spark, sf_dir):
    return documents.parse_price_documents(adapters.price_documents(spark, sf_dir))


@query(2)
def index_xml_parse(spark, sf_dir):
    payloads = adapters.index_documents(spark, sf_dir)
    return documents.parse_index_documents(payloads, "DE", adapters.INDEX_SOURCE)


@query(2)
def market_zones(spark, sf_dir):
    area = naming.market_area(adapters.order_country())
    return (
        adapters.table(spark, sf_dir, "orders")
        .groupBy(area.alias("market_area"), naming.zone_code(area).alias("zone_code"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@query()
def local_time_shift(spark, sf_dir):
    utc = F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate"))
    return adapters.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", timebase.market_wall_clock(utc).alias("local_ts")
    )


@query()
def nanos_to_micros(spark, sf_dir):
    instant = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    ticks = F.unix_micros(instant) * 1000 + F.col("event_id") % 1000
    return adapters.table(spark, sf_dir, "events").select(
        "event_id", timebase.micros_from_nanos(ticks).alias("ts_micros")
    )


@query()
def month_batches(spark, sf_dir):
    bounds = adapters.table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    )
    return prices.month_batches(bounds, "first", "last")


# Streams ----------------------------------------------------------------------


def _event_stream(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    )
    return readers.stream_table(spark, path, schema, max_files=1000)


def _appended(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Run a window stream to its end into Parquet and read the result."""
    path = new_scratch_path(spark, name)
    streams.run_available(streams.to_parquet(frame, path, f"{path}-checkpoint"))
    return spark.read.schema(frame.schema).parquet(path)


def _updated(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    path = new_scratch_path(spark, name)
    streams.run_available(streams.to_upserts(frame, path, f"{path}-checkpoint"))
    return streams.latest_windows(spark, path, frame.schema)


def _window_stream(spark: SparkSession, sf_dir: str, slide: str | None = None) -> DataFrame:
    features = adapters.telemetry_rows(_event_stream(spark, f"{sf_dir}/events.parquet"))
    return streams.windowed(features, slide=slide)


@query(exact=PEAKS)
def stream_window_append(spark, sf_dir):
    return _appended(spark, _window_stream(spark, sf_dir), "stream-append")


@query(exact=PEAKS)
def stream_window_update(spark, sf_dir):
    return _updated(spark, _window_stream(spark, sf_dir), "stream-update")


@query(exact=PEAKS)
def stream_sliding(spark, sf_dir):
    return _appended(spark, _window_stream(spark, sf_dir, SLIDE), "stream-sliding")


@query(exact=PEAKS)
def stream_window_alerts(spark, sf_dir):
    found = streams.alerts(_window_stream(spark, sf_dir))
    return _appended(spark, found, "stream-alerts")


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events before and from the middle of their period, as they arrive in two parts."""
    events = adapters.table(spark, sf_dir, "events")
    ends = events.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(ends[0] + (ends[1] - ends[0]) / 2 if ends[0] else None)
    return [events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)]


@query()
def stream_alerts(spark, sf_dir):
    """Alerts as records arrive, windows still open or not, across a restart of the stream."""
    path = new_scratch_path(spark, "stream-record-alerts")
    for arrived in _halves(spark, sf_dir):
        sinks.append_flat(arrived, f"{path}/in")
        records = adapters.telemetry_rows(_event_stream(spark, f"{path}/in"))
        frame = streams.record_alerts(records)
        streams.run_available(streams.to_parquet(frame, f"{path}/out", f"{path}/checkpoint", by=()))
    alerts = spark.read.schema(frame.schema).parquet(f"{path}/out")
    later = F.col("timestamp") >= F.col("window_start") + F.expr(f"INTERVAL {WINDOW}")
    return alerts.select(
        "window_start",
        *UNIT,
        (F.col("rms_x") > adapters.ANOMALY_LEVEL).alias("anomalous"),
        ((F.col("timestamp") < F.col("window_start")) | later).alias("outside"),
    )


@query(4)
def stream_trend(spark, sf_dir):
    """Trends of closed windows in state per unit, across a restart of the stream."""
    path = new_scratch_path(spark, "stream-trend")
    with setting(spark, *trends.STATE_STORE):
        for arrived in _halves(spark, sf_dir):
            sinks.append_flat(arrived, f"{path}/in")
            features = adapters.telemetry_rows(_event_stream(spark, f"{path}/in"))
            frame = trends.trends(streams.windowed(features))
            streams.run_available(streams.to_parquet(frame, f"{path}/out", f"{path}/checkpoint", by=()))
    return spark.read.schema(frame.schema).parquet(f"{path}/out")


@query()
def stream_log_windows(spark, sf_dir):
    """Messages from a log with offsets, a sixth of it a trigger, across a restart of the stream."""
    path = new_scratch_path(spark, "stream-log")
    for arrived in _halves(spark, sf_dir):
        ordered = arrived.repartitionByRange("ts").sortWithinPartitions("ts")
        _, end = message_log.append_messages(adapters.message_rows(ordered), f"{path}/log")
        raw = message_log.stream_log(spark, f"{path}/log", "windows", max_messages=max(1, end // 6))
        frame = streams.windowed(streams.message_features(raw))
        streams.run_until_idle(streams.to_upserts(frame, f"{path}/out", f"{path}/checkpoint"))
    return streams.latest_windows(spark, f"{path}/out", frame.schema)


@query()
def stream_message_windows(spark, sf_dir):
    raw = adapters.message_rows(_event_stream(spark, f"{sf_dir}/events.parquet"))
    return _updated(spark, streams.windowed(streams.message_features(raw)), "stream-messages")


@query()
def stream_driver(spark, sf_dir):
    """Messages to closed windows in Parquet through the driver, with a processing time."""
    raw = adapters.message_rows(_event_stream(spark, f"{sf_dir}/events.parquet"))
    path = new_scratch_path(spark, "stream-driver")
    running = streams.start(raw, "parquet", f"{path}-checkpoint", path, {"availableNow": True})
    running.awaitTermination()
    return spark.read.parquet(path).where("aggregated_at is not null").drop("aggregated_at")


@query()
def stream_console(spark, sf_dir):
    """What a window stream to the console has taken in, as its progress tells."""
    frame = streams.with_processing_time(_window_stream(spark, sf_dir))
    checkpoint = new_scratch_path(spark, "stream-console")
    done = streams.run_available(streams.to_console(frame, checkpoint))
    rows = sum(p["numInputRows"] for p in done.recentProgress)
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows_taken"), F.lit(done.exception() is None).alias("ended"))


@query(exact=PEAKS)
def stream_late_data(spark, sf_dir):
    """Every 50th event arrives after all others, across a restart of the stream."""
    events = adapters.table(spark, sf_dir, "events")
    late = F.col("event_id") % 50 == 0
    path = new_scratch_path(spark, "stream-late")
    for arrived in (events.where(~late), events.where(late)):
        sinks.append_flat(arrived, f"{path}/in")
        source = _event_stream(spark, f"{path}/in")
        frame = streams.windowed(adapters.telemetry_rows(source), watermark=WATERMARK)
        streams.run_available(streams.to_parquet(frame, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(frame.schema).parquet(f"{path}/out")


# Sinks ------------------------------------------------------------------------


def _content(columns: list[str]) -> Column:
    """A checksum of all cells of all rows, whatever their order."""
    return F.sum(F.xxhash64(*[F.col(c).cast("string") for c in columns]).cast("decimal(20,0)"))


@query()
def sink_roundtrip(spark, sf_dir):
    """Write the bronze telemetry through every batch sink and measure what comes back."""
    bronze = adapters.bronze_telemetry(spark, sf_dir)
    root = new_scratch_path(spark, "sinks")
    sinks.append_partitioned(bronze, f"{root}/by_machine", ["machine_id"])
    sinks.append_flat(bronze, f"{root}/flat")
    sinks.append_partitioned(bronze, f"{root}/by_unit", UNIT)
    sinks.overwrite_partitions(bronze, f"{root}/replaced", UNIT)
    sinks.overwrite_flat(bronze, f"{root}/overwritten")
    sinks.write_compact(bronze, f"{root}/compact", UNIT)
    sinks.write_csv(bronze, f"{root}/csv")

    content = bronze.agg(F.coalesce(_content(bronze.columns), F.lit(0))).first()[0]

    def measured(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("sink"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("total_samples").alias("total_samples"),
            F.min("timestamp_15min").cast("timestamp_ntz").alias("first_window"),
            F.count_distinct("machine_id").alias("machines"),
            (F.coalesce(_content(bronze.columns), F.lit(0)) == content).alias("same_rows"),
        )

    parquet = ["by_machine", "flat", "by_unit", "replaced", "overwritten", "compact"]
    read_back = [
        measured(name, readers.read_parquet(spark, f"{root}/{name}", bronze.schema))
        for name in parquet
    ]
    csv = spark.read.schema(bronze.schema).option("header", True).csv(f"{root}/csv")
    return readers.concatenate(*read_back, measured("csv", csv))
