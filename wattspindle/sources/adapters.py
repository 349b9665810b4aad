"""Domain tables derived from the star-schema test tables.

Each function maps the whole source table. The ``bronze_*`` functions write their
result once, as the bronze layer would hold it, for readers that scan it repeatedly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspindle.constants import FALLBACK_SOURCE, INDEX_UNIT
from wattspindle.functions import timebase
from wattspindle.functions.risk import half_up
from wattspindle.operators.windows import hourly_mean, rollup_chunks
from wattspindle.schemas import BRONZE_PRICES, BRONZE_TELEMETRY, conform
from wattspindle.session import materialize

ANOMALY_LEVEL = 150.0
PRICE_SOURCE = "EXCHANGE"
INDEX_SOURCE = "STATISTICS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_machine() -> Column:
    return F.concat(F.lit("M0"), (F.col("user_id") % 4 + 1).cast("string"))


def telemetry_rows(events: DataFrame) -> DataFrame:
    """Feature rows from ``events``, batch or stream."""
    value = F.col("value")
    serial = F.lpad(F.col("event_id").cast("string"), 12, "0")
    return events.select(
        F.col("ts").alias("timestamp"),
        event_machine().alias("machine_id"),
        F.col("event_type").alias("operation"),
        value.alias("rms_x"),
        (value * 0.5).alias("rms_y"),
        (value * 0.25).alias("rms_z"),
        (value > ANOMALY_LEVEL).cast("int").alias("label"),
        F.concat_ws("_", event_machine(), "event_type", serial).alias("filename"),
        F.get_json_object("props", "$.k").try_cast("int").alias("sample_count"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_rows(table(spark, sf_dir, "events"))


def telemetry_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).withColumn(
        "timestamp_15min", timebase.minute_bucket("timestamp")
    )


def bronze_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full 15-minute telemetry, written once."""
    rollup = rollup_chunks(telemetry_chunks(spark, sf_dir))
    return materialize(conform(rollup, BRONZE_TELEMETRY), "bronze-telemetry")


def silver_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the 15-minute telemetry that silver reads.

    Leaving out the sample file keeps the rollup a hash aggregate (a string
    minimum forces a sort) and spares the JSON parsing.
    """
    rollup = rollup_chunks(telemetry_chunks(spark, sf_dir))
    return rollup.drop("sample_file", "total_samples")


def price_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular price quotes of three markets from ``events``, some of them stand-ins."""
    kind = F.col("event_type")
    stand_in = F.get_json_object("props", "$.k").try_cast("int") % 5 == 0
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price_eur_mwh"),
        F.when(stand_in, FALLBACK_SOURCE).otherwise(PRICE_SOURCE).alias("source"),
        F.when(kind.isin("purchase", "view"), "DE").when(kind == "click", "FR").otherwise("IT").alias("country_code"),
    )


def hourly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(hourly_mean(price_quotes(spark, sf_dir)), BRONZE_PRICES)


def order_country() -> Column:
    return F.element_at(F.array(F.lit("DE"), F.lit("FR"), F.lit("IT")), (F.col("o_custkey") % 3 + 1).cast("int"))


def industrial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly index per country from ``orders``."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            timebase.month_key("o_orderdate").cast("timestamp_ntz").alias("date"),
            order_country().alias("country_code"),
        )
        .agg(F.avg("o_totalprice").alias("industrial_production_index"))
        .select(
            "date",
            "country_code",
            "industrial_production_index",
            F.lit(INDEX_SOURCE).alias("source"),
            F.lit(INDEX_UNIT).alias("unit"),
        )
    )


def current_industrial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index moved to the months of ``events``, so that silver has matches."""
    return moved_to_events(industrial(spark, sf_dir))


def moved_to_events(index: DataFrame) -> DataFrame:
    """The first order month becomes January 2023, so that 2024 is covered."""
    shifted = F.add_months(
        F.lit("2023-01-01").cast("date"),
        F.months_between(F.col("date").cast("date"), F.lit("1995-01-01").cast("date")).cast("int"),
    )
    return index.withColumn("date", shifted.cast("timestamp_ntz"))


def telemetry_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of telemetry from ``lineitem``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("timestamp_15min"),
        F.concat(F.lit("M0"), (F.col("l_suppkey") % 3 + 1).cast("string")).alias("machine_id"),
        F.concat("l_returnflag", "l_linestatus").alias("operation"),
        F.col("l_quantity").alias("avg_rms_x"),
        (F.col("l_discount") * 100).alias("avg_rms_y"),
        (F.col("l_tax") * 100).alias("avg_rms_z"),
        (F.col("l_quantity") > 45).cast("int").alias("has_anomaly"),
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings from ``embeddings``: all 64 values, 22 for the first axis and 21 for the others."""
    month = (F.col("vec_id") % 12).cast("int")
    machine = F.concat(F.lit("M0"), (F.col("vec_id") % 3 + 1).cast("string"))
    operation = F.concat(F.lit("OP"), F.lpad(F.col("label").cast("string"), 2, "0"))
    parts = {"x": (1, 22), "y": (23, 21), "z": (44, 21)}
    axes = {a: F.slice("embedding", first, count) for a, (first, count) in parts.items()}
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("run_id"),
        machine.alias("machine_id"),
        operation.alias("operation"),
        F.add_months(F.lit("2020-01-01").cast("date"), month).cast("timestamp_ntz").alias("base_ts"),
        (F.col("vec_id") % 20 == 0).cast("int").alias("label"),
        *[values.alias(f"accel_{a}") for a, values in axes.items()],
        F.concat(machine, F.lit("_"), operation, F.lit("_"), F.col("vec_id").cast("string"))
        .alias("filename"),
    )


def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run file paths from ``events`` in every name form, some unparsable."""
    machine = event_machine()
    month = F.date_format("ts", "MMM")
    year = F.date_format("ts", "yyyy")
    operation = F.concat(F.lit("OP"), F.lpad((F.col("user_id") % 15).cast("string"), 2, "0"))
    run = F.lpad(F.col("event_id").cast("string"), 9, "0")
    form = F.col("event_id") % 4
    name = (
        F.when(form == 0, F.concat_ws("_", machine, month, year, operation, run))
        .when(form == 1, F.concat_ws("_", machine, month, year, operation))
        .when(form == 2, F.concat_ws("_", machine, F.concat(month, year), run))
        .otherwise(F.concat(F.lit("notes"), run))
    )
    folder = (
        F.when(F.col("value") <= ANOMALY_LEVEL, F.lit("good"))
        .when(F.col("event_id") % 2 == 0, F.lit("bad"))
        .otherwise(F.lit("BAD"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("raw/"), operation, F.lit("/"), folder, F.lit("/"), name, F.lit(".h5"))
        .alias("path"),
    )


def message_rows(events: DataFrame) -> DataFrame:
    """JSON messages from ``events``: stream form, older form and broken ones."""
    event = F.col("event_id")
    value = F.col("value").cast("float")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(
        F.when(event % 13 != 0, event_machine()).alias("machine_id"),
        F.col("event_type").alias("operation"),
        F.col("user_id").cast("string").alias("run_id"),
        F.array(value, -value, value / 2).alias("accel_x"),
        F.array(value / 2, value / 4).alias("accel_y"),
        F.array(value).alias("accel_z"),
        F.when(event % 11 != 0, (F.col("value") > ANOMALY_LEVEL).cast("int")).alias("label"),
        F.lit(3).alias("n_samples"),
        F.lit(2000).alias("sampling_rate_hz"),
    )
    stamp = F.when(event % 23 == 0, F.lit("not a time")).otherwise(iso)
    message = F.struct(
        stamp.alias("timestamp"),
        F.lit("sensor").alias("source"),
        F.concat(F.lit("run_"), event.cast("string")).alias("filename"),
        F.when(event % 7 != 0, (event % 5).cast("int")).alias("chunk_index"),
        F.when(event % 10 != 0, body).alias("payload"),
        F.when(event % 20 == 0, body).alias("data"),
    )
    text = F.to_json(message)
    return events.select(
        F.when(event % 17 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value")
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_rows(table(spark, sf_dir, "events"))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as text, as a file of another system has them, some of them unreadable."""
    event = F.col("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        F.when(event % 23 == 0, F.lit("not a time")).when(event % 41 != 0, iso).alias("timestamp"),
        F.when(event % 13 != 0, event_machine()).alias("machine_id"),
        F.col("event_type").alias("operation"),
        F.when(event % 29 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("rms_x"),
        F.when(event % 31 == 0, F.lit("1e")).when(event % 7 != 0, F.lit("0")).alias("label"),
        event.cast("string").alias("serial"),
    )


def drifted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to some of which a newer sender has added fields."""
    raw, event = table(spark, sf_dir, "events"), F.col("event_id")
    spindle = F.struct(F.col("value").alias("rpm"), F.array(F.lit("a"), F.lit("b")).alias("tools"))
    body = F.struct(
        event_machine().alias("machine_id"),
        F.when(event % 3 == 0, F.col("user_id")).alias("shift"),
        F.when(event % 5 == 0, spindle).alias("spindle"),
        F.array("value", "value").alias("accel_x"),
    )
    message = F.struct(
        F.lit("2024-01-01T00:00:00").alias("timestamp"),
        F.when(event % 4 == 0, F.col("event_type")).alias("site"),
        F.when(event % 4 == 1, event % 2 == 0).alias("replay"),
        F.when(event % 2 == 0, body).alias("payload"),
        F.when(event % 2 == 1, body).alias("data"),
    )
    text = F.to_json(message)
    return raw.select(F.when(event % 19 == 0, F.substring(text, 1, 30)).otherwise(text).alias("value"))


def _element(name: str, *content: Column, attributes: str = "") -> Column:
    opening = f"<{name} {attributes}>" if attributes else f"<{name}>"
    return F.concat(F.lit(opening), *content, F.lit(f"</{name}>"))


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price document per day and country with two half-day periods.

    A document holds at most 24 positions, however many quotes an hour has.
    """
    hourly = hourly_mean(price_quotes(spark, sf_dir)).select(
        "timestamp", "country_code", half_up(F.col("price_eur_mwh"), 4).alias("price")
    )
    hour = F.hour("timestamp")
    point = _element(
        "Point",
        _element("position", (hour % 12 + 1).cast("string")),
        _element("price.amount", F.col("price").cast("string")),
    )
    start = F.date_format(
        F.col("timestamp").cast("date").cast("timestamp_ntz")
        + F.make_dt_interval(F.lit(0), F.when(hour < 12, 0).otherwise(12)),
        "yyyy-MM-dd'T'HH:mm'Z'",
    )
    periods = (
        hourly.groupBy(F.col("timestamp").cast("date").alias("day"), "country_code", start.alias("start"))
        .agg(F.concat_ws("", F.sort_array(F.collect_list(point))).alias("points"))
        .select(
            "day",
            "country_code",
            _element(
                "Period",
                _element("timeInterval", _element("start", F.col("start"))),
                _element("resolution", F.lit("PT60M")),
                F.col("points"),
            ).alias("period"),
        )
    )
    return (
        periods.groupBy("day", "country_code")
        .agg(F.concat_ws("", F.sort_array(F.collect_list("period"))).alias("periods"))
        .select(
            "day",
            _element(
                "Publication_MarketDocument",
                _element("TimeSeries", F.col("periods")),
                attributes='xmlns="urn:example:prices"',
            ).alias("payload"),
        )
    )


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index document per year with one series per country, prefixed namespaces."""
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(order_country().alias("country"), timebase.month_key("o_orderdate").alias("month"))
        .agg(half_up(F.avg("o_totalprice"), 2).alias("value"))
    )
    observation = F.concat(
        F.lit('<g:Obs><g:ObsDimension value="'),
        F.date_format("month", "yyyy-MM"),
        F.lit('"/><g:ObsValue value="'),
        F.col("value").cast("decimal(20,2)").cast("string"),
        F.lit('"/></g:Obs>'),
    )
    key = F.concat(
        F.lit('<g:SeriesKey><g:Value id="freq" value="M"/><g:Value id="geo" value="'),
        F.col("country"),
        F.lit('"/></g:SeriesKey>'),
    )
    series = monthly.groupBy("country", F.year("month").alias("year")).agg(
        F.concat_ws("", F.sort_array(F.collect_list(observation))).alias("observations")
    )
    return (
        series.select("year", _element("g:Series", key, F.col("observations")).alias("series"))
        .groupBy("year")
        .agg(F.concat_ws("", F.sort_array(F.collect_list("series"))).alias("all_series"))
        .select(
            "year",
            _element(
                "m:GenericData",
                _element("m:DataSet", F.col("all_series")),
                attributes='xmlns:m="urn:example:message" xmlns:g="urn:example:generic"',
            ).alias("payload"),
        )
    )
