"""Price and index documents: tables of XML payload strings to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspindle.constants import INDEX_UNIT
from wattspindle.functions import timebase

# Element names of the price document. Namespaces are ignored.
PRICE_DOCUMENT = """
    TimeSeries array<struct<
        Period: array<struct<
            timeInterval: struct<start: string>,
            resolution: string,
            Point: array<struct<position: int, `price.amount`: double>>
        >>
    >>
"""

# Element and attribute names of the index document.
INDEX_DOCUMENT = """
    DataSet struct<
        Series: array<struct<
            SeriesKey: struct<Value: array<struct<_id: string, _value: string>>>,
            Obs: array<struct<
                ObsDimension: struct<_value: string>,
                ObsValue: struct<_value: string>
            >>
        >>
    >
"""

_INTERVAL_START = "yyyy-MM-dd'T'HH:mmX"


def _xml(payload: str | Column, schema: str) -> Column:
    return F.from_xml(payload, schema, {"ignoreNamespace": "true", "mode": "PERMISSIVE"})


def parse_price_documents(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per quoted position, all series and all periods, UTC instants.

    Positions that a document skips stay absent.
    """
    periods = (
        documents.select(_xml(payload, PRICE_DOCUMENT).alias("doc"))
        .select(F.explode("doc.TimeSeries").alias("series"))
        .select(F.explode("series.Period").alias("period"))
    )
    start = timebase.parse_instant(F.col("period.timeInterval.start"), _INTERVAL_START)
    return (
        periods.select(
            timebase.utc_wall_clock(start).alias("start"),
            F.col("period.resolution").alias("resolution"),
            F.explode("period.Point").alias("point"),
        )
        .select(
            timebase.position_instant(
                F.col("start"), F.col("point.position"), F.col("resolution")
            ).alias("timestamp"),
            F.col("point.`price.amount`").alias("price_eur_mwh"),
        )
    )


def parse_index_documents(
    documents: DataFrame, country: str, source: str, payload: str = "payload"
) -> DataFrame:
    """Monthly observations of the series whose ``geo`` key is ``country``."""

    def is_country(key: Column) -> Column:
        return (key["_id"] == "geo") & (key["_value"] == country)

    observations = (
        documents.select(_xml(payload, INDEX_DOCUMENT).alias("doc"))
        .select(F.explode("doc.DataSet.Series").alias("series"))
        .where(F.exists("series.SeriesKey.Value", is_country))
        .select(F.explode("series.Obs").alias("obs"))
    )
    return observations.select(
        timebase.parse_period("obs.ObsDimension._value").cast("timestamp_ntz").alias("date"),
        F.lit(country).alias("country_code"),
        F.col("obs.ObsValue._value").try_cast("double").alias("industrial_production_index"),
        F.lit(source).alias("source"),
        F.lit(INDEX_UNIT).alias("unit"),
    ).where(F.col("date").isNotNull() & F.col("industrial_production_index").isNotNull())
