from __future__ import annotations

import datetime as dt

from wattspindle.sources import documents

PRICES = """<?xml version="1.0"?>
<Publication_MarketDocument xmlns="urn:any:thing">
  <TimeSeries>
    <Period>
      <timeInterval><start>2020-01-01T23:00Z</start><end>2020-01-02T02:00Z</end></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><price.amount>10.5</price.amount></Point>
      <Point><position>3</position><price.amount>-2.25</price.amount></Point>
    </Period>
    <Period>
      <timeInterval><start>2020-01-02T02:00Z</start><end>2020-01-02T02:30Z</end></timeInterval>
      <resolution>PT15M</resolution>
      <Point><position>2</position><price.amount>7</price.amount></Point>
    </Period>
  </TimeSeries>
  <TimeSeries><mRID>no period</mRID></TimeSeries>
</Publication_MarketDocument>"""

INDEX = """<m:GenericData xmlns:m="urn:m" xmlns:g="urn:g"><m:DataSet>
  <g:Series>
    <g:SeriesKey><g:Value id="freq" value="M"/><g:Value id="geo" value="DE"/></g:SeriesKey>
    <g:Obs><g:ObsDimension value="2019-02"/><g:ObsValue value="101.5"/></g:Obs>
    <g:Obs><g:ObsDimension value="2019-03"/><g:ObsValue value="n/a"/></g:Obs>
    <g:Obs><g:ObsDimension value="2019-04"/></g:Obs>
  </g:Series>
  <g:Series>
    <g:SeriesKey><g:Value id="geo" value="FR"/></g:SeriesKey>
    <g:Obs><g:ObsDimension value="2019-02"/><g:ObsValue value="99"/></g:Obs>
  </g:Series>
</m:DataSet></m:GenericData>"""


def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_price_document_reads_all_periods_and_keeps_gaps(spark):
    rows = documents.parse_price_documents(payloads(spark, PRICES)).collect()
    assert {(r["timestamp"], r["price_eur_mwh"]) for r in rows} == {
        (dt.datetime(2020, 1, 1, 23), 10.5),
        (dt.datetime(2020, 1, 2, 1), -2.25),
        (dt.datetime(2020, 1, 2, 2, 15), 7.0),
    }


def test_broken_price_document_gives_no_rows(spark):
    broken = payloads(spark, "<Publication_MarketDocument><TimeSeries>", "no xml at all", PRICES)
    assert documents.parse_price_documents(broken).count() == 3


def test_index_document_filters_country_and_skips_bad_values(spark):
    rows = documents.parse_index_documents(payloads(spark, INDEX), "DE", "STATISTICS").collect()
    assert [tuple(r) for r in rows] == [
        (dt.datetime(2019, 2, 1), "DE", 101.5, "STATISTICS", "Index (2015=100)")
    ]


def test_price_instants_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = documents.parse_price_documents(payloads(spark, PRICES)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert min(r["timestamp"] for r in rows) == dt.datetime(2020, 1, 1, 23)
