from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from wattspindle.plans import ledger
from wattspindle.schemas import conform, layer_schema
from wattspindle.sources.ingest import ingest, reject_report

SCHEMA = layer_schema("at:ntz unit:string n:int x:double")
TEXT = "at string, unit string, n string, x string, extra string"
GOOD = ("2024-01-02T03:04:05", "a", "7", "1.5", "e")


@pytest.fixture
def run(spark, tmp_path):
    def go(*rows, columns=TEXT, **options):
        return ingest(spark.createDataFrame(list(rows), columns), SCHEMA, f"{tmp_path}/t", **options)

    return go


def test_rows_and_rejects_come_from_one_pass(run):
    bad = [
        ("noon", "a", "7", "1.5", "e1"), ("2024-01-01", None, "seven", "", "e2"), (None, "b", None, None, None),
        ("2024-01-01", "c", "3000000000", "1e400", "e4"),
    ]
    found = run(GOOD, *bad, required=("unit",))
    assert sorted([tuple(r) for r in found.accepted.collect()], key=str) == [
        (None, "b", None, None), (dt.datetime(2024, 1, 2, 3, 4, 5), "a", 7, 1.5)
    ]
    reasons = {r.raw["extra"]: [tuple(x) for x in r.reasons] for r in found.rejects.collect()}
    assert reasons["e1"] == [("at", "unparsable")]
    assert reasons["e2"] == [("unit", "missing"), ("n", "unparsable"), ("x", "unparsable")]
    assert ("n", "unparsable") in reasons["e4"]
    raws = {r.raw["extra"]: r.raw for r in found.rejects.collect()}
    assert raws["e2"] == {"at": "2024-01-01", "unit": None, "n": "seven", "x": "", "extra": "e2"}


def test_the_write_counts_what_the_table_holds(run):
    rows = [GOOD] * 40 + [("x", "a", "1", "y", None)] * 9 + [(None, None, None, None, None)] * 5
    found = run(*rows, required=("at", "unit"))
    assert (found.total, found.rejected) == (54, 14)
    assert found.accepted.count() == 40 and found.rejects.count() == 14
    report = {(r.column_name, r.reason): r.n_rows for r in reject_report(found).collect()}
    assert report == found.by_reason == {
        ("at", "unparsable"): 9, ("x", "unparsable"): 9, ("at", "missing"): 5, ("unit", "missing"): 5,
    }


def test_missing_and_empty_tables(run, spark, tmp_path):
    found = run(("2024-01-01", "1"), columns="at string, n string")
    assert [tuple(r) for r in found.accepted.collect()] == [(dt.datetime(2024, 1, 1), None, 1, None)]
    empty = ingest(spark.createDataFrame([], TEXT), SCHEMA, f"{tmp_path}/e")
    assert (empty.total, empty.rejected, empty.by_reason) == (0, 0, {})
    assert empty.accepted.collect() == [] and empty.rejects.collect() == []
    with pytest.raises(ValueError, match="raw"):
        ingest(spark.createDataFrame([], TEXT), layer_schema("raw:string"), f"{tmp_path}/c")


def test_own_layers_are_cast_strictly_and_inputs_are_not(spark):
    rows = spark.createDataFrame([("1",), ("x",)], "n string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        conform(rows, layer_schema("n:int")).collect()
    assert [r.n for r in conform(rows, layer_schema("n:int"), strict=False).collect()] == [1, None]


def test_a_ledger_keeps_what_writes_measured(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    book = ledger.Ledger(spark, path, "r1")
    assert book.entries().collect() == [] and book.stages().collect() == []
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 1, d), f"M{d % 2}", "OP") for d in range(1, 8)], "at timestamp_ntz, machine_id string, operation string"
    )
    kept = book.materialize(rows, "silver", {**ledger.period("at"), **ledger.fleet()})
    book.materialize(rows.where("false"), "nothing", ledger.period("at"))
    book.note_input(kept, "input")
    assert {(r.stage, r.n_rows) for r in book.stages().collect()} == {("silver", 7), ("nothing", 0), ("input", 7)}
    assert tuple(ledger.run_summary(book, "silver").first()) == (
        7, 2, 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 7)
    )
    later = ledger.Ledger(spark, path, "r2")
    later.materialize(rows.limit(2), "silver")
    later.materialize(rows.limit(3), "silver")
    assert [(r.stage, r.n_rows) for r in later.stages().collect()] == [("silver", 3)]
    assert book.entries().count() == 5 and {r.n_rows for r in book.entries("r2").collect()} == {2, 3}
