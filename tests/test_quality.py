from __future__ import annotations

import datetime as dt

from wattspindle.operators import quality
from wattspindle.plans import reports
from wattspindle.sources import readers


def test_null_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    rows = {r["column_name"]: tuple(r)[1:] for r in quality.null_report(df, ["a", "b"]).collect()}
    assert rows == {"a": (1, 33.33, "FAIL"), "b": (2, 66.67, "FAIL")}


def test_reports_on_empty_tables_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([], "a int, ts timestamp_ntz")
    assert quality.null_report(df, ["a"]).first()["status"] == "PASS"
    assert quality.coverage_report(df, "a").first()["missing_pct"] == 0.0


def test_range_report_looks_at_all_rows(spark):
    stamps = [dt.datetime(2020, 5, 1)] * 50 + [dt.datetime(1970, 1, 1)]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    row = quality.range_report(df, "ts").first()
    assert (row["epoch_rows"], row["epoch_status"], row["range_status"]) == (1, "FAIL", "FAIL")
    clean = quality.range_report(df.where("year(ts) > 1970"), "ts").first()
    assert (clean["epoch_status"], clean["range_status"]) == ("PASS", "PASS")


def test_layer_validation_and_presence(spark, tmp_path):
    full, empty = f"{tmp_path}/lake/full", f"{tmp_path}/lake/empty"
    spark.range(3).selectExpr("id", "nullif(id, 1) AS b").write.parquet(full)
    spark.range(0).write.parquet(empty)
    paths = {"full": full, "empty": empty, "absent": f"{tmp_path}/lake/absent"}
    rows = {r["dataset"]: tuple(r)[1:] for r in quality.validate_layer(spark, paths).collect()}
    assert rows == {"full": (3, 2, 1, "PASS"), "empty": (0, 1, 0, "WARN"), "absent": (0, 0, 0, "FAIL")}

    files = readers.list_files(spark, paths)
    expected = spark.createDataFrame([("full",), ("absent",)], "dataset string")
    found = {r["dataset"]: (r["present"], r["n_rows"]) for r in quality.presence_report(files, expected).collect()}
    assert found == {"full": (True, 3), "absent": (False, 0)}
    assert readers.list_files(spark, paths, limit=1).count() == 1


def test_files_without_rows_are_listed(spark, tmp_path):
    one, parts, none = (f"{tmp_path}/{name}" for name in ("one", "parts", "none"))
    spark.range(4).coalesce(1).write.parquet(one)
    spark.range(0).coalesce(1).write.mode("append").parquet(one)
    spark.range(5).selectExpr("id", "id % 2 AS path", "id AS `a b`").coalesce(1).write.partitionBy("path", "a b").parquet(parts)
    spark.range(0).write.parquet(none)
    files = readers.list_files(spark, {"parts": parts, "one": one, "none": none, "absent": f"{tmp_path}/absent"})
    rows = sorted((r["dataset"], r["n_rows"]) for r in files.collect())
    assert rows == [("none", 0), ("one", 0), ("one", 4)] + [("parts", 1)] * 5
    assert files.select("path").distinct().count() == 8 and files.where("length > 0").count() == 8
    capped = readers.list_files(spark, {"parts": parts, "one": one, "none": none}, limit=3).collect()
    assert sorted(r["dataset"] for r in capped) == ["none", "one", "one"]
    expected = spark.createDataFrame([("none",)], "dataset string")
    assert quality.presence_report(files, expected).first()["present"]


def test_run_summary(spark):
    rows = [(dt.datetime(2020, 1, d), f"M0{d % 2}", f"OP0{d % 3}") for d in range(1, 10)]
    df = spark.createDataFrame(rows, "timestamp_15min timestamp_ntz, machine_id string, operation string")
    row = quality.run_summary(df).first()
    assert tuple(row) == (9, 2, 3, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 9))


def test_coverage_matrix_and_pivot_fill_absent_pairs(spark):
    runs = spark.createDataFrame(
        [("M01", "OP00", 0, 5), ("M01", "OP00", 1, 5), ("M02", "OP01", 0, 7)],
        "machine_id string, operation string, label int, sample_count int",
    )
    inventory = reports.dataset_inventory(runs)
    assert {tuple(r)[:2]: r["has_data"] for r in reports.coverage_matrix(inventory).collect()} == {
        ("M01", "OP00"): True, ("M01", "OP01"): False, ("M02", "OP00"): False, ("M02", "OP01"): True,
    }
    pivot = {r["operation"]: tuple(r)[1:] for r in reports.inventory_pivot(inventory).collect()}
    assert pivot == {"OP00": (2, 0), "OP01": (0, 1)}
    every = reports.inventory_pivot(inventory, ["M09", "M02"])
    assert every.columns == ["operation", "M02", "M01"]
    assert tuple(reports.inventory_totals(inventory).first()) == (3, 1, 17)
