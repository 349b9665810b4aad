from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest

from wattspindle.operators.asof import asof_join

T0 = dt.datetime(2024, 3, 1)
LEFT = "ts timestamp_ntz, unit string, n long"
RIGHT = "ts timestamp_ntz, unit string, price double, note string"


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def frames(spark, left, right):
    return (
        spark.createDataFrame([(at(h), u, i) for i, (h, u) in enumerate(left)], LEFT),
        spark.createDataFrame([(at(h), u, p, f"n{p}") for h, u, p in right], RIGHT),
    )


def prices(df):
    return {r["n"]: r["price"] for r in df.collect()}


def test_the_latest_row_counts_also_from_days_before(spark):
    left, right = frames(
        spark,
        [(0, "a"), (5, "a"), (5.5, "a"), (30, "a"), (200, "a"), (5, "b"), (5, "c")],
        [(5, "a", 1.0), (6, "a", 2.0), (100, "a", 3.0), (4, "b", 9.0)],
    )
    found = asof_join(left, right, "ts", ["price", "note"], ("unit",))
    assert prices(found) == {0: None, 1: 1.0, 2: 1.0, 3: 2.0, 4: 3.0, 5: 9.0, 6: None}
    assert found.columns == ["ts", "unit", "n", "price", "note"]
    assert {r["note"] for r in found.collect()} == {None, "n1.0", "n2.0", "n3.0", "n9.0"}


def test_rows_that_are_too_old_do_not_match(spark):
    left, right = frames(spark, [(1, "a"), (3, "a"), (30, "a")], [(1, "a", 1.0)])
    assert prices(asof_join(left, right, "ts", ["price"], ("unit",), "2 hours")) == {0: 1.0, 1: 1.0, 2: None}


def test_nulls_match_nothing_and_ties_have_one_answer(spark):
    left, right = frames(
        spark, [(None, "a"), (2, None), (2, "a"), (2, "a")],
        [(None, "a", 7.0), (1, None, 8.0), (1, "a", 5.0), (1, "a", 6.0), (1, "a", 4.0)],
    )
    assert prices(asof_join(left, right, "ts", ["price"], ("unit",))) == {0: None, 1: None, 2: 6.0, 3: 6.0}
    assert prices(asof_join(left, right.where("false"), "ts", ["price"], ("unit",))) == {i: None for i in range(4)}
    assert asof_join(left.where("false"), right, "ts", ["price"]).collect() == []
    with pytest.raises(ValueError, match="unit"):
        asof_join(left, right, "ts", ["unit"])


@pytest.mark.parametrize("by", [("unit",), ()])
def test_it_agrees_with_a_single_machine_join(spark, by):
    rnd = random.Random(len(by))
    left = [(rnd.randrange(2000) / 4, rnd.choice("abc")) for _ in range(400)]
    right = [(rnd.randrange(2000) / 4, rnd.choice("ab"), float(i)) for i in range(60)]
    one, two = frames(spark, left, right)
    found = prices(asof_join(one, two, "ts", ["price"], by, "90 hours"))
    newest = two.toPandas().sort_values(["ts", "price"]).drop_duplicates([*by, "ts"], keep="last")
    expected = pd.merge_asof(
        one.toPandas().sort_values("ts"), newest[["ts", *by, "price"]], on="ts", by=list(by) or None,
        tolerance=pd.Timedelta(hours=90),
    )
    assert found == {r.n: None if pd.isna(r.price) else r.price for r in expected.itertuples()}


def test_a_task_sorts_one_day_of_a_key(spark):
    left, right = frames(spark, [(1, "a")], [(1, "a", 1.0)])
    plan = asof_join(left, right, "ts", ["price"], ("unit",))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(unit" in plan and "__day" in plan.split("hashpartitioning(unit", 1)[1].split(")", 1)[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
