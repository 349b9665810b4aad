from __future__ import annotations

import datetime as dt

import pytest

from wattspindle.schemas import layer_schema
from wattspindle.sources.versioned import VersionedTable
from wattspindle.sources.versions import Versions

SCHEMA = layer_schema("at:timestamp unit:string n:long")
T0 = dt.datetime(2024, 1, 1, 12)


def rows(spark, *items):
    """(day, unit, n) rows."""
    return spark.createDataFrame([(T0 + dt.timedelta(days=d), u, n) for d, u, n in items], SCHEMA)


def table(spark, path, **options):
    return VersionedTable(spark, f"file://{path}/t", SCHEMA, ["at", "unit"], "at", **options)


def content(df):
    return sorted([((r["at"] - T0).days, r["unit"], r["n"]) for r in df.collect()], key=str)


def test_the_latest_batch_of_a_key_counts(spark, tmp_path):
    t = table(spark, tmp_path)
    assert content(t.snapshot()) == []
    assert t.upsert(rows(spark, (0, "a", 1), (0, "b", 1), (1, None, 1)), "w", 0)
    assert t.upsert(rows(spark, (0, "a", 2), (2, "c", 2)), "w", 1)
    assert content(t.snapshot()) == [(0, "a", 2), (0, "b", 1), (1, None, 1), (2, "c", 2)]
    assert content(t.snapshot(version=1)) == [(0, "a", 1), (0, "b", 1), (1, None, 1)]
    assert t.upsert(rows(spark, (1, None, 7)), "w", 2)
    assert (1, None, 7) in content(t.snapshot()) and len(content(t.snapshot())) == 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, (0, "a", 1)), "w", 4)
    before = t.manifest()
    assert not t.upsert(rows(spark, (0, "a", 99)), "w", 4)
    assert not t.upsert(rows(spark, (0, "a", 98)), "w", 3)
    assert t.manifest() == before and content(t.snapshot()) == [(0, "a", 1)]
    assert t.upsert(rows(spark, (0, "a", 5)), "other", 4)
    assert content(t.snapshot()) == [(0, "a", 5)]


def test_a_hundred_batches_leave_few_files(spark, tmp_path):
    t, expected = table(spark, tmp_path, merge_after=8, keep=2), {}
    for i in range(100):
        changed = {(i // 40, "a"): i, (i // 40, f"u{i % 5}"): -i}
        t.upsert(rows(spark, *[(d, u, n) for (d, u), n in changed.items()]), "w", i)
        expected |= changed
    assert content(t.snapshot()) == sorted([(d, u, n) for (d, u), n in expected.items()], key=str)
    _, manifest = t.manifest()
    assert set(manifest["days"]) == {f"__day=2024-01-0{d}" for d in (1, 2, 3)}
    assert all(len(files) <= 8 for files in manifest["days"].values())
    assert len(t.versions.numbers()) == 2
    # Three days with a base and at most eight changes each, and what the version before needs.
    files = list(tmp_path.glob("t/data/*/*/*.parquet"))
    assert len(files) <= 2 * 3 * 9
    assert t.remove_orphans() == 0


def test_days_that_are_merged_are_read_as_they_lie(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(4):
        t.upsert(rows(spark, (0, "a", i), (i, "b", i)), "w", i)
    assert t.merge(least=1) == ["__day=2024-01-01"]
    plan = t.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert content(t.snapshot()) == [(0, "a", 3), (0, "b", 0), (1, "b", 1), (2, "b", 2), (3, "b", 3)]
    assert content(t.snapshot(first="2024-01-02", last="2024-01-03")) == [(1, "b", 1), (2, "b", 2)]


def test_writers_that_meet_lose_nothing(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    t.upsert(rows(spark, (0, "a", 1)), "one", 0)
    commit, met = Versions.commit, []

    def late(self, number, manifest):
        if not met:  # another writer takes the number first
            met.append(number)
            other.upsert(rows(spark, (0, "b", 2)), "two", 0)
        return commit(self, number, manifest)

    monkeypatch.setattr(Versions, "commit", late)
    t.upsert(rows(spark, (0, "a", 3)), "one", 1)
    assert met and t.versions.latest() == 3
    assert content(t.snapshot()) == [(0, "a", 3), (0, "b", 2)]
    assert t.manifest()[1]["applied"] == {"one": 1, "two": 0}


def test_what_a_crash_leaves_is_not_read_and_can_be_removed(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, (0, "a", 1)), "w", 0)

    def crash(self, number, manifest):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Versions, "commit", crash)
        with pytest.raises(OSError):
            t.upsert(rows(spark, (0, "a", 2)), "w", 1)
    assert content(t.snapshot()) == [(0, "a", 1)]
    assert t.remove_orphans() == 1 and t.remove_orphans() == 0
    assert t.upsert(rows(spark, (0, "a", 2)), "w", 1)
    assert content(t.snapshot()) == [(0, "a", 2)]


def test_other_columns_are_refused_and_empty_batches_count(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.upsert(rows(spark), "w", 0) and not t.upsert(rows(spark), "w", 0)
    assert content(t.snapshot()) == []
    wrong = VersionedTable(spark, t.path, layer_schema("at:timestamp unit:string n:int"), ["at"], "at")
    with pytest.raises(ValueError, match="columns"):
        wrong.snapshot()


def test_days_do_not_depend_on_the_zone_of_the_session(spark, tmp_path):
    from wattspindle.session import setting

    t = table(spark, tmp_path)
    first = rows(spark, (0, "a", 1))
    with setting(spark, "spark.sql.session.timeZone", "Pacific/Auckland"):
        t.upsert(first, "w", 0)
    t.upsert(rows(spark, (0, "a", 2)), "w", 1)
    assert list(t.manifest()[1]["days"]) == ["__day=2024-01-01"]
    assert [r["n"] for r in t.snapshot().collect()] == [2]
