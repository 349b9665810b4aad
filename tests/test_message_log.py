from __future__ import annotations

import pytest

from wattspindle.sources.message_log import LogReader, append_messages, stream_log
from wattspindle.streaming import streams


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def reader(path, cap=None, group="g", per_task=100):
    return LogReader(f"file://{path}", group, cap, per_task)


def rows(found, start, end):
    out = []
    for part in found.partitions({"offset": start}, {"offset": end}):
        for batch in found.read(part):
            out += zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
    return sorted(out)


def test_offsets_follow_the_order_of_appending(spark, tmp_path):
    path = f"file://{tmp_path}"
    first = [f"a{i}" for i in range(40)]
    assert append_messages(messages(spark, *first).repartition(3), path) == (0, 40)
    assert append_messages(messages(spark), path) == (40, 40)
    assert append_messages(messages(spark, "b0", None, "b2").coalesce(1), path) == (40, 43)
    log = reader(tmp_path, per_task=7)
    assert log.initialOffset() == {"offset": 0} and log.latestOffset() == {"offset": 43}
    everything = rows(log, 0, 43)
    assert [o for o, _ in everything] == list(range(43))
    assert sorted(v for _, v in everything[:40]) == sorted(first)
    assert [v for _, v in everything[40:]] == ["b0", None, "b2"]
    # Any cut of the log gives the same messages at the same offsets.
    for cut in (1, 13, 40, 42):
        assert rows(log, 0, cut) + rows(log, cut, 43) == everything
    assert rows(log, 5, 5) == [] and max(p.value[2] for p in log.partitions({"offset": 0}, {"offset": 43})) <= 7


def test_row_groups_outside_of_a_range_are_not_read(spark, tmp_path):
    import pyarrow.parquet as pq

    append_messages(messages(spark, *[f"{i}" for i in range(10)]).coalesce(1), f"file://{tmp_path}")
    (file,) = tmp_path.glob("data/*/*.parquet")
    pq.write_table(pq.read_table(file), file, row_group_size=3)
    assert rows(reader(tmp_path, per_task=4), 2, 9) == [(i, str(i)) for i in range(2, 9)]


def test_the_cap_holds_across_restarts(spark, tmp_path):
    append_messages(messages(spark, *[str(i) for i in range(10)]), f"file://{tmp_path}")
    log = reader(tmp_path, cap=4)
    assert log.latestOffset() == {"offset": 4}
    again = reader(tmp_path, cap=4)  # goes on from what was told, never back
    assert again.latestOffset() == {"offset": 8} and again.latestOffset() == {"offset": 10}
    assert again.latestOffset() == {"offset": 10}
    again.commit({"offset": 10})
    assert len(list(tmp_path.glob("_groups/g/*.planned"))) == 1
    assert reader(tmp_path, cap=4).latestOffset() == {"offset": 10}
    assert reader(tmp_path, cap=4, group="other").latestOffset() == {"offset": 4}


def test_an_empty_log_has_no_messages(spark, tmp_path):
    log = reader(tmp_path, cap=3)
    assert log.latestOffset() == {"offset": 0} and log.partitions({"offset": 0}, {"offset": 0}) == []


@pytest.fixture
def drained(spark, tmp_path):
    """Run the stream to its end; the batches that ran and every message it wrote."""

    def run(cap, fail_in=None):
        frame = stream_log(spark, f"file://{tmp_path}/log", "q", cap, per_task=5)

        def save(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch_id}")
            if batch_id == fail_in:
                raise RuntimeError("lost after the write")

        writer = frame.writeStream.foreachBatch(save).option("checkpointLocation", f"{tmp_path}/ckpt")
        query = streams.run_until_idle(writer)
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        return sizes, sorted((r["offset"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    return run


def test_a_stream_takes_every_message_once_across_restarts(spark, tmp_path, drained):
    expected = [(i, f"m{i}") for i in range(47)]
    append_messages(messages(spark, *[f"m{i}" for i in range(20)]).coalesce(1), f"file://{tmp_path}/log")
    sizes, found = drained(8)
    assert sizes == [8, 8, 4] and found == expected[:20]
    assert drained(8)[0] == []
    append_messages(messages(spark, *[f"m{i}" for i in range(20, 47)]).coalesce(1), f"file://{tmp_path}/log")
    with pytest.raises(Exception, match="lost after the write"):
        drained(10, fail_in=4)
    sizes, found = drained(10)
    assert found == expected and sum(sizes) == 17


def test_without_a_cap_one_trigger_takes_all(spark, tmp_path, drained):
    append_messages(messages(spark, *[f"m{i}" for i in range(30)]).coalesce(1), f"file://{tmp_path}/log")
    sizes, found = drained(None)
    assert sizes == [30] and len(found) == 30
