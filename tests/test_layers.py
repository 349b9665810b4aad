from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wattspindle.plans.catalog import LAYERS, QUERIES
from wattspindle.session import layer, shared_root


def test_a_layer_is_built_once_for_each_state_of_its_inputs(spark, tmp_path):
    path, built = f"{tmp_path}/in", []
    spark.range(5).write.parquet(path)

    def build():
        built.append(1)
        return spark.read.parquet(path).select((F.col("id") * 2).alias("twice"))

    def read():
        return sorted(r["twice"] for r in layer(spark, "twice", [path], build).collect())

    assert read() == read() == [0, 2, 4, 6, 8] and len(built) == 1
    spark.range(5, 7).write.mode("append").parquet(path)
    assert read() == [0, 2, 4, 6, 8, 10, 12] and len(built) == 2
    spark.range(1).write.mode("overwrite").parquet(path)
    assert read() == [0] and read() == [0] and len(built) == 3


def test_queries_follow_their_inputs(spark, sf_dir, tmp_path):
    for table in ("events", "orders"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    before = QUERIES["machine_summary"](spark, str(tmp_path)).collect()
    assert before == QUERIES["machine_summary"](spark, str(tmp_path)).collect()
    half = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 2 = 0")
    half.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    total = sum(r["total_measurements"] for r in QUERIES["machine_summary"](spark, str(tmp_path)).collect())
    assert 0 < total < sum(r["total_measurements"] for r in before)


def test_every_layer_is_read_from_files(spark, sf_dir):
    for name, build in LAYERS.items():
        plan = build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "Exchange" not in plan, name


def test_a_cluster_session_names_its_shared_folder():
    class Context:
        applicationId = "app"

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext, self.values = Context(master), conf
            self.conf = self

        def get(self, key, default=None):
            return self.values.get(key, default)

    warehouse = {"spark.sql.warehouse.dir": "file:/here/"}
    assert shared_root(Session("local[4]", **warehouse)) == "file:/here"
    named = {"spark.checkpoint.dir": "hdfs://c/shared/"}
    assert shared_root(Session("yarn", **named, **warehouse)) == "hdfs://c/shared"
    with pytest.raises(ValueError, match="shared"):
        shared_root(Session("yarn", **warehouse))
