"""Scratch folders: the cluster's own, the warehouse only on a local master."""

from types import SimpleNamespace

import pytest

from mirrorspan import session


def fake(master, folder=None):
    known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/data/wh"}
    conf = SimpleNamespace(get=lambda key, default=None: known.get(key) or default)
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used_and_always_fresh():
    a = session.scratch_dir(fake("yarn", "hdfs://x/cp/"), "load")
    assert a.startswith("hdfs://x/cp/load-") and a != session.scratch_dir(fake("yarn", "hdfs://x/cp/"), "load")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake("spark://host:7077"), "load")


def test_local_master_may_fall_back():
    assert session.scratch_dir(fake("local[2]"), "load").startswith("/data/wh/scratch-")


def test_scratch_folders_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    path = session.scratch_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.drop_scratch(spark) >= 1
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(path)


def test_local_frames_are_local_relations(spark):
    df = session.local_frame(spark, [("a", ["x"], None), ("b", [], 2)], "n string, w array<string>, k bigint")
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in df.orderBy("n").collect()] == [("a", ["x"], None), ("b", [], 2)]
    assert session.local_frame(spark, [], "n string").count() == 0
