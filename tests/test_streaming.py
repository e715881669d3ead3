"""The file stream gives what the batch gives, over several files and a restart."""

import datetime as dt

import pytest
from conftest import bag
from pyspark.sql import functions as F

from mirrorspan.model import DATE_INCREMENTAL, RunContext, Strategy
from mirrorspan.operators.window import window_replace
from mirrorspan.plans.runner import Replicator
from mirrorspan.streaming import incremental as inc

CTX = RunContext(dt.date(2001, 8, 1), 400)


@pytest.fixture
def files(spark, folder, tmp_path):
    """The orders in four files, added in two steps."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    path = str(tmp_path / "in")

    def add(part):
        orders.filter(F.col("o_orderkey") % 2 == part).repartition(2, "o_orderkey").write.mode("append").parquet(path)

    return orders, path, add


def run(spark, orders, path, write, checkpoint):
    inc.run_to_end(inc.start(inc.stream_files(spark, path, orders.schema, files_per_batch=1), write, checkpoint))


def test_append_with_restart(spark, store, files, tmp_path):
    orders, path, add = files
    write = inc.append_batches(store, "db", "t", "s")
    for part in (0, 1):
        add(part)
        run(spark, orders, path, write, str(tmp_path / "cp"))
    assert bag(store.read("db_t")) == bag(orders)
    assert store.snapshot("db_t").version >= 4


def test_replayed_batch_is_not_added_again(spark, store, files):
    orders, _, _ = files
    write = inc.append_batches(store, "db", "t", "s")
    write(orders, 0)
    write(orders, 0)
    assert store.read("db_t").count() == orders.count()
    inc.append_batches(store, "db", "t", "another")(orders, 0)
    assert store.read("db_t").count() == 2 * orders.count()


@pytest.mark.parametrize("unit", [None, "year"])
def test_window_replace(spark, store, files, tmp_path, unit):
    orders, path, add = files
    stale = orders.filter("o_orderkey % 7 <> 0").withColumn("o_totalprice", F.col("o_totalprice") - 1)
    strategy = Strategy("t", DATE_INCREMENTAL, ("o_orderdate",), partition_unit=unit)
    Replicator(spark, "db", lambda _: stale, ["t"], store, [strategy]).run_missing(CTX)
    write = inc.replace_window_batches(store, "db", strategy, CTX, "run-1")
    for part in (0, 1):
        add(part)
        run(spark, orders, path, write, str(tmp_path / "cp"))
    want = bag(window_replace(stale, orders, ["o_orderdate"], CTX))
    assert bag(store.read("db_t")) == want
    again = inc.replace_window_batches(store, "db", strategy, CTX, "run-2")
    run(spark, orders, path, again, str(tmp_path / "cp2"))
    assert bag(store.read("db_t")) == want


def test_a_failing_batch_fails_the_stream(spark, store, files, tmp_path):
    orders, path, add = files
    add(0)

    def broken(batch, batch_id):
        raise RuntimeError("no space")

    with pytest.raises(Exception, match="no space"):
        run(spark, orders, path, broken, str(tmp_path / "cp"))
    assert not store.exists("db_t")


def test_new_checkpoint_under_the_same_name(spark, store, files, tmp_path):
    orders, path, add = files
    write = inc.append_batches(store, "db", "t", "s")
    add(0)
    run(spark, orders, path, write, str(tmp_path / "cp"))
    other = str(tmp_path / "other")
    orders.filter("o_orderkey = 3").coalesce(1).write.parquet(other)
    run(spark, orders, other, write, str(tmp_path / "cp2"))
    n = orders.filter("o_orderkey % 2 = 0").count()
    assert store.read("db_t").count() == n + orders.filter("o_orderkey = 3").count()


def test_child_windows_are_refused(store):
    child = Strategy("l", DATE_INCREMENTAL, ("day",), parent="p", join_columns=("k",))
    with pytest.raises(ValueError, match="parent"):
        inc.replace_window_batches(store, "db", child, CTX, "s")
