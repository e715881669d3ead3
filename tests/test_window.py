"""Window replace: each case of moved, deleted, missing and undated rows."""

import datetime as dt

import pytest
from conftest import bag
from pyspark.sql import functions as F

from mirrorspan.functions.dates import in_window, outside_window, window_day
from mirrorspan.model import RunContext
from mirrorspan.operators import joins
from mirrorspan.operators.quality import sync_drift
from mirrorspan.operators.window import (
    keys_before_and_after,
    survivors,
    window_keys,
    window_replace,
    window_replace_child,
    window_rows,
)

AS_OF = dt.date(2024, 5, 10)
CTX = RunContext(AS_OF, 3)
NEW, OLD = dt.date(2024, 5, 9), dt.date(2024, 1, 1)


def parents(spark, rows):
    return spark.createDataFrame(rows, "id long, day date, v string")


def children(spark, rows):
    return spark.createDataFrame(rows, "id long, line long")


def test_parent_cases(spark):
    target = parents(spark, [
        (1, NEW, "stale"), (2, NEW, "gone at source"), (3, NEW, "moves out"),
        (4, OLD, "moves in"), (5, None, "undated"), (6, OLD, "old"),
    ])
    source = parents(spark, [
        (1, NEW, "fresh"), (3, OLD, "moved out"), (4, NEW, "moved in"),
        (5, None, "undated changed"), (6, OLD, "old changed"), (7, NEW, "new"),
    ])
    got = bag(window_replace(target, source, ["day"], CTX))
    assert got == bag(parents(spark, [
        (1, NEW, "fresh"),          # replaced
        (4, OLD, "moves in"),       # old copy survives ...
        (4, NEW, "moved in"),       # ... beside the new one
        (5, None, "undated"),       # never deleted, never loaded
        (6, OLD, "old"),            # outside the window
        (7, NEW, "new"),
    ]))                             # 2 deleted, 3 vanished
    strict = bag(window_replace(target, source, ["day"], CTX, unique_key=["id"]))
    assert (4, OLD, "moves in") not in strict and len(strict) == len(got) - 1


def test_drift_reports_what_the_window_leaves_behind(spark):
    source = parents(spark, [(1, NEW, "a"), (3, OLD, "b"), (4, NEW, "c"), (6, OLD, "x")])
    target = parents(spark, [(1, NEW, "a"), (4, OLD, "c"), (4, NEW, "c"), (6, OLD, "y"), (9, OLD, "z")])
    got = dict(bag(sync_drift(source, target, ["id"])))
    assert got == {3: "missing", 4: "duplicate", 6: "changed", 9: "ghost"}


def test_drift_tells_nulls_apart(spark):
    schema = "id long, a string, b string"
    left = spark.createDataFrame([(1, None, "x"), (2, "x", None), (3, None, None)], schema)
    right = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, None, None)], schema)
    assert bag(sync_drift(left, right, ["id"])) == [(1, "changed")]


def test_child_cases(spark):
    refreshed = parents(spark, [(1, NEW, ""), (4, OLD, ""), (7, NEW, "")])
    source = parents(spark, [(1, NEW, ""), (4, OLD, ""), (7, NEW, "")])
    target = children(spark, [(1, 1), (1, 1), (2, 1), (4, 1), (None, 1)])
    incoming = children(spark, [(1, 1), (1, 2), (4, 9), (7, 1), (7, 1), (None, 5)])
    deleted = window_keys(refreshed, ["id"], ["day"], CTX)
    inserted = window_keys(source, ["id"], ["day"], CTX)
    got = bag(window_replace_child(target, incoming, deleted, inserted))
    # Repeated rows stay repeated; 2 is an orphan and stays; NULL keys stay.
    assert got == bag(children(spark, [(1, 1), (1, 2), (2, 1), (4, 1), (7, 1), (7, 1), (None, 1)]))


def test_child_of_vanished_parent_goes_with_both_key_sets(spark):
    before = window_keys(parents(spark, [(2, NEW, "")]), ["id"], ["day"], CTX)
    after = window_keys(parents(spark, [(1, NEW, "")]), ["id"], ["day"], CTX)
    both = keys_before_and_after(before, after)
    got = window_replace_child(children(spark, [(1, 1), (2, 1), (3, 1)]), children(spark, []), both, after)
    assert bag(got) == [(3, 1)]


def test_a_null_parent_key_does_not_empty_the_result(spark):
    keys = window_keys(parents(spark, [(None, NEW, ""), (1, NEW, "")]), ["id"], ["day"], CTX)
    assert keys.rows == 1
    assert bag(joins.rows_without_keys(children(spark, [(1, 1), (2, 1)]), keys)) == [(2, 1)]


def test_refresh_is_idempotent_and_unbounded_window_is_full(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    stale = orders.filter("o_orderkey % 7 <> 0")
    ctx = RunContext(dt.date(2001, 8, 1), 30)
    once = window_replace(stale, orders, ["o_orderdate"], ctx)
    assert bag(window_replace(once, orders, ["o_orderdate"], ctx)) == bag(once)
    everything = RunContext(dt.date(2001, 8, 1), 20_000)
    assert bag(window_replace(stale, orders, ["o_orderdate"], everything)) == bag(orders)


def test_deleted_and_kept_make_up_the_old_target(spark):
    rows = [(1, NEW, ""), (2, OLD, ""), (3, None, ""), (4, dt.date(2030, 1, 1), "")]
    df = parents(spark, rows)
    kept, gone = survivors(df, ["day"], CTX), window_rows(df, ["day"], CTX)
    assert bag(kept.unionByName(gone)) == bag(df)
    assert {r[0] for r in bag(gone)} == {1, 4}  # no upper bound


@pytest.mark.parametrize("days", [(NEW, None), (None, NEW), (None, None), (OLD, OLD), (NEW, OLD)])
def test_one_window_day_decides_like_all_columns(spark, days):
    df = spark.createDataFrame([days], "a date, b date")
    both = [in_window(["a", "b"], CTX), outside_window(["a", "b"], CTX),
            F.coalesce(window_day(["a", "b"]) >= F.lit(CTX.cutoff), F.lit(False))]
    inside, outside, by_day = df.select(*both).first()
    assert outside is not None and bool(inside) is (not outside) is by_day


def test_window_filters_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    ctx = RunContext(dt.date(2001, 8, 1), 3)
    for df in (window_rows(orders, ["o_orderdate"], ctx), survivors(orders, ["o_orderdate"], ctx)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert "GreaterThanOrEqual(o_orderdate" in pushed or "LessThan(o_orderdate" in pushed


@pytest.fixture
def skewed(spark):
    """A third of the children belongs to one parent."""
    parent = parents(spark, [(i, NEW if i % 3 == 0 else OLD, "") for i in range(300)])
    child = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(3)).otherwise(F.col("id") % 600).alias("id"),
        F.col("id").alias("line"),
    )
    return parent, child


def test_large_key_sets_are_shuffled_and_hot_keys_split(spark, skewed, monkeypatch):
    parent, child = skewed
    small = window_keys(parent, ["id"], ["day"], CTX)
    want_in, want_out = bag(joins.rows_with_keys(child, small)), bag(joins.rows_without_keys(child, small))
    assert len(want_in) + len(want_out) == 30_000
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    big = window_keys(parent, ["id"], ["day"], CTX)
    assert small.bytes > 0 and not big.small
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        wide = child.repartition(16, "line")
        for result, want in (
            (joins.rows_with_keys(wide, big), want_in),
            (joins.rows_without_keys(wide, big), want_out),
        ):
            assert bag(result) == want
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan and "Broadcast" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
