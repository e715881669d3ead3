"""Whole runs against a store."""

import datetime as dt

import pytest
from conftest import bag
from pyspark.sql import functions as F

from mirrorspan.model import DATE_INCREMENTAL, RunContext, Strategy, TableRef
from mirrorspan.operators.window import window_replace
from mirrorspan.plans.runner import Replicator

AS_OF = dt.date(2001, 8, 1)
CTX = RunContext(AS_OF, 30)
FULL = RunContext(AS_OF, 30, True)


def strategies(unit):
    return [
        Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit=unit),
        Strategy("lineitem", DATE_INCREMENTAL, ("o_orderdate",), parent="orders",
                 join_columns=("l_orderkey",), parent_columns=("o_orderkey",), partition_unit=unit),
    ]


@pytest.fixture
def source(spark, folder):
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


@pytest.fixture
def stale(source):
    ghosts = lambda df, key: df.withColumn(key, F.col(key) + 10**9)
    orders, lines = source("orders"), source("lineitem")
    tables = {
        "orders": orders.filter("o_orderkey % 7 <> 0").unionByName(
            ghosts(orders.filter("o_orderkey % 5 = 0"), "o_orderkey")),
        "lineitem": lines.filter("l_orderkey % 7 <> 0").unionByName(
            ghosts(lines.filter("l_orderkey % 5 = 0"), "l_orderkey")),
    }
    return tables.__getitem__


@pytest.mark.parametrize("unit", ["month", "year", None])
def test_incremental_run_equals_the_definition(spark, store, source, stale, unit):
    names = ["lineitem", "orders"]
    Replicator(spark, "shop", stale, names, store, strategies(unit)).run(FULL)
    ledger = Replicator(spark, "shop", source, names, store, strategies(unit)).run(CTX)
    keys = source("orders").filter("o_orderdate >= date'2001-07-02'").select("o_orderkey")
    counts = {r.table_name: (r.rows, r.status) for r in ledger.collect()}
    lines = source("lineitem").join(keys, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    assert counts == {
        "shop_orders": (keys.count(), "SUCCESS"),
        "shop_lineitem": (lines.count(), "SUCCESS"),
    }
    want = window_replace(stale("orders"), source("orders"), ["o_orderdate"], CTX)
    assert bag(store.read("shop_orders")) == bag(want)
    kept = stale("lineitem").join(keys, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    assert bag(store.read("shop_lineitem")) == bag(kept.unionByName(lines))
    again = Replicator(spark, "shop", source, names, store, strategies(unit))
    before = bag(store.read("shop_lineitem"))
    again.run(CTX)
    assert bag(store.read("shop_lineitem")) == before


def test_untouched_partitions_are_not_rewritten(spark, store, source):
    run = Replicator(spark, "shop", source, ["orders"], store, strategies("year"))
    run.run(FULL)
    first = {d for v, d in store.snapshot("shop_orders").dirs if v < "2001"}
    run.run(CTX)
    assert first < {d for _, d in store.snapshot("shop_orders").dirs}
    assert bag(store.read("shop_orders")) == bag(source("orders"))


def test_day_partitions_and_unique_keys(spark, store):
    schema = "id long, day date, v string"
    d = lambda m, x: dt.date(2024, m, x)
    old = spark.createDataFrame([(1, d(5, 9), "a"), (2, d(1, 1), "b"), (3, None, "c"), (4, d(1, 1), "k")], schema)
    new = spark.createDataFrame([(1, d(5, 9), "A"), (2, d(5, 10), "B"), (3, None, "C")], schema)
    ctx = RunContext(d(5, 10), 3)
    for key, survivors in (((), [(2, d(1, 1), "b")]), (("id",), [])):
        s = [Strategy("t", DATE_INCREMENTAL, ("day",), unique_key=key)]
        name = f"db{len(key)}"
        Replicator(spark, name, lambda t: old, ["t"], store, s).run(RunContext(d(5, 10), 3, True))
        Replicator(spark, name, lambda t: new, ["t"], store, s).run(ctx)
        want = [(1, d(5, 9), "A"), (2, d(5, 10), "B"), (3, None, "c"), (4, d(1, 1), "k"), *survivors]
        assert bag(store.read(f"{name}_t")) == sorted(want, key=repr)


def test_first_run_without_a_copy_loads_without_deleting(spark, store, source):
    run = Replicator(spark, "shop", source, ["lineitem", "orders"], store, strategies("year"))
    run.run_table("lineitem", CTX)  # its parent has no copy either
    n = store.read("shop_lineitem").count()
    assert n > 0
    run.run(CTX)
    assert store.read("shop_lineitem").count() == n


def test_failures_are_recorded_and_keep_the_old_version(spark, store, source):
    def broken(name):
        df = source(name)
        if name == "region":
            return df.withColumn("r_name", F.raise_error(F.lit("source went away")).cast("string"))
        return df

    names = ["nation", "region"]
    Replicator(spark, "shop", source, names, store).run(CTX)
    ledger = Replicator(spark, "shop", broken, names, store).run(CTX)
    assert {r.table_name: r.status for r in ledger.collect()} == {
        "shop_nation": "SUCCESS", "shop_region": "FAILED"}
    assert bag(store.read("shop_region")) == bag(source("region"))


def test_missing_reprocess_spec_and_modes(spark, store, source):
    names = ["nation", "region", "part"]
    run = Replicator(spark, "shop", source, names, store)
    run.load("region")
    assert {r.table_name for r in run.run_missing(CTX).collect()} == {"shop_nation", "shop_part"}
    assert run.run_missing(CTX).count() == 0
    flagged = {r.table_name: r.status for r in run.reprocess(CTX, ["region", "part"], 5).collect()}
    assert flagged == {"shop_region": "BELOW_THRESHOLD", "shop_part": "SUCCESS"}
    assert run.load("region", "append") == 5 and store.read("shop_region").count() == 10
    assert run.run_spec("shop.region", CTX) == 5 and store.read("shop_region").count() == 5
    with pytest.raises(ValueError):
        run.run_spec("region", CTX)
    assert TableRef.parse("a.b.c") == TableRef("a", "b.c")


def test_incremental_without_watermark_is_not_appended_twice(spark, store, source):
    run = Replicator(spark, "shop", source, ["region"], store, [Strategy("region", DATE_INCREMENTAL)])
    run.run(CTX)
    run.run(CTX)
    assert store.read("shop_region").count() == 5


def test_user_sql_for_insert_and_delete(spark, store, source, stale):
    sql = Strategy(
        "lineitem", DATE_INCREMENTAL,
        custom_query="SELECT l.* FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey "
                     "WHERE o.o_orderdate >= :cutoff",
        delete_condition="l_orderkey IN (SELECT o_orderkey FROM {orders} WHERE o_orderdate >= :cutoff)",
    )
    orders = Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit=None, priority="high")
    names = ["lineitem", "orders"]
    Replicator(spark, "shop", stale, names, store, [sql, orders]).run(FULL)
    run = Replicator(spark, "shop", source, names, store, [sql, orders])
    run.run_table("orders", CTX)
    run.run_table("lineitem", CTX)
    keys = source("orders").filter("o_orderdate >= date'2001-07-02'")
    on = F.col("l_orderkey") == F.col("o_orderkey")
    want = stale("lineitem").join(keys, on, "left_anti").unionByName(
        source("lineitem").join(keys, on, "left_semi"))
    assert bag(store.read("shop_lineitem")) == bag(want)


def test_parallel_tables_and_typed_cleaned_loads(spark, store):
    raw = spark.createDataFrame([("1", "nan", "12:00:00"), ("2", "x\0y", None)], "id string, v string, t string")
    types = {"a": [("id", "int unsigned"), ("v", "varchar(9)"), ("t", "time")]}
    run = Replicator(spark, "db", lambda t: raw, ["a", "b", "c"], store, source_types=types, parallel_tables=3)
    assert run.run(CTX).filter("status = 'SUCCESS'").count() == 3
    assert bag(store.read("db_a")) == [(1, None, "12:00:00"), (2, "xy", None)]
    assert dict(store.read("db_b").dtypes)["id"] == "string"


def test_schema_grows_and_keeps_its_types(spark, store):
    day = dt.date(2024, 5, 9)
    old = spark.createDataFrame([(1, 10, day)], "id long, n long, day date")
    new = spark.createDataFrame([(1, 11, day, "x")], "id long, n int, day date, extra string")
    s = [Strategy("t", DATE_INCREMENTAL, ("day",))]
    ctx = RunContext(dt.date(2024, 5, 10), 3)
    Replicator(spark, "db", lambda t: old, ["t"], store, s).run(RunContext(ctx.as_of, 3, True))
    assert Replicator(spark, "db", lambda t: new, ["t"], store, s).run(ctx).first().status == "SUCCESS"
    assert store.read("db_t").dtypes == [("id", "bigint"), ("n", "bigint"), ("day", "date"), ("extra", "string")]
    narrow = new.drop("extra")
    assert Replicator(spark, "db", lambda t: narrow, ["t"], store, s).run(ctx).first().status == "SUCCESS"
    assert bag(store.read("db_t")) == [(1, 11, day, None)]


@pytest.mark.parametrize("unit", [None, "month"])
def test_a_widened_type_rewrites_the_table(spark, store, unit):
    old = spark.createDataFrame([(1, 10, dt.date(2024, 1, 1)), (2, 20, dt.date(2024, 5, 9))], "id long, n int, day date")
    new = spark.createDataFrame([(2, "xx", dt.date(2024, 5, 9))], "id long, n string, day date")
    s = Strategy("t", DATE_INCREMENTAL, ("day",), partition_unit=unit, type_policy="use_most_permissive")
    ctx = RunContext(dt.date(2024, 5, 10), 3)
    Replicator(spark, "db", lambda t: old, ["t"], store, [s]).run_missing(ctx)
    run = Replicator(spark, "db", lambda t: new, ["t"], store, [s])
    assert run.run(ctx).first().status == "SUCCESS"
    assert bag(store.read("db_t")) == [(1, "10", dt.date(2024, 1, 1)), (2, "xx", dt.date(2024, 5, 9))]
    strict = Strategy("t", DATE_INCREMENTAL, ("day",), type_policy="fail")
    back = Replicator(spark, "db", lambda t: old, ["t"], store, [strict])
    assert back.run(ctx).first().status == "FAILED"
    assert store.read("db_t").count() == 2


def test_plan_two_databases_and_ledgers(spark, store, source):
    from mirrorspan.plans.ledger import last_two_runs, latest_anomalies, record_run
    from mirrorspan.plans.runner import run_databases

    one = Replicator(spark, "one", source, ["region"], store)
    two = Replicator(spark, "two", source, ["nation"], store)
    assert [r.action for r in one.plan(CTX).collect()] == ["overwrite"] and not store.tables()
    first = run_databases([one, two], CTX)
    record_run(store, first, dt.datetime(2024, 1, 1))
    two.read = lambda t: source(t).filter("n_nationkey < 3")
    record_run(store, run_databases([one, two], CTX), dt.datetime(2024, 1, 2))
    previous, current = last_two_runs(store)
    assert {r.table_name: r.rows for r in previous.collect()} == {"one_region": 5, "two_nation": 25}
    assert {r.table_name: r.rows for r in current.collect()} == {"one_region": 5, "two_nation": 3}
    assert [r.table_name for r in latest_anomalies(store).collect()] == ["two_nation"]


def test_a_wider_window_of_the_table_counts(spark, store):
    old = spark.createDataFrame([(1, dt.date(2024, 5, 1))], "id long, day date")
    new = spark.createDataFrame([(2, dt.date(2024, 5, 2))], "id long, day date")
    s = [Strategy("t", DATE_INCREMENTAL, ("day",), lookback_days=10)]
    ctx = RunContext(dt.date(2024, 5, 10), 3)
    Replicator(spark, "db", lambda t: old, ["t"], store, s).run_missing(ctx)
    Replicator(spark, "db", lambda t: new, ["t"], store, s).run(ctx)
    assert [r.id for r in store.read("db_t").collect()] == [2]


@pytest.mark.parametrize("orphans", [False, True])
def test_children_of_removed_parents(spark, store, orphans):
    day = dt.date(2024, 5, 9)
    heads = lambda ids: spark.createDataFrame([(i, day) for i in ids], "id long, day date")
    lines = lambda ids: spark.createDataFrame([(i, 1) for i in ids], "id long, n long")
    s = [Strategy("head", DATE_INCREMENTAL, ("day",)),
         Strategy("line", DATE_INCREMENTAL, ("day",), parent="head", join_columns=("id",))]
    ctx = RunContext(dt.date(2024, 5, 10), 3)
    old = {"head": heads([1, 2]), "line": lines([1, 2])}
    new = {"head": heads([1]), "line": lines([1])}
    Replicator(spark, "db", old.__getitem__, ["head", "line"], store, s).run_missing(ctx)
    Replicator(spark, "db", new.__getitem__, ["head", "line"], store, s, delete_orphans=orphans).run(ctx)
    assert {r.id for r in store.read("db_line").collect()} == ({1} if orphans else {1, 2})


def test_required_columns_fail_the_load(spark, store):
    full = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    holes = spark.createDataFrame([(1, "x"), (None, "y")], "id long, v string")
    s = [Strategy("t", required=("id",))]
    assert Replicator(spark, "db", lambda t: full, ["t"], store, s).run(CTX).first().status == "SUCCESS"
    assert Replicator(spark, "db", lambda t: holes, ["t"], store, s).run(CTX).first().status == "FAILED"
    assert bag(store.read("db_t")) == [(1, "x"), (2, "y")]


def test_children_of_failed_parents_are_skipped(spark, store, source):
    def broken(name):
        df = source(name)
        if name == "orders":
            return df.withColumn("o_orderstatus", F.raise_error(F.lit("gone")).cast("string"))
        return df

    names = ["lineitem", "orders"]
    Replicator(spark, "shop", source, names, store, strategies("year")).run(FULL)
    before = bag(store.read("shop_lineitem"))
    ledger = Replicator(spark, "shop", broken, names, store, strategies("year"), record=True).run(CTX)
    rows = {r.table_name: r for r in ledger.collect()}
    assert rows["shop_orders"].status == "FAILED" and "gone" in rows["shop_orders"].error
    assert rows["shop_lineitem"].status == "SKIPPED"
    assert all(r.started_at <= r.finished_at for r in rows.values())
    assert bag(store.read("shop_lineitem")) == before
    assert store.read("run_ledger").count() == 2


def test_repeated_parent_keys_do_not_repeat_children(spark, store):
    day = dt.date(2001, 7, 30)
    parents = spark.createDataFrame([(1, day), (1, day), (2, dt.date(2000, 1, 1))], "k long, day date")
    lines = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    s = [
        Strategy("p", DATE_INCREMENTAL, ("day",)),
        Strategy("l", DATE_INCREMENTAL, ("day",), parent="p", join_columns=("k",)),
    ]
    run = Replicator(spark, "d", {"p": parents, "l": lines}.__getitem__, ["p", "l"], store, s)
    run.run(CTX)
    assert bag(store.read("d_l")) == [(1, "a"), (2, "b")]
    later = parents.unionByName(spark.createDataFrame([(3, day)], parents.schema))
    more = lines.unionByName(spark.createDataFrame([(3, "c")], lines.schema))
    run = Replicator(spark, "d", {"p": later, "l": more}.__getitem__, ["p", "l"], store, s)
    run.run_spec("d.l", CTX)
    run.run_spec("d.l", CTX)
    assert bag(store.read("d_l")) == [(1, "a"), (2, "b"), (3, "c")]


def test_reserved_column_name_is_refused(spark, store):
    df = spark.range(1).withColumn("mirrorspan_part", F.lit("x"))
    ledger = Replicator(spark, "d", lambda t: df, ["t"], store).run(CTX)
    assert "reserved" in ledger.first()["error"]


def test_custom_query_keeps_untouched_partitions(spark, store, source):
    s = [Strategy(
        "orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit="year",
        custom_query="SELECT * FROM {orders} WHERE o_orderdate >= :cutoff",
        delete_condition="o_orderdate >= :cutoff")]
    run = Replicator(spark, "shop", source, ["orders"], store, s)
    run.run(FULL)
    first = {d for v, d in store.snapshot("shop_orders").dirs if v < "2001"}
    run.run(CTX)
    assert first and first < {d for _, d in store.snapshot("shop_orders").dirs}
    assert bag(store.read("shop_orders")) == bag(source("orders"))


def test_window_through_another_table(spark, store):
    day, old = dt.date(2001, 7, 30), dt.date(2000, 1, 1)
    tables = {
        "head": spark.createDataFrame([(1, day), (2, old)], "h long, day date"),
        "line": spark.createDataFrame([(10, 1), (20, 2)], "l long, h long"),
        "cover": spark.createDataFrame([(10, "a"), (20, "b")], "l long, v string"),
    }
    s = [
        Strategy("head", DATE_INCREMENTAL, ("day",)),
        Strategy("line", DATE_INCREMENTAL, ("day",), parent="head", join_columns=("h",)),
        Strategy("cover", DATE_INCREMENTAL, ("day",), parent="head", join_columns=("l",), via="line"),
    ]
    names = list(tables)
    Replicator(spark, "d", tables.__getitem__, names, store, s).run(CTX)
    changed = {**tables, "cover": spark.createDataFrame([(10, "A"), (20, "B")], "l long, v string")}
    ledger = Replicator(spark, "d", changed.__getitem__, names, store, s).run(CTX)
    assert {r.status for r in ledger.collect()} == {"SUCCESS"}
    assert bag(store.read("d_cover")) == [(10, "A"), (20, "b")]
