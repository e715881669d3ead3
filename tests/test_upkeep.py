"""Skipping index, kept views, streams of children, hash tree, inclusion dependencies."""

import datetime as dt
import decimal
import itertools

import pandas as pd
import pytest
from conftest import bag
from pyspark.sql import functions as F

from mirrorspan.model import DATE_INCREMENTAL, RunContext, Strategy
from mirrorspan.operators import hash_tree, inclusion, maintain, views
from mirrorspan.operators.joins import key_set, rows_with_keys
from mirrorspan.operators.quality import sync_drift
from mirrorspan.plans.runner import Replicator
from mirrorspan.registry import QUERIES
from mirrorspan.sources import skipping
from mirrorspan.sources.store import NULL_PARTITION
from mirrorspan.streaming import children as ch
from mirrorspan.streaming import incremental as inc

AS_OF = dt.date(2024, 5, 10)
CTX = RunContext(AS_OF, 3)


def days(n):
    return AS_OF - dt.timedelta(days=n)


# -- skipping index ---------------------------------------------------------------------


@pytest.fixture
def keyed(spark):
    """Keys 0 to 9,999 in ten parts of neighbours, and odd keys of a far range in all of them."""
    near = spark.range(10_000).select(
        F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("v"),
        F.concat(F.lit("p"), F.floor(F.col("id") / 1000).cast("string")).alias("part"),
    )
    far = spark.range(200).select(
        (F.col("id") * 2 + 1_000_001).alias("k"), F.lit("far").alias("v"),
        F.concat(F.lit("p"), (F.col("id") % 10).cast("string")).alias("part"),
    )
    return near.unionByName(far)


def keys_of(spark, values):
    return key_set(spark.createDataFrame([(v,) for v in values], "k long"), ["k"])


def test_index_names_the_parts_that_hold_a_key(spark, store, keyed):
    store.overwrite("t", keyed, "part", index=["k"])
    assert store.snapshot("t").index == ("k",)
    for wanted in ([5], [5, 2500], [1_000_001], [1_000_003, 9999], list(range(995, 1005))):
        keys = keys_of(spark, wanted)
        may = store.parts_with_keys("t", keys, ["k"])
        holds = {r[0] for r in rows_with_keys(keyed, keys, ["k"]).select("part").distinct().collect()}
        assert holds <= may and len(may) <= len(holds) + 2
    # The range alone would let every part pass.
    assert len(store.parts_with_keys("t", keys_of(spark, [500_000, 1_000_002]), ["k"])) <= 1
    assert store.parts_with_keys("t", keys_of(spark, []), ["k"]) == set()
    assert store.parts_with_keys("t", keys_of(spark, [5]), ["v"]) is None


def test_index_follows_appends_replaces_and_compaction(spark, store, keyed):
    store.overwrite("t", keyed, "part", index=["k"])
    more = spark.createDataFrame([(20_000, "x", "p3"), (20_001, "y", None)], "k long, v string, part string")
    store.append("t", more)
    assert store.parts_with_keys("t", keys_of(spark, [20_000]), ["k"]) == {"p3"}
    assert store.parts_with_keys("t", keys_of(spark, [20_001]), ["k"]) == {NULL_PARTITION}
    store.replace("t", [more.filter("k = 20000")], lambda p: p == "p4")
    assert "p4" not in store.parts_with_keys("t", keys_of(spark, [4500]), ["k"])
    store.compact("t")
    store.rebuild("t")
    assert store.snapshot("t").index == ("k",)
    assert store.parts_with_keys("t", keys_of(spark, [20_000]), ["k"]) == {"p3"}
    store.drop_old_versions("t", 1)
    assert "p2" in store.parts_with_keys("t", keys_of(spark, [2500]), ["k"])


def test_folders_without_an_index_may_hold_any_key(spark, store, keyed):
    store.overwrite("t", keyed, "part")
    assert store.parts_with_keys("t", keys_of(spark, [5]), ["k"]) is None


def test_index_is_built_in_many_tasks(spark):
    """No one task gets all the bitmaps, and no row stands for a single bit."""
    keys = spark.range(100_000).select((F.col("id") % 40).cast("string").alias(skipping.PART), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = skipping.build(keys, ["id"])
        assert index.rdd.getNumPartitions() > 1
        # Every key sets its bits: 2,500 of a part, up to four each.
        counts = index.groupBy().agg(F.count(F.lit(1)), F.sum(F.expr("bitmap_count(bitmap)"))).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert counts[0] == 40 and 0.75 * 400_000 < counts[1] < 400_000
    assert "Coalesce" not in index._jdf.queryExecution().optimizedPlan().toString()


def test_index_of_composite_and_text_keys(spark, store):
    rows = [(f"a{i}", i % 7, f"p{i // 100}") for i in range(1000)]
    df = spark.createDataFrame(rows, "s string, n int, part string")
    store.overwrite("t", df, "part", index=["s", "n"])
    # A key of another whole-number type hashes alike.
    keys = key_set(spark.createDataFrame([("a250", 250 % 7), ("a251", 6)], "s string, n long"), ["s", "n"])
    assert store.parts_with_keys("t", keys, ["s", "n"]) == {"p2"}


def test_a_run_reads_only_folders_that_can_hold_a_key(spark, store):
    parents = [(k, days(k // 10)) for k in range(300)]
    lines = [(k, n, f"{k}-{n}") for k in range(300) for n in range(3)]
    source = {
        "p": spark.createDataFrame(parents, "id long, day date"),
        "l": spark.createDataFrame(lines, "id long, n int, v string"),
    }
    strategies = [
        Strategy("p", DATE_INCREMENTAL, ("day",), partition_unit="day"),
        Strategy("l", DATE_INCREMENTAL, ("day",), parent="p", join_columns=("id",), partition_unit="day"),
    ]
    run = Replicator(spark, "d", source.__getitem__, ["p", "l"], store, strategies)
    run.run_missing(CTX)
    keys = key_set(source["p"].filter(F.col("day") >= F.lit(CTX.cutoff)).select("id"), ["id"])
    may = store.parts_with_keys("d_l", keys, ["id"])
    assert {days(n).isoformat() for n in range(4)} <= may and len(may) <= 6
    before = set(store.snapshot("d_l").dirs)
    asked = []
    read = store.read

    def counted(table, only=None, **kw):
        df = read(table, only, **kw)
        if table == "d_l":
            asked.append(len(df.inputFiles()))
        return df

    store.read = counted
    run.run(CTX)
    store.read = read
    assert asked and max(asked) <= 6  # of 30 folders
    assert len(before & set(store.snapshot("d_l").dirs)) == 26
    assert bag(store.read("d_l")) == bag(source["l"])


# -- copies keep the unit they have -----------------------------------------------------------


def test_a_run_keeps_the_partitions_of_the_copy(spark, store):
    rows = [(k, days(k % 40)) for k in range(400)]
    source = spark.createDataFrame(rows, "id long, day date")
    for unit in ("month", None, "year"):
        name = f"u_{unit}"
        made = Strategy("t", DATE_INCREMENTAL, ("day",), partition_unit=unit)
        wanted = Strategy("t", DATE_INCREMENTAL, ("day",), partition_unit="day")
        Replicator(spark, name, lambda _: source, ["t"], store, [made]).run_missing(CTX)
        dirs = store.snapshot(f"{name}_t").dirs
        run = Replicator(spark, name, lambda _: source, ["t"], store, [wanted])
        run.run_table("t", CTX)
        snap = store.snapshot(f"{name}_t")
        assert (snap.spec or {}).get("unit") == unit and len(snap.dirs) <= len(dirs) + 1
        assert bag(store.read(f"{name}_t")) == bag(source)
        run.repartition("t")
        assert store.snapshot(f"{name}_t").spec["unit"] == "day"
        assert bag(store.read(f"{name}_t")) == bag(source)


def test_unit_by_measured_rows(spark, store, monkeypatch):
    from mirrorspan.plans import runner

    source = spark.createDataFrame([(k, days(k % 120)) for k in range(1200)], "id long, day date")
    lines = source.select("id").crossJoin(spark.range(9).select(F.col("id").alias("n")))
    read = {"t": source, "l": lines}.__getitem__
    strategies = [
        Strategy("t", DATE_INCREMENTAL, ("day",)),
        Strategy("l", DATE_INCREMENTAL, ("day",), parent="t", join_columns=("id",)),
    ]
    for least, units in ((100_000, (None, None)), (1000, ("year", "month")), (10, ("day", "day"))):
        monkeypatch.setattr(runner, "AUTO_PARTITION_ROWS", least)
        run = Replicator(spark, f"a{least}", read, ["t", "l"], store, strategies)
        run.run_missing(CTX)
        got = tuple((store.snapshot(run.target(t)).spec or {}).get("unit") for t in ("t", "l"))
        assert got == units
        run.run(CTX)
        assert bag(store.read(run.target("l"))) == bag(lines)


# -- kept views -------------------------------------------------------------------------------

KEYS = {"line_header": "id", "header": "id", "line_branch": "b", "branch": "b", "line_amount": "amount",
        "header_date": "day", "branch_name": "name"}


def sales_view():
    return maintain.View(
        "sales", {"headers": "d_p", "lines": "d_l"},
        lambda f: views.daily_sums(f["headers"], f["lines"], KEYS),
        ("day", "branch_key"), "lines", {"headers": ("id",), "lines": ("id",)},
        F.date_format("day", "yyyy-MM-dd"),
    )


@pytest.fixture
def shop(spark, store):
    """A shop whose tables change from run to run, and its replicator."""
    tables = {}
    strategies = [
        Strategy("p", DATE_INCREMENTAL, ("day",), partition_unit="day", index_columns=("id",)),
        Strategy("l", DATE_INCREMENTAL, ("day",), parent="p", join_columns=("id",), partition_unit="day"),
    ]

    def put(parents, lines):
        tables["p"] = spark.createDataFrame(parents, "id long, day date")
        tables["l"] = spark.createDataFrame(lines, "id long, b int, amount decimal(10,2)")

    run = Replicator(spark, "d", lambda n: tables[n], ["p", "l"], store, strategies)
    return put, run


def test_a_kept_view_equals_the_full_view(store, shop):
    put, run = shop
    money = decimal.Decimal
    parents = {k: days(k // 5) for k in range(60)}
    lines = {(k, n): (k % 4, money(k * 7 + n)) for k in range(60) for n in range(k % 4)}

    def state():
        put(sorted(parents.items()), [(k, b, a) for (k, _), (b, a) in sorted(lines.items())])

    view = sales_view()

    def check():
        full = view.sums({"headers": store.read("d_p"), "lines": store.read("d_l")})
        assert bag(maintain.read_view(store, view)) == bag(full.select(*maintain.read_view(store, view).columns))

    state()
    run.run_missing(CTX)
    maintain.follow(store, view)
    check()
    assert maintain.follow(store, view) == 0
    parents[2] = days(1)  # moved within the window
    parents[7] = days(40)  # moved out of it: its rows vanish
    parents[50] = days(0)  # moved into it: two copies now
    del parents[3], lines[3, 0], lines[3, 1], lines[3, 2]
    parents[100] = days(0)
    lines[100, 0], lines[100, 1] = (9, money(5)), (9, money("0.25"))
    lines[6, 0] = (1, money(1000))
    del lines[11, 2]  # changed lines of an order that stays
    state()
    run.run(CTX)
    old = store.snapshot("sales")
    assert maintain.follow(store, view) > 0
    check()
    kept = set(old.dirs) & set(store.snapshot("sales").dirs)
    assert kept  # days without a change are not written
    for k in list(parents):  # nothing left on two days
        if parents[k] in (days(0), days(1)):
            parents[k] = days(2)
    state()
    run.run(CTX)
    maintain.follow(store, view)
    check()
    assert not {d for d in store.snapshot("sales").partitions} & {days(1).isoformat()}


def test_a_kept_view_reads_changed_folders_only(store, shop, monkeypatch):
    put, run = shop
    parents = [(k, days(k // 5)) for k in range(100)]
    lines = [(k, 1, decimal.Decimal(k)) for k in range(100)]
    put(parents, lines)
    run.run_missing(CTX)
    view = sales_view()
    maintain.follow(store, view)
    put(parents, [(k, 1, a + 1 if k == 4 else a) for k, _, a in lines])
    run.run(CTX)
    read, files = store._read_dirs, []

    def counted(table, dirs, schema):
        if table != "sales":
            files.append(len(dirs))
        return read(table, dirs, schema)

    monkeypatch.setattr(store, "_read_dirs", counted)
    maintain.follow(store, view)
    # 4 of 20 days are replaced; the key that differs lies on one of them.
    assert files and max(files) <= 4
    full = view.sums({"headers": store.read("d_p"), "lines": store.read("d_l")})
    assert bag(maintain.read_view(store, view)) == bag(full)


def test_a_view_is_made_anew_when_its_old_versions_are_gone(store, shop):
    put, run = shop
    put([(1, days(0)), (2, days(9))], [(1, 1, decimal.Decimal(1)), (2, 1, decimal.Decimal(2))])
    run.run_missing(CTX)
    view = sales_view()
    maintain.follow(store, view)
    for n in range(3):
        put([(1, days(0)), (2, days(9))], [(1, 1, decimal.Decimal(n)), (2, 1, decimal.Decimal(2))])
        run.run(CTX)
    store.drop_old_versions("d_l", 1)
    maintain.follow(store, view)
    full = view.sums({"headers": store.read("d_p"), "lines": store.read("d_l")})
    assert bag(maintain.read_view(store, view)) == bag(full)


def test_views_of_rows_and_inexact_sums(spark, store):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, n long")
    store.append("t", rows)

    def sums(kind):
        return lambda f: f["rows"].groupBy("g").agg(
            F.sum(F.col("n").cast(kind)).alias("total"), F.count(F.lit(1)).alias("n_rows"))

    view = maintain.View("v", {"rows": "t"}, sums("long"), ("g",), "n_rows")
    broken = maintain.View("w", {"rows": "t"}, sums("double"), ("g",), "n_rows")
    for v in (view, broken):
        maintain.follow(store, v)
    store.replace("t", [rows.filter("g = 'a'"), spark.createDataFrame([("c", None)], rows.schema)])
    maintain.follow(store, view)
    assert bag(maintain.read_view(store, view)) == [("a", 3, 2), ("c", None, 1)]
    with pytest.raises(ValueError, match="exactly"):
        maintain.follow(store, broken)
    store.truncate("t")
    maintain.follow(store, view)
    assert bag(maintain.read_view(store, view)) == []


# -- streams of children ----------------------------------------------------------------------


CHILD = Strategy("l", DATE_INCREMENTAL, ("day",), parent="p", join_columns=("pid",), parent_columns=("id",),
                 partition_unit="month")
PARENT = Strategy("p", DATE_INCREMENTAL, ("day",), partition_unit="month")
LINE = "pid long, n int, at timestamp_ntz, price decimal(20,4), raw binary, x double, v string"


def line(k, n, v="new"):
    at = dt.datetime(2024, 5, 1, 12, 0, 0, 123456) + dt.timedelta(hours=k)
    return (2**53 + k, n, at, decimal.Decimal(k) / 8, bytes([k % 256, 0]), k / 3, f'{v} "{n}", \\ {k}')


@pytest.fixture
def streamed(spark, store, tmp_path):
    """Stale copies, the tables as they are, and a way to add their files and run the stream."""
    parents = [(2**53 + k, days(k // 4)) for k in range(40)] + [(None, days(0))]
    lines = [line(k, n) for k in range(40) for n in range(k % 4)] + [(None, 1, *line(0, 0)[2:])]
    lines += [line(1, n, "many") for n in range(10, 60)]
    frames = {"p": spark.createDataFrame(parents, "id long, day date"), "l": spark.createDataFrame(lines, LINE)}
    stale = {
        "p": frames["p"].filter("id % 5 <> 0 OR id IS NULL"),
        "l": frames["l"].filter("n % 2 = 0").withColumn("v", F.lit("old")).unionByName(
            spark.createDataFrame([line(2, 99, "old"), line(39, 99, "old")], LINE)),
    }
    both = [PARENT, CHILD]
    Replicator(spark, "d", stale.__getitem__, ["p", "l"], store, both).run_missing(CTX)
    run = Replicator(spark, "d", frames.__getitem__, ["p", "l"], store, both)
    folders = {n: str(tmp_path / n) for n in frames}
    for n, df in frames.items():
        df.limit(0).write.parquet(folders[n])

    def add(name, condition):
        frames[name].filter(condition).coalesce(1).write.mode("append").parquet(folders[name])

    def start(ctx=CTX, salts=2):
        write = ch.replace_child_batches(store, "d", CHILD, ctx, "lines", frames["l"].schema)
        rows = ch.routed_children(
            inc.stream_files(spark, folders["p"], frames["p"].schema),
            inc.stream_files(spark, folders["l"], frames["l"].schema), CHILD, ctx, salts)
        inc.run_to_end(inc.start(rows, write, str(tmp_path / "checkpoint")))

    return run, add, start


def batch_result(store, run):
    """What the batch refresh makes of the same copies (which are put back)."""
    version = store.snapshot("d_l")
    run.run_table("l", CTX)
    want = bag(store.read("d_l"))
    store._commit("d_l", version.schema, version.partition_by, version.dirs,
                  store.snapshot("d_l").version, version.spec, index=version.index)
    return want


ORDERS = [
    [("p", "true"), ("l", "true")],
    [("l", "true"), ("p", "true")],  # all children early, held over a restart
    [("l", "n % 2 = 0"), ("p", "id % 2 = 0"), ("p", "id % 2 = 1 OR id IS NULL"), ("l", "n % 2 = 1")],
]


@pytest.mark.parametrize("files", ORDERS)
def test_children_in_any_order_equal_the_batch(store, streamed, files):
    run, add, start = streamed
    run.run_table("p", CTX)
    want = batch_result(store, run)
    for name, condition in files:
        add(name, condition)
        start()
    got = bag(store.read("d_l"))
    # Children without a key: the batch run's copy has none of the source either.
    assert got == want
    version = store.snapshot("d_l").version
    start()  # nothing new
    assert store.snapshot("d_l").version == version and bag(store.read("d_l")) == want


def test_keys_share_groups_of_state(spark, store, streamed, tmp_path, monkeypatch):
    """State and calls are one for a group of keys, and each key's rows are its own."""
    monkeypatch.setattr(ch, "GROUPS", 8, raising=False)
    run, add, start = streamed
    run.run_table("p", CTX)
    want = batch_result(store, run)
    add("l", "true"), add("p", "true")
    schemas = {n: run.read(n).schema for n in ("p", "l")}
    files = {n: inc.stream_files(spark, str(tmp_path / n), schemas[n]) for n in schemas}
    write = ch.replace_child_batches(store, "d", CHILD, CTX, "lines", schemas["l"])
    rows = ch.routed_children(files["p"], files["l"], CHILD, CTX, 2)
    query = inc.start(rows, write, str(tmp_path / "checkpoint"))
    inc.run_to_end(query)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(states) <= 16  # of 40 keys, with two salts
    assert bag(store.read("d_l")) == want


class _State:
    """The state of one group, and the watermark."""

    def __init__(self):
        self.get, self.until, self.now, self.hasTimedOut = None, None, 0, False

    exists = property(lambda self: self.get is not None)

    def update(self, value):
        self.get = value

    def remove(self):
        self.get = None

    def getCurrentWatermarkMs(self):
        return self.now

    def setTimeoutTimestamp(self, until):
        assert until > self.now
        self.until = until


def test_keys_of_a_group_are_forgotten_one_by_one():
    def rows(run, *own):
        return pd.DataFrame(
            [(k, run, parent, parent, run if parent else None, text) for k, parent, text in own],
            columns=["key0", "run", "parent", "inside", "day", "payload"])

    def routed(*frames):
        return [tuple(r) for df in ch._route((0, 0, 3), iter(frames), state) for r in df.values.tolist()]

    state, day = _State(), 24 * 3600 * 1000
    assert routed(rows("2024-05-10", (1, False, "a"), (2, False, "b"))) == []
    first = state.until
    assert routed(rows("2024-05-12", (2, False, "c"))) == [] and state.until == first
    state.now, state.hasTimedOut = first + 1, True
    assert routed() == [] and state.until == first + 2 * day  # key 1 is gone, key 2 still waits
    state.hasTimedOut = False
    got = routed(rows("2024-05-13", (1, True, None), (2, True, None)))
    assert sorted(got, key=str) == sorted([
        (1, "delete", "2024-05-13", None), (2, "delete", "2024-05-13", None),
        (2, "row", "2024-05-13", "b"), (2, "row", "2024-05-13", "c")], key=str)
    state.now, state.hasTimedOut = state.until + 1, True
    assert routed() == [] and not state.exists


def test_the_next_run_replaces_again(spark, store, streamed):
    run, add, start = streamed
    run.run_table("p", CTX)
    add("p", "true"), add("l", "true")
    start()
    want = bag(store.read("d_l"))
    # The day after, the same files come again: deleted and added once more.
    add("p", "true"), add("l", "true")
    start(RunContext(AS_OF + dt.timedelta(days=1), 4))
    assert bag(store.read("d_l")) == want
    # Only a part of a parent's children come: the others are gone.
    add("p", f"id = {2**53 + 3}"), add("l", f"pid = {2**53 + 3} AND n = 1")
    start(RunContext(AS_OF + dt.timedelta(days=2), 5))
    left = [r for r in bag(store.read("d_l")) if r[0] == 2**53 + 3]
    assert [r[1] for r in left] == [1]
    add("p", "true")
    with pytest.raises(Exception, match="a later run"):
        start()


def test_streams_of_children_need_a_copy_and_a_parent(spark, store):
    lines = spark.createDataFrame([line(1, 1)], LINE)
    write = ch.replace_child_batches(store, "x", CHILD, CTX, "s", lines.schema)
    with pytest.raises(ValueError, match="no copy"):
        write(lines, 0)
    with pytest.raises(ValueError, match="parent itself"):
        ch.routed_children(lines, lines, PARENT, CTX)


def test_payload_is_exact(spark):
    rows = [line(k, 1) for k in range(30)] + [(None,) * 7]
    df = spark.createDataFrame(rows, LINE)
    back = ch.unpacked(df.select(ch.payload(df.schema).alias("payload")), df.schema)
    assert bag(back) == bag(df) and back.schema == df.schema


# -- hash tree --------------------------------------------------------------------------------


def test_tree_gives_the_rows_of_the_plain_comparison(spark):
    source = spark.range(5000).select("id", (F.col("id") % 11).alias("a"), F.lit(None).cast("string").alias("b"))
    copy = (
        source.filter("id % 997 <> 0")
        .withColumn("b", F.when(F.col("id") % 613 == 0, "x"))
        .unionByName(source.filter("id % 1201 = 0"))
        .unionByName(source.limit(3).withColumn("id", F.col("id") + 10**6))
    )
    for leaf_rows in (1, 16, 10_000):
        got = hash_tree.sync_drift_tree(source, copy, ["id"], leaf_rows=leaf_rows)
        assert bag(got) == bag(sync_drift(source, copy, ["id"]))
    assert hash_tree.sync_drift_tree(source, source, ["id"]).count() == 0
    empty = source.limit(0)
    assert hash_tree.sync_drift_tree(source, empty, ["id"]).filter("drift = 'missing'").count() == 5000
    assert hash_tree.sync_drift_tree(empty, empty, ["id"]).count() == 0


def test_few_changes_mean_few_compared_rows(spark):
    source = spark.range(100_000).select("id", (F.col("id") % 97).alias("a"))
    copy = source.withColumn("a", F.when(F.col("id") % 1000 == 7, -1).otherwise(F.col("a")))
    left, right = hash_tree.suspects(source, copy, ["id"])
    seen = left.count()
    assert seen == right.count() and 100 <= seen <= 5000  # 0.1 % changed, 5 % at most compared
    assert hash_tree.sync_drift_tree(source, copy, ["id"]).count() == 100


def test_tree_goes_down_below_differing_nodes_only():
    assert [hash_tree.levels_for(n, 16) for n in (1, 1024, 1025, 65_536, 65_537)] == [1, 1, 2, 2, 3]


def test_one_row_more_does_not_multiply_the_leaves(spark):
    assert [hash_tree.leaves_for(n, 16) for n in (0, 16, 17, 65_536, 65_537)] == [1, 1, 2, 4096, 8192]
    count = hash_tree.leaves_for(65_537, 16)
    assert hash_tree.leaves(spark.range(65_537), ["id"], count).count() <= 8192


# -- inclusion dependencies ------------------------------------------------------------------------


def test_inclusions_equal_brute_force(spark):
    pick = [
        ("big", {"id": list(range(3000)), "ref": [k % 900 for k in range(3000)],
                 "code": [f"c{k}" for k in range(3000)], "none": [None] * 3000}),
        ("mid", {"key": list(range(900)), "almost": [*range(899), 10**7],
                 "text": [f"c{k * 3}" for k in range(900)], "d": [days(k) for k in range(900)]}),
        ("tiny", {"flag": [0, 1, 1], "name": ["c3", "c6", None], "d": [days(5), days(6), days(6)]}),
    ]
    tables = {
        name: spark.createDataFrame(
            list(zip(*columns.values())),
            ", ".join(f"{c} {kind_of(v)}" for c, v in columns.items()))
        for name, columns in pick
    }
    want = set()
    flat = [(t, c, v) for t, columns in pick for c, v in columns.items()]
    for (t, c, v), (rt, rc, rv) in itertools.permutations(flat, 2):
        own, key = {x for x in v if x is not None}, {x for x in rv if x is not None}
        if kind_of(v)[0] != kind_of(rv)[0] or not own:
            continue
        if own <= key and len(key) == len(rv):
            want.add((t, c, rt, rc, len(own), len(key)))
    got = set(map(tuple, inclusion.inclusions(tables).collect()))
    assert got == want and ("big", "ref", "mid", "key", 900, 900) in want
    assert not any(r[:2] == ("mid", "almost") or r[2:4] == ("tiny", "flag") for r in got)


def kind_of(values):
    first = next((v for v in values if v is not None), 0)
    return {int: "long", str: "string", dt.date: "date"}[type(first)]


def test_inclusions_prune_by_sketch(spark):
    """Columns that overlap by half and lie within the range never get to the exact step."""
    a = spark.range(0, 4000, 2).select(F.col("id").alias("even"))
    b = spark.range(0, 4001).filter("id % 3 <> 0 OR id IN (0, 3999)").select(F.col("id").alias("key"))
    profile = inclusion.profiles({"a": a, "b": b})
    assert inclusion.candidate_pairs(profile).count() == 0
    assert inclusion.inclusions({"a": a, "b": b}).count() == 0


def test_few_values_within_a_large_key_are_found(spark):
    """A key of which the sketch holds one hash in dozens: of few values it holds none or a few."""
    big = spark.range(200_000).select(F.col("id").alias("key"))
    few = spark.range(25).select(*(
        (F.col("id") % 20 * 7 + 1000 * k).alias(f"few{k}") for k in range(8)
    ))
    got = set(map(tuple, inclusion.inclusions({"big": big, "few": few}).collect()))
    assert got == {("few", f"few{k}", "big", "key", 20, 200_000) for k in range(8)}


def test_quality_is_checked_without_a_column_in_one_task(spark, folder):
    """Exact percentiles gather every value of a column in one task; ranks are counts."""
    found = QUERIES["column_quality_kept"](spark, folder)
    assert "percentile(" not in found._jdf.queryExecution().toString()
    assert found.filter("distinct_near AND median_near").count() == 6
