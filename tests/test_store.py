"""The versioned store: staging, verifying, switching, partitions."""

import pytest
from conftest import bag
from pyspark.sql import functions as F

from mirrorspan.sources import store as store_module
from mirrorspan.sources.store import NULL_PARTITION, VerificationError


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", "2024-01"), (2, "b", "2024-01"), (3, "c", "2024-02"), (4, None, None)],
        "id long, v string, part string",
    )


def test_overwrite_append_truncate(spark, store, rows):
    df = rows.drop("part")
    assert not store.exists("t") and store.tables() == []
    assert store.append("t", df) == 4  # created when absent
    assert store.append("t", df) == 4
    assert store.read("t").count() == 8 and store.tables() == ["t"]
    assert store.overwrite("t", df) == 4
    assert bag(store.read("t")) == bag(df)
    store.truncate("t")
    assert store.read("t").count() == 0 and store.read("t").schema == df.schema


def test_a_table_can_be_rewritten_from_itself(store, rows):
    store.append("t", rows.drop("part"))
    store.overwrite("t", store.read("t").filter("id > 2"))
    assert {r.id for r in store.read("t").collect()} == {3, 4}


def test_failed_write_leaves_the_old_version(spark, store, rows):
    store.append("t", rows.drop("part"))
    bad = rows.drop("part").withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise("x"))
    with pytest.raises(Exception, match="boom"):
        store.overwrite("t", bad)
    assert bag(store.read("t")) == bag(rows.drop("part"))
    assert store.snapshot("t").version == 1


def test_wrong_count_is_not_switched_in(store, rows):
    store.append("t", rows.drop("part"))
    with pytest.raises(VerificationError):
        store.overwrite("t", rows.drop("part").limit(1), expect_rows=2)
    assert store.read("t").count() == 4


def test_partitions_are_replaced_dropped_and_kept(spark, store, rows):
    store.overwrite("t", rows, "part")
    assert store.snapshot("t").partitions == ["2024-01", "2024-02", NULL_PARTITION]
    assert store.read("t").columns == ["id", "v"]
    untouched = {d for v, d in store.snapshot("t").dirs if v != "2024-01"}
    new = spark.createDataFrame([(9, "n", "2024-03")], rows.schema)
    assert store.replace("t", [new], lambda p: p == "2024-01") == [1]
    assert {r.id for r in store.read("t").collect()} == {3, 4, 9}  # the emptied partition is gone
    assert untouched < {d for _, d in store.snapshot("t").dirs}    # the others were not rewritten
    only = store.read("t", lambda p: p == "2024-03", keep_partition=True)
    assert bag(only) == [(9, "n", "2024-03")]


def test_replace_everything_with_nothing(spark, store, rows):
    store.overwrite("t", rows, "part")
    assert store.replace("t", [rows.limit(0)]) == [0]
    assert store.read("t").count() == 0


def test_new_columns_are_null_in_old_rows(spark, store, rows):
    df = rows.drop("part")
    store.append("t", df)
    store.append("t", df.withColumn("extra", F.lit(5)))
    assert bag(store.read("t").groupBy("extra").count()) == [(5, 4), (None, 4)]


def test_rebuild_relaxes_and_verifies(store, rows):
    store.overwrite("t", rows, "part")
    assert store.rebuild("t") == (4, 4)
    assert store.snapshot("t").version == 2 and store.snapshot("t").partition_by == "part"
    assert bag(store.read("t")) == bag(rows.drop("part"))


def test_old_versions_can_be_removed(store, rows):
    store.overwrite("t", rows, "part")
    store.replace("t", [rows.filter("id = 3")], lambda p: p == "2024-02")
    store.overwrite("u", rows.drop("part"))
    store.overwrite("u", rows.drop("part"))
    assert store.drop_old_versions("t", keep=1) == 0  # version 1 still holds two partitions
    assert store.drop_old_versions("u", keep=1) == 1
    assert store.read("t").count() == 4 and store.read("u").count() == 4


def test_two_writers_do_not_overwrite_each_other(store, rows, monkeypatch):
    store.append("t", rows.drop("part"))
    monkeypatch.setattr(store_module.TableStore, "_versions", lambda self, t: [])
    with pytest.raises(RuntimeError, match="someone else"):
        store._commit("t", rows.drop("part").schema, None, [], None, None)


def test_retention_drops_partitions_only(store, rows):
    store.overwrite("t", rows, "part")
    assert store.drop_partitions("t", lambda p: p < "2024-02") == 1
    assert {r.id for r in store.read("t").collect()} == {3, 4}
    assert store.drop_partitions("t", lambda p: p < "2024-02") == 0
    assert store.snapshot("t").version == 2


def test_older_versions_stay_readable(store, rows):
    store.overwrite("t", rows, "part")
    store.overwrite("t", rows.filter("id = 1"), "part")
    assert store.read("t", version=1).count() == 4 and store.read("t").count() == 1
    with pytest.raises(FileNotFoundError):
        store.read("t", version=9)


def test_overlapping_writers_fail(store, spark):
    store.append("t", spark.range(1))
    one = store.snapshot("t")
    staged, _ = store._stage("t", spark.range(10), None)
    store.append("t", spark.range(100))
    with pytest.raises(store_module.StaleVersionError):
        store._commit("t", one.schema, None, [*one.dirs, *staged], one.version, None)
    assert store.read("t").count() == 101


def test_folder_names_are_not_columns(store, spark):
    df = spark.createDataFrame(
        [(1, "x", "a b+c/%d:e"), (2, "y", None)], "version int, window_part string, v string")
    store.overwrite("t", df.withColumn("p", df.v), "p")
    store.append("t", df.withColumn("p", df.v))
    assert bag(store.read("t")) == sorted(bag(df) * 2, key=repr)
    kept = store.read("t", keep_partition=True)
    assert bag(kept.select("version", "p")) == [(1, "a b+c/%d:e")] * 2 + [(2, None)] * 2
    assert bag(store.read("t", only=lambda p: p == "a b+c/%d:e")) == [tuple(df.first())] * 2


def test_rebuild_all_goes_on_after_a_failure(store, spark, monkeypatch):
    store.append("a", spark.range(3))
    store.append("b", spark.range(4))
    whole = store.rebuild
    monkeypatch.setattr(
        store, "rebuild", lambda t: whole(t) if t == "b" else (_ for _ in ()).throw(OSError("gone")))
    assert store.rebuild_all() == [("a", None, None, "OSError: gone"), ("b", 4, 4, None)]


def test_compaction_and_old_versions(store, spark):
    df = spark.createDataFrame([(k, f"p{k % 2}") for k in range(6)], "k long, p string")
    for _ in range(3):
        store.append("t", df, "p")
        store.append("u", spark.range(2))
    assert store.compact("t") == 4 and store.compact("u") == 2 and store.compact("u") == 0
    assert store.read("t").count() == 18 and store.read("u").count() == 6
    assert store.drop_old_versions("t", keep=1) >= 3
    assert store.read("t").count() == 18


def test_partition_values_are_taken_once_a_file(spark, store, monkeypatch, capsys):
    values = ["2024-01", "a+b", "x/y=%20", " é", None]
    rows = [(k, values[k % 5]) for k in range(20)]
    df = spark.createDataFrame(rows, "id long, part string")
    store.overwrite("t", df.filter("id < 12"), "part", index=["id"])
    store.append("t", df.filter("id >= 12"))
    read = store.read("t", keep_partition=True)
    assert bag(read) == bag(df)
    capsys.readouterr()
    read.explain()
    assert "file_path" not in capsys.readouterr().out
    monkeypatch.setattr("mirrorspan.sources.store.MOST_SCANS", 1)
    assert bag(store.read("t", keep_partition=True)) == bag(df)
