"""Equal-depth pages, chains of references, seasonal counts, curves, sketches, buckets, cleaning."""

import datetime as dt
import decimal
import glob
import random
import re
import statistics

import pyarrow.parquet as pq
import pytest
from conftest import bag
from pyspark.sql import functions as F

from mirrorspan.functions import clean
from mirrorspan.model import DATE_INCREMENTAL, Relationship, RunContext, Strategy
from mirrorspan.operators import layout, paths, quality, sketches, views
from mirrorspan.operators.joins import key_set
from mirrorspan.plans.runner import Replicator
from mirrorspan.sources import bucketed, catalog, pages
from mirrorspan.sources.scan import JdbcReader

AS_OF = dt.date(2024, 5, 10)
CTX = RunContext(AS_OF, 3)


def days(n):
    return AS_OF - dt.timedelta(days=n)


# -- pages of equal depth ---------------------------------------------------------------


def counter(keys):
    def count(ranges, width):
        found = {}
        for a, b in ranges:
            for k in keys:
                if a <= k <= b:
                    cell = k - (k - a) % width
                    found[cell] = found.get(cell, 0) + 1
        return found

    return count


@pytest.mark.parametrize("seed", range(6))
def test_no_page_is_larger_than_asked_for(seed):
    pick = random.Random(seed)
    keys = [pick.randrange(10**9) for _ in range(200)] + [5 + pick.randrange(40) for _ in range(3000)]
    keys += [777] * 500 + [k * k for k in range(300)]
    found = pages.equal_depth(counter(keys), min(keys), max(keys), len(keys), 100)
    assert found[0].first == min(keys) and found[-1].last == max(keys)
    assert all(a.last + 1 == b.first for a, b in zip(found, found[1:]))
    for p in found:
        own = [k for k in keys if p.first <= k <= p.last]
        assert len(own) == p.rows and (len(own) <= 100 or len(set(own)) == 1)
    assert len(found) <= 2 * len(keys) / 100 + 2 + sum(p.rows > 100 for p in found)


def test_pages_of_a_frame(spark):
    rows = [(7,)] * 400 + [(k * k,) for k in range(1000)] + [(None,)] * 3
    df = spark.createDataFrame(rows, "k long")
    found = pages.table_pages(df, "k", 50)
    paged = pages.scan_balanced(df, "k", found)
    assert bag(paged.select("k")) == bag(df)
    sizes = {r["page"]: (r["n"], r["a"], r["b"]) for r in paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("a"), F.max("k").alias("b")).collect()}
    assert sizes.pop(None)[0] == 3
    assert all(n <= 50 or a == b for n, a, b in sizes.values())
    for page, (n, a, b) in sizes.items():
        assert found[page].first <= a <= b <= found[page].last and found[page].rows == n
    # A few hundred pages at most: no page that equal slices of the range would give is left over.
    assert len(found) <= 50
    empty = df.filter("k IS NULL")
    assert pages.table_pages(empty, "k", 50) == []
    assert pages.scan_balanced(empty, "k", []).filter("page IS NULL").count() == 3


def test_negative_keys_and_single_page(spark):
    df = spark.createDataFrame([(-(2**62),), (-3,), (0,), (2**62,)], "k long")
    assert len(pages.table_pages(df, "k", 10)) == 1
    found = pages.table_pages(df, "k", 1)
    assert [p.rows for p in found] == [1, 1, 1, 1]


def test_balanced_jdbc_reads(monkeypatch, spark):
    """The counting queries go to the source; the pages become predicates."""
    keys = [1] * 300 + list(range(10, 4000, 7))
    from mirrorspan.sources import scan

    reader = JdbcReader(spark, "jdbc:x", {"t": "k"}, {"t": 100}, balanced=True)
    asked = []

    def read(session, options, predicates=None, properties=None):
        asked.append(options["dbtable"])
        sql = options["dbtable"]
        found = {}
        for a, w, b in re.findall(r"k - MOD\(k - (\d+), (\d+)\) AS cell.*?BETWEEN \d+ AND (\d+)", sql):
            found.update(counter(keys)([(int(a), int(b))], int(w)))
        return spark.createDataFrame(list(found.items()), "cell long, n long")

    monkeypatch.setattr(scan, "scan_jdbc", read)
    options, predicates = reader.pages("t", "v > 0", len(keys), 1, 3999)
    assert options["dbtable"] == "(SELECT * FROM t WHERE v > 0) w" and "numPartitions" not in options
    assert all("v > 0" in sql for sql in asked) and len(asked) <= 4
    assert predicates[0].startswith("(k BETWEEN 1 AND") and "k IS NULL" in predicates[0]
    assert len(predicates) >= 6


# -- chains of references -----------------------------------------------------------------


def rel(name, table, column, ref, ref_column="id"):
    return Relationship(name, table, (column,), ref, (ref_column,))


def test_closure_reports_cycles_as_rows(spark):
    fks = catalog.fk_catalog(spark, [
        rel("ab", "a", "b_id", "b"), rel("bc", "b", "c_id", "c"), rel("ca", "c", "a_id", "a"),
        rel("cd", "c", "d_id", "d"), rel("dd", "d", "up", "d"), rel("ab2", "a", "b2", "b"),
    ])
    found = {(r["from_table"], r["to_table"], r["path"]): (r["hops"], r["is_cycle"])
             for r in paths.closure(fks).collect()}
    assert found["a", "d", "ab > bc > cd"] == (3, False)
    assert found["a", "a", "ab2 > bc > ca"] == (3, True)
    assert found["d", "d", "dd"] == (1, True)
    assert not any(p.count("dd") > 1 for _, _, p in found)
    pairs = {(r[0], r[1]): (r["fewest_hops"], r["chains"]) for r in paths.reachable(fks).collect()}
    assert pairs["a", "d"] == (3, 2) and pairs["b", "b"] == (3, 2) and ("d", "a") not in pairs


def test_keys_along_a_path(spark):
    tables = {
        "r": spark.createDataFrame([(1,), (2,)], "id long"),
        "n": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id long, r long"),
        "c": spark.createDataFrame([(100, 10), (101, 11), (102, 10)], "id long, n long"),
        "o": spark.createDataFrame([(1000, 100), (1001, 101), (1002, 102), (1003, 102)], "id long, c long"),
    }
    path = [rel("nr", "n", "r", "r"), rel("cn", "c", "n", "n"), rel("oc", "o", "c", "c")]
    start = key_set(tables["r"].filter("id = 1"), ["id"])
    assert bag(paths.rows_along(tables.__getitem__, start, path)) == [(1000, 100), (1002, 102), (1003, 102)]
    assert [k.rows for k in paths.keys_along(tables.__getitem__, start, path)] == [1, 1, 2]
    with pytest.raises(ValueError, match="does not refer"):
        paths.keys_along(tables.__getitem__, start, [path[0], path[2]])


# -- seasonal counts ------------------------------------------------------------------------


def test_seasonal_counts(spark):
    rows, start = [], dt.date(2024, 1, 1)
    for n in range(70):
        day = start + dt.timedelta(days=n)
        rows.append(("t", day, 100 + n % 3 if day.weekday() >= 5 else 1000 + n % 7))
    broken = start + dt.timedelta(days=50)
    rows = [(t, d, 500 if d == broken else r) for t, d, r in rows]
    runs = spark.createDataFrame(rows, "table_name string, run_date date, rows long")
    got = {r["run_date"]: r for r in quality.seasonal_anomaly(runs).collect()}
    # The weekend is a tenth of the week, which half of the run before would call an anomaly.
    assert [d for d, r in got.items() if r["anomalous"]] == [broken]
    counts = {d: r for _, d, r in rows}
    for d, r in got.items():
        past = [counts[d - dt.timedelta(days=7 * k)] for k in range(1, 9) if d - dt.timedelta(days=7 * k) >= start]
        centre = statistics.median(past)
        spread = max(1.4826 * statistics.median(abs(x - centre) for x in past), 0.05 * centre)
        assert r["expected_rows"] == centre and abs(r["score"] - abs(counts[d] - centre) / spread) < 1e-4
    assert min(got) == start + dt.timedelta(days=21)
    still = spark.createDataFrame([("z", start + dt.timedelta(days=7 * k), 0) for k in range(5)]
                                  + [("z", start + dt.timedelta(days=35), 4)], runs.schema)
    assert [r["anomalous"] for r in quality.seasonal_anomaly(still).orderBy("run_date").collect()] == [False, False, True]


# -- curve ---------------------------------------------------------------------------------------


def groups_read(path, column, low, high):
    """Row groups whose statistics let the values through, and all."""
    read = whole = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            whole += 1
            read += s.min <= high and s.max >= low
    return read, whole


def test_a_curve_skips_by_every_column(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select(
        ((F.col("id") * 7919) % n).alias("a"), ((F.col("id") * 104_729) % n).alias("b"),
        F.concat(F.lit("k"), F.lpad(((F.col("id") * 31) % 1000).cast("string"), 4, "0")).alias("s"),
    )
    curve, plain = str(tmp_path / "curve"), str(tmp_path / "plain")
    layout.write_curve(df, curve, ["a", "b"], 64)
    df.repartitionByRange(64, "a", "b").sortWithinPartitions("a", "b").write.parquet(plain)
    assert bag(spark.read.parquet(curve)) == bag(df)
    first, _ = groups_read(curve, "a", 1000, 1100)
    second, whole = groups_read(curve, "b", 1000, 1100)
    assert first <= whole / 4 and second <= whole / 4
    assert groups_read(plain, "b", 1000, 1100)[0] >= 3 * second  # sorting helps the first column only


def test_large_tables_get_more_files_along_the_curve(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_A_FILE", 1000, raising=False)
    df = spark.range(20_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"))
    layout.write_curve(df, str(tmp_path / "t"), ["id", "a"], 4)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/t/*.parquet")]
    assert sum(sizes) == 20_000 and len(sizes) > 10 and max(sizes) < 4000


def test_curve_keys_of_texts_dates_and_nulls(spark):
    rows = [(None, None, None)] + [(f"t{k:03}", days(k % 9), decimal.Decimal(k % 5)) for k in range(100)]
    df = spark.createDataFrame(rows, "s string, d date, x decimal(5,1)")
    keyed = df.withColumn("key", layout.curve_key(df, ["s", "d", "x"], 4))
    values = {r["s"]: r["key"] for r in keyed.collect()}
    assert values[None] == 0 and len(set(values.values())) > 20
    nothing = df.filter("s = 'none'")
    assert nothing.withColumn("key", layout.curve_key(nothing, ["s"])).collect() == []
    with pytest.raises(ValueError, match="62 bits"):
        layout.curve_key(df, ["s", "d", "x"], 30)


def test_copies_along_a_curve(spark, store):
    rows = spark.createDataFrame([(k, days(k % 5), (k * 37) % 100) for k in range(500)], "id long, day date, v long")
    s = Strategy("t", DATE_INCREMENTAL, ("day",), partition_unit="day", curve_columns=("id", "v"))
    run = Replicator(spark, "d", lambda _: rows, ["t"], store, [s])
    run.run_missing(CTX)
    run.run(CTX)
    assert bag(store.read("d_t")) == bag(rows)


# -- sketches by partition -----------------------------------------------------------------------------


def test_sketches_follow_a_refresh(spark, store):
    def table(extra):
        return spark.createDataFrame(
            [(k, days(k % 10), k * 1.5 if k % 7 else None, f"v{k % 50}") for k in range(2000)]
            + [(k, days(0), 1.0, "new") for k in range(5000, 5000 + extra)], "id long, day date, x double, v string")

    current = {"t": table(0)}
    s = Strategy("t", DATE_INCREMENTAL, ("day",), partition_unit="day")
    run = Replicator(spark, "d", lambda n: current[n], ["t"], store, [s])
    run.run_missing(CTX)
    assert sketches.follow_quality(store, "d_t", "q") == 10
    assert sketches.follow_quality(store, "d_t", "q") == 0
    current["t"] = table(300)
    run.run(CTX)
    before = set(store.snapshot("q").dirs)
    assert sketches.follow_quality(store, "d_t", "q") == 4
    assert len(before & set(store.snapshot("q").dirs)) == 6
    got = {r["column_name"]: r for r in sketches.read_quality(store, "q").collect()}
    rows = current["t"].collect()
    for c in ("id", "day", "x", "v"):
        values = [r[c] for r in rows if r[c] is not None]
        r = got[c]
        assert (r["rows"], r["null_rows"]) == (len(rows), len(rows) - len(values))
        assert abs(r["distinct_values"] - len(set(values))) <= max(1, 0.06 * len(set(values)))
        if c in ("id", "x"):
            assert (r["low_number"], r["high_number"]) == (min(values), max(values))
            ordered = sorted(values)
            assert ordered[int(0.45 * len(values))] <= r["q50"] <= ordered[int(0.55 * len(values))]
        else:
            assert (r["low_text"], r["high_text"]) == (str(min(values)), str(max(values)))
    part = sketches.read_quality(store, "q", [days(9).isoformat()])
    assert part.filter("column_name = 'id'").first()["rows"] == 200
    run.store.drop_partitions("d_t", lambda p: p == days(9).isoformat())
    assert sketches.follow_quality(store, "d_t", "q") == 1
    assert sketches.read_quality(store, "q").filter("column_name = 'id'").first()["rows"] == 2100


# -- bucketed tables -------------------------------------------------------------------------------------


def test_published_tables_join_without_a_shuffle(spark, store, tmp_path):
    parents = [(k, days(k // 10)) for k in range(100)]
    tables = {
        "p": spark.createDataFrame(parents, "id long, day date"),
        "l": spark.createDataFrame([(k, n, "a") for k in range(100) for n in range(3)], "pid long, n int, v string"),
    }
    both = [
        Strategy("p", DATE_INCREMENTAL, ("day",), partition_unit="day"),
        Strategy("l", DATE_INCREMENTAL, ("day",), parent="p", join_columns=("pid",), parent_columns=("id",),
                 partition_unit="day"),
    ]
    run = Replicator(spark, "d", lambda n: tables[n], ["p", "l"], store, both)
    run.run_missing(CTX)

    def publish():
        return [bucketed.publish(store, f"d_{n}", f"published_{n}", [k], 4, str(tmp_path / n))
                for n, k in (("p", "id"), ("l", "pid"))]

    try:
        assert publish() == [10, 10]
        assert publish() == [0, 0]
        tables["l"] = tables["l"].filter("pid % 3 > 0").withColumn("v", F.lit("b"))
        tables["p"] = spark.createDataFrame([(k, d) for k, d in parents if d != days(2)], "id long, day date")
        run.run(CTX)
        written = publish()
        assert written[0] == 4 and written[1] <= 5
        frames = [bucketed.read_published(spark, f"published_{n}") for n in ("l", "p")]
        for frame, copy in zip(frames, ("d_l", "d_p")):
            assert bag(frame) == bag(store.read(copy))
        joined = bucketed.join_published(*frames, F.col("pid") == F.col("id"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = store.read("d_l").join(store.read("d_p"), F.col("pid") == F.col("id"))
        assert bag(joined) == bag(plain)
    finally:
        for n in ("p", "l"):
            spark.sql(f"DROP TABLE IF EXISTS published_{n}")


# -- cleaning, views, order --------------------------------------------------------------------------------


def test_broken_bytes_go_and_replacement_characters_stay(spark):
    texts = [
        (b"a\xffb", "ab"), ("a�b".encode() + b"\xc3", "a�b"), (b"\xe2\x82x\xf0\x9f", "x"),
        ("��".encode(), "��"), (b"\x00n\xff\x00r", "\x00n\x00r"), (b"\xff", ""),
        ("é漢".encode() + b"\x80" + "\U0001f600".encode(), "é漢\U0001f600"), (b"", ""),
    ]
    df = spark.createDataFrame([(bytearray(b),) for b, _ in texts], "b binary")
    got = df.select(clean.drop_invalid_utf8(F.col("b").cast("string")).alias("t")).collect()
    assert [r["t"] for r in got] == [want for _, want in texts]


def test_persistent_views(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    from mirrorspan.sources.scan import create_external_table

    create_external_table(spark, "kept_table", str(tmp_path / "t"), "parquet")
    try:
        views.create_view(spark, "kept_view", "SELECT id FROM kept_table WHERE id > 2", persistent=True)
        assert bag(spark.newSession().table("kept_view")) == [(3,), (4,)]
        views.create_view(spark, "kept_view", "SELECT id FROM kept_table WHERE id > 3", persistent=True)
        assert bag(spark.newSession().table("kept_view")) == [(4,)]
    finally:
        spark.sql("DROP VIEW IF EXISTS kept_view")
        spark.sql("DROP TABLE IF EXISTS kept_table")


def test_numbered_keeps_the_order(spark):
    df = spark.createDataFrame([(k,) for k in (3, 1, 2)], "k int").orderBy(F.desc("k"))
    assert [(r["position"], r["k"]) for r in catalog.numbered(df).orderBy("position").collect()] == [
        (1, 3), (2, 2), (3, 1)]




def test_buckets_grow_with_the_table():
    counts = [bucketed.buckets_for(n) for n in (0, 8_000_000, 8_000_001, 36_000_000, 216_000_000)]
    assert counts == [8, 8, 16, 64, 256]
