"""Evolution, relations, plans, ledgers and quality on small fixtures."""

import datetime as dt

import pytest
from conftest import bag
from pyspark.sql import functions as F, types as T

from mirrorspan.model import DATE_INCREMENTAL, FULL_REFRESH, Relationship, RunContext, Strategy
from mirrorspan.operators import evolve, quality, relate, views
from mirrorspan.operators.joins import fk_orphans, join_test, labelled_join_test
from mirrorspan.plans import config, sync_plan as sp
from mirrorspan.sources.catalog import declared_columns, fk_catalog


def schema(*fields):
    return T.StructType([T.StructField(n, T.DataType.fromDDL(t), null, {"comment": c}) for n, t, null, c in fields])


def test_reconcile_modes_order_and_types():
    existing = schema(("a", "bigint", False, "ea"), ("B", "string", True, "eb"), ("c", "int", True, "ec"), ("old", "date", False, ""))
    new = schema(("b", "string", False, "nb"), ("a", "bigint", True, "na"), ("c", "double", True, "nc"), ("fresh", "int", False, ""))
    got = [(f.name, f.dataType.simpleString(), f.nullable, f.metadata["comment"]) for f in evolve.reconcile(existing, new)]
    assert got == [
        ("B", "string", True, "nb"),      # NULLABLE + REQUIRED
        ("a", "bigint", False, "na"),     # REQUIRED + NULLABLE
        ("c", "int", True, "ec"),         # same mode: the existing field
        ("fresh", "int", True, ""),
        ("old", "date", False, ""),
    ]
    assert all(f.nullable for f in evolve.reconcile(None, existing))
    with pytest.raises(evolve.SchemaConflict):
        evolve.reconcile(existing, new, evolve.FAIL)
    assert evolve.reconcile(existing, new, evolve.MOST_PERMISSIVE)["c"].dataType == T.DoubleType()


@pytest.mark.parametrize("a, b, wide", [
    ("int", "bigint", "bigint"), ("bigint", "float", "string"), ("int", "float", "double"),
    ("smallint", "float", "float"), ("bigint", "double", "string"), ("int", "double", "double"),
    ("decimal(10,2)", "decimal(5,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,20)", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "date", "string"), ("string", "int", "string"),
])
def test_widest(a, b, wide):
    get = T.DataType.fromDDL
    assert evolve.widest(get(a), get(b)) == evolve.widest(get(b), get(a)) == get(wide)


def test_evolve_union_and_strictness(spark):
    old = spark.createDataFrame([(1, 5)], "id long, n int")
    new = spark.createDataFrame([(2, "7", "x"), (3, "bad", "y")], "id long, n string, extra string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evolve.evolve_union(old, new).collect()
    assert bag(evolve.evolve_union(old, new, strict=False)) == [(1, 5, None), (2, 7, "x"), (3, None, "y")]
    wide = evolve.evolve_union(old, new, policy=evolve.MOST_PERMISSIVE)
    assert bag(wide) == [(1, "5", None), (2, "7", "x"), (3, "bad", "y")]


def test_policy_fail_leaves_the_type_open(spark):
    a = spark.createDataFrame([("x", "int", True)], "column_name string, full_type string, nullable boolean")
    b = spark.createDataFrame([("x", "date", True)], a.schema)
    assert evolve.reconcile_catalogs(a, b, evolve.FAIL).first().result_type is None
    assert evolve.reconcile_catalogs(a, b, evolve.MOST_PERMISSIVE).first().result_type == "string"


# -- relations --------------------------------------------------------------------


def test_join_test_counts_like_the_join_itself(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,)], "k long")
    right = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (9,)], "j long")
    got = join_test(left, right, ["k"], ["j"]).first()
    assert tuple(got) == (7, 2, 2, True)
    assert tuple(join_test(left.filter("k = 5"), right, ["k"], ["j"]).first()) == (0, 0, 0, False)


def test_join_test_groups_both_sides_at_once(spark, capsys):
    left = spark.sql("SELECT * FROM VALUES (1, 1L), (1, 1L), (2, 2L), (NULL, 3L) AS t(a, b)")
    right = spark.sql("SELECT * FROM VALUES (1L, 1), (2L, 3), (1L, 1), (4L, 4) AS t(c, d)")
    tested = join_test(left, right, ["a", "b"], ["c", "d"])
    assert tuple(tested.first()) == (4, 1, 1, True)
    capsys.readouterr()
    tested.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Sort" not in plan


def test_hot_key_is_counted_not_exploded(spark):
    hot = spark.range(200_000).select(F.lit(1).alias("k"))
    assert join_test(hot, hot, ["k"], ["k"]).first().total_joined_rows == 200_000**2


def test_absent_column_is_reported(spark):
    tables = {"p": spark.range(1), "c": spark.range(1)}
    row = labelled_join_test(tables.__getitem__, Relationship("fk", "c", ("x",), "p", ("id",))).first()
    assert (row.join_works, row.error) == (False, "no column x")


def test_orphans_ignore_null_keys_and_take_composite_keys(spark):
    tables = {
        "p": spark.createDataFrame([(1, 1), (1, 2)], "a long, b long"),
        "c": spark.createDataFrame([(1, 1), (1, 3), (1, 3), (None, 1), (2, None)], "x long, y long"),
    }
    row = fk_orphans(tables.__getitem__, Relationship("fk", "c", ("x", "y"), "p", ("a", "b"))).first()
    assert (row.child_rows, row.orphan_rows, row.orphan_keys) == (3, 2, 1)


FKS = [
    Relationship("f1", "child", ("p",), "parent", ("id",)),
    Relationship("f2", "grandchild", ("c", "n"), "child", ("id", "n")),
    Relationship("f3", "parent", ("top",), "parent", ("id",)),
]


def test_fk_statistics_and_indexes(spark):
    fks = fk_catalog(spark, FKS)
    assert tuple(relate.fk_statistics(fks).first()) == (3, 2, 1, 2, 3)
    lists = {r.table_name: (r.outgoing, r.incoming) for r in relate.fk_by_table(fks).collect()}
    assert lists == {"child": ("f1", "f2"), "grandchild": ("f2", ""), "parent": ("f3", "f1,f3")}
    assert {r.referenced: r.referring for r in relate.referenced_by(fks).collect()} == {
        "parent.id": "child.p,parent.top", "child.id": "grandchild.c", "child.n": "grandchild.n"}


# -- plans ---------------------------------------------------------------------------


def test_dependency_levels():
    strategies = {"b": Strategy("b", DATE_INCREMENTAL, ("d",), parent="a", priority="critical")}
    assert sp.dependency_levels(["c", "b", "a"], strategies) == [["a", "c"], ["b"]]
    assert sp.dependency_levels(["grandchild", "child", "parent"], {}, FKS) == [["parent"], ["child"], ["grandchild"]]
    loop = [Relationship("x", "a", ("i",), "b", ("i",)), Relationship("y", "b", ("i",), "a", ("i",))]
    with pytest.raises(ValueError, match="depend on each other"):
        sp.dependency_levels(["a", "b"], {}, loop)
    ranked = {"z": Strategy("z", priority="high")}
    assert sp.dependency_levels(["a", "z"], ranked) == [["z", "a"]]


def test_plan_defaults_and_force(spark):
    tables = spark.createDataFrame([("db", "a", 10), ("db", "b", 150_000)], "database_name string, table_name string, rows long")
    strategies = sp.strategies_frame(spark, [Strategy("b", DATE_INCREMENTAL, ("d",), 50_000)])
    rows = {r.table_name: r for r in sp.sync_plan(tables, strategies).collect()}
    assert (rows["a"].strategy, rows["a"].action, rows["a"].pages) == (FULL_REFRESH, "overwrite", 1)
    assert (rows["b"].action, rows["b"].pages, rows["b"].target_table) == ("window_replace", 3, "db_b")
    forced = sp.sync_plan(tables, strategies, force_full_refresh=True)
    assert {r.action for r in forced.collect()} == {"overwrite"}


def test_config_lint(spark):
    t = spark.createDataFrame([(1, None)], "id long, Changed date")
    catalog = declared_columns(spark, {"t": t, "p": t}).withColumn(
        "non_null_rows", F.when(F.col("column_name") == "Changed", 0).otherwise(1))
    strategies = sp.strategies_frame(spark, [
        Strategy("t", DATE_INCREMENTAL, ("changed", "nope", "ID")),
        Strategy("c", DATE_INCREMENTAL, ("id",), parent="p"),
        Strategy("x", DATE_INCREMENTAL), Strategy("y", FULL_REFRESH, ("nope",)),
    ])
    assert bag(sp.config_lint(strategies, catalog).select("table_name", "watermark_column", "problem")) == [
        ("t", "changed", "empty_column"), ("t", "nope", "unknown_column"), ("x", None, "no_watermark")]


SETTINGS = {
    "tables": {
        "head": {"strategy": "date_incremental", "watermark_column": ["day"], "chunk_size": 50_000, "lookback_days": 5},
        "line": {"strategy": "date_incremental", "watermark_column": "day"},
        "stock": {"strategy": "full_refresh"}, "pay": {"strategy": "full_refresh"},
    },
    "clusters": {"sales": {"parent_table": "head", "join_column": "id",
                           "child_tables": [{"table": "line", "relationship": "one_to_many"}, {"table": "pay"}]}},
}


def test_settings_become_strategies(spark):
    got = {s.table: s for s in config.strategies_from_settings(**SETTINGS, priorities={"critical": ["line"]}, critical_fields={"head": ["id"]})}
    assert got["head"].required == ("id",) and got["line"].required == ()
    assert (got["line"].parent, got["line"].join_columns, got["line"].priority) == ("head", ("id",), "critical")
    assert got["pay"].parent is None and not got["stock"].incremental and got["head"].lookback_days == 5
    assert bag(config.clusters_frame(spark, SETTINGS["clusters"])) == [
        ("sales", "head", "line", "id", "one_to_many"), ("sales", "head", "pay", "id", None)]
    fk = config.relationships_from_settings([
        {"name": "f", "table": "line", "column": "id", "referenced_table": "head", "referenced_column": "id"},
        {"name": "g", "table": "x", "columns": ["a", "b"], "referenced_table": "y", "referenced_columns": ["c", "d"]}])
    assert [r.kind for r in fk] == ["single_column", "composite"]


def test_context():
    assert RunContext(dt.datetime(2024, 5, 10, 7), 3).cutoff == dt.date(2024, 5, 7)
    with pytest.raises(ValueError):
        RunContext(dt.date(2024, 5, 10), -1)


# -- ledgers and quality ----------------------------------------------------------------


def ledger(spark, rows):
    return spark.createDataFrame(rows, quality.LEDGER_SCHEMA)


def test_ledgers(spark):
    first = ledger(spark, [("r1", "a", 0, "FAILED"), ("r1", "b", 5, "SUCCESS")])
    later = ledger(spark, [("r1", "a", 9, "SUCCESS")])
    merged = quality.merge_ledgers(first, later)
    assert tuple(quality.ledger_summary(merged).first()) == ("r1", 14, 2, 2, 0, "success")
    nothing = quality.ledger_summary(ledger(spark, [("r2", "a", 0, "FAILED")])).first()
    assert (nothing.successful_tables, nothing.failed_tables, nothing.run_status) == (0, 1, "warning")
    assert bag(quality.below_threshold(merged, 5).select("table_name")) == [("b",)]
    anomalies = quality.row_count_anomaly(
        ledger(spark, [("1", "a", 100, ""), ("1", "b", 100, ""), ("1", "c", 0, ""), ("1", "d", 0, "")]),
        ledger(spark, [("2", "a", 150, ""), ("2", "b", 49, ""), ("2", "c", 1, ""), ("2", "d", 0, "")]))
    assert {r.table_name: r.change for r in anomalies.collect()} == {"b": 0.51, "c": None}


def test_parity_and_pages(spark):
    counts = lambda rows: spark.createDataFrame(rows, "table_name string, rows long")
    got = quality.count_parity(counts([("a", 3), ("b", 2)]), counts([("a", 3), ("c", 1)]))
    assert bag(got) == [("a", 3, 3, 0, True), ("b", 2, 0, -2, False), ("c", 0, 1, 1, False)]
    assert bag(quality.page_counts(counts([("a", 0), ("b", 200_001)]))) == [("a", 0, 200_000, 0), ("b", 200_001, 200_000, 2)]


def test_freshness_at_the_limit(spark):
    at = lambda h, s=0: spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 0, s),)], "t timestamp_ntz")
    now = dt.datetime(2024, 1, 1, 23)
    got = quality.freshness({"edge": (at(10), "t"), "late": (at(9, 59), "t")}, now)
    assert {r.table_name: (r.age_hours, r.stale) for r in got.collect()} == {"edge": (13, False), "late": (13, True)}
    empty = quality.watermark_ledger({("d", "e"): (at(1).limit(0), "t")}, now).first()
    assert empty.last_value is None and empty.status == "EMPTY"


def test_column_quality_exact_and_sketched(spark):
    long = "x" * 100
    df = spark.createDataFrame([(1, long), (1, long + "y"), (2, long), (None, None)], "n long, s string")
    exact = {r.column_name: r for r in quality.column_quality(df, "t", exact_distinct=True).collect()}
    sketch = {r.column_name: r for r in quality.column_quality(df, "t").collect()}
    for got in (exact, sketch):
        assert (got["n"].rows, got["n"].null_rows, got["n"].distinct_values, got["n"].min_value) == (4, 1, 2, "1")
        assert got["s"].distinct_values == 2
    none = quality.column_quality(df.limit(0), "t", exact_distinct=True).collect()
    assert {(r.rows, r.distinct_values, r.max_value) for r in none} == {(0, 0, None)}


def test_order_tracking(spark):
    keys = {"header": "id", "line_header": "hid", "line_status": "st", "open_value": "O", "line_date": "d"}
    heads = spark.createDataFrame([(i,) for i in range(4)], "id long")
    lines = spark.createDataFrame([(0, "O", "a"), (1, "F", "a"), (2, "O", "a"), (2, "F", "b")], "hid long, st string, d string")
    got = {r.id: (r.tracking_status, r.lines) for r in views.order_tracking(heads, lines, keys).collect()}
    assert got == {0: ("open", 1), 1: ("closed", 1), 2: ("partial", 2), 3: ("empty", 0)}


def test_table_sizes(spark, folder, tmp_path):
    path = f"{folder}/nation.parquet"
    import os

    nation = spark.read.parquet(path)
    assert tuple(quality.table_size(nation).first()) == (25, os.path.getsize(path))
    names = sum(len(r.n_name) for r in nation.collect())
    assert tuple(quality.table_size(nation, "values").first()) == (25, 25 * 8 + names)
    top = quality.largest_tables({"n": nation, "m": nation.filter("n_nationkey < 3")}, 1)
    assert [r.table_name for r in top.collect()] == ["n"]


def test_key_range_of_zoneless_timestamps(spark):
    import datetime as dt

    from mirrorspan.operators.joins import key_set

    df = spark.createDataFrame([(dt.datetime(2001, 1, 1, 12),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert key_set(df, ["t"]).within_range(df, "t").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_daily_sums_deal_many_lines_over_as_many_tasks(spark, capsys):
    headers = spark.sql("SELECT id AS h, timestamp'2024-01-01 10:00:00' AS at FROM range(50)")
    lines = spark.sql("SELECT id % 50 AS h, id % 3 AS b, id * 0.5D AS price FROM range(400)")
    keys = {"line_header": "h", "line_branch": "b", "line_amount": "price", "header": "h", "header_date": "at"}
    dealt = views.daily_sums(headers, lines, keys, 33 * views.ROWS_A_PART)
    assert bag(dealt) == bag(views.daily_sums(headers, lines, keys))
    capsys.readouterr()
    dealt.explain()
    assert ", 33), REPARTITION_BY_NUM" in capsys.readouterr().out
