"""Types, cleaning, durations, names and scans on small fixtures."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from conftest import bag
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from mirrorspan.functions import clean, names, types as ft
from mirrorspan.model import RunContext
from mirrorspan.operators import evolve, layout, views
from mirrorspan.registry.derived import SOURCE_TYPES
from mirrorspan.sources import catalog as cat, scan


@pytest.mark.parametrize("source, target", SOURCE_TYPES.items())
def test_type_mapping(spark, source, target):
    assert ft.map_type(source) == target


def test_type_mapping_as_a_column_agrees(spark):
    odd = [*SOURCE_TYPES, "", "  INT  ", "decimal(38,0)", "decimal(39,0)", "numeric( 5 , 2 )", "double unsigned"]
    df = spark.createDataFrame([(s,) for s in odd], "s string")
    got = {r.s: r.t for r in df.select("s", ft.map_type_column(F.col("s")).alias("t")).collect()}
    assert got == {s: ft.map_type(s) for s in odd}


def test_target_schema_is_nullable_and_remembers_its_source(spark):
    schema = ft.target_schema([("a", "int(11)"), ("b", "decimal(15,4)"), ("c", "time")])
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "decimal(15,4)", "string"]
    assert all(f.nullable for f in schema) and schema["a"].metadata == {"comment": "source: int(11)"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_fails_and_lenient_cast_counts(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_casts(spark)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def check_casts(spark):
    df = spark.createDataFrame([("1", "9.5"), ("x", None)], "A string, b string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("B", T.DoubleType()),
                           T.StructField("c", T.DateType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ft.cast_to_schema(df, schema).collect()
    assert bag(ft.cast_to_schema(df, schema, strict=False)) == [(1, 9.5, None), (None, None, None)]
    assert bag(ft.cast_rejects(df, schema)) == [("B", "double", 0), ("a", "bigint", 1)]


def test_integer_rejects_are_range_tests(spark):
    df = spark.createDataFrame([(127,), (128,), (-128,), (-129,), (None,)], "a long")
    schema = T.StructType([T.StructField("a", T.ByteType())])
    assert ft.cast_rejects(df, schema).first().rejected == 2


TEXTS = ["nan", "None", "null", "NULL", "", "\0", "n\0an", "Null", " ", "NaN", "x\0y", "ok", None]


def test_clean_text(spark):
    df = spark.createDataFrame([(t, 1) for t in TEXTS], "t string, n int")
    got = [r.t for r in clean.clean_text_columns(df).collect()]
    assert got == [None] * 7 + ["Null", " ", "NaN", "xy", "ok", None]
    counts = clean.null_token_counts(df).first()
    assert (counts.already_null, counts.became_null, counts.text_changed) == (1, 7, 1)


def test_broken_bytes_are_dropped_and_good_text_is_kept(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("é�".encode()),)], "b binary")
    got = [r[0] for r in df.select(clean.clean_text(F.col("b").cast("string"))).collect()]
    assert got == ["ab", "é�"]


def test_only_text_is_cleaned(spark):
    df = spark.createDataFrame([(bytearray(b"nan"), "nan", 1.5)], "b binary, s string, d double")
    assert clean.clean_text_columns(df).first() == (bytearray(b"nan"), None, 1.5)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="naN\0oeullL ", max_size=6), min_size=1, max_size=20))
def test_cleaning_follows_its_rule_and_is_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = clean.clean_text_columns(df)
    want = [t.replace("\0", "") for t in texts]
    want = [None if t in clean.NULL_TOKENS else t for t in want]
    assert [r.t for r in once.collect()] == want
    assert [r.t for r in clean.clean_text_columns(once).collect()] == want


@pytest.mark.parametrize("value, text, wraps", [
    (dt.timedelta(hours=13, minutes=5, seconds=9), "13:05:09", False),
    (dt.timedelta(days=1, hours=2), "02:00:00", True),
    (dt.timedelta(0), "00:00:00", False),
    (dt.timedelta(seconds=1, microseconds=500), "00:00:01.000500", False),
    (dt.timedelta(seconds=-1), "23:59:59", True),
    (dt.timedelta(hours=838, minutes=59, seconds=59), "22:59:59", True),
    (None, None, None),
])
def test_duration_to_time(spark, value, text, wraps):
    df = spark.createDataFrame([(value,)], "i interval day to second")
    assert df.select(clean.duration_to_time(F.col("i")), clean.out_of_day(F.col("i"))).first() == (text, wraps)


def test_durations_do_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Argentina/Buenos_Aires")
        df = spark.createDataFrame([(dt.timedelta(days=200, hours=3),)], "i interval day to second")
        assert df.select(clean.duration_to_time(F.col("i"))).first()[0] == "03:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_names(spark):
    df = spark.createDataFrame([("a.b",), ("a.b.c",), ("ab",)], "s string")
    db, table = names.split_table_spec(F.col("s"))
    assert bag(df.select(db, table)) == [("a", "b"), ("a", "b.c"), (None, None)]
    assert df.select(names.target_name(F.lit("d"), F.col("s"))).first()[0] == "d_a.b"
    with pytest.raises(Exception, match="expected database.table: ab"):
        df.select(names.require_table_spec(F.col("s"))).collect()


# -- scans ----------------------------------------------------------------------


def test_pages_cover_the_table_once(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    pages = scan.key_pages(lines, "l_orderkey", 100)
    assert pages.agg(F.sum("rows")).first()[0] == lines.count()
    assert bag(scan.scan_pages(lines, "l_orderkey", 100).drop("page")) == bag(lines)
    bounds = sorted((r.first_key, r.last_key) for r in pages.collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_rows_without_a_key_have_their_own_page(spark):
    df = spark.createDataFrame([(1,), (None,), (250,), (-1,)], "k long")
    assert bag(scan.key_pages(df, "k", 100)) == [(-1, -1, -1, 1), (0, 1, 1, 1), (2, 250, 250, 1), (None, None, None, 1)]


def test_jdbc_options():
    got = scan.jdbc_options("jdbc:x", "t", "id", (1, 1_000), page_rows=100)
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "10"
    assert (got["lowerBound"], got["upperBound"]) == ("1", "1001")
    # No cap: the page size holds at any number of rows.
    assert scan.jdbc_options("jdbc:x", "t", "id", (1, 10**9), 50_000)["numPartitions"] == "20000"
    assert "numPartitions" not in scan.jdbc_options("jdbc:x", "t")
    pages = scan.hash_page_predicates("crc32(k)", 3)
    assert len(pages) == 3 and "IS NULL" in pages[0] and "IS NULL" not in pages[1]


def test_size_classes(spark):
    rows = [0, 999_999, 1_000_000, 10_000_000, 10_000_001, None]
    want = [200_000, 200_000, 100_000, 100_000, 50_000, 100_000]
    assert [scan.chunk_rows_for(r) for r in rows] == want
    df = spark.createDataFrame([(r,) for r in rows], "r long")
    assert [x[0] for x in df.select(scan.chunk_rows_column(F.col("r"))).collect()] == want
    assert scan.page_count(0, 10) == 0 and scan.page_count(11, 10) == 2


def test_user_query_keeps_pushdown(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    df = scan.scan_query(spark, "SELECT o_orderkey FROM {orders} WHERE o_orderdate >= :cutoff",
                         {"orders": orders}, RunContext(dt.date(2001, 8, 1), 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in plan
    assert df.count() == 4


def test_column_pruning(spark, folder):
    from mirrorspan.registry import QUERIES

    plan = QUERIES["project_columns"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]


def test_external_files(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("1,x\n2,y\n")
    (tmp_path / "f" / "b.csv").write_text("3,z\n")
    path = str(tmp_path / "f")
    assert bag(scan.read_external(spark, path, schema="id long, v string")) == [(1, "x"), (2, "y"), (3, "z")]
    assert scan.register_external(spark, {"ext_f": path}) == ["ext_f"]
    assert spark.table("ext_f").dtypes[0][1] == "int"


def test_catalog_listing(spark):
    assert cat.list_catalog_tables(spark, "no_such_database").count() == 0
    spark.range(1).createOrReplaceTempView("listed_view")
    assert "listed_view" in {r.table_name for r in cat.list_catalog_tables(spark, "default").collect()}
    views.create_view(spark, "made_view", "SELECT 7 AS n")
    assert spark.table("made_view").first().n == 7


def test_declared_catalog(spark):
    schema = T.StructType([
        T.StructField("id", T.IntegerType(), False), T.StructField("amount", T.DecimalType(15, 4)),
        T.StructField("it's", T.StringType(), True, {"comment": "a 'quoted' \\ text"}),
    ])
    df = spark.createDataFrame([(1, None, "ab")], schema)
    rows = cat.declared_columns(spark, {"t": df}).orderBy("ordinal_position").collect()
    assert [(r[1], r[4], r[7], r[8]) for r in rows] == [
        ("id", "int", 10, 0), ("amount", "decimal(15,4)", 15, 4), ("it's", "string", None, None)]
    measured = {r.column_name: r for r in cat.measured_columns(df, "t", lengths=True).collect()}
    assert measured["it's"].comment == "a 'quoted' \\ text" and measured["it's"].max_length == 2
    assert measured["amount"].nullable and not measured["id"].nullable
    some = cat.measured_columns(df, "t", columns=["AMOUNT", "nope"]).collect()
    assert [(r.column_name, r.ordinal_position, r.max_length) for r in some] == [("amount", 2, None)]
    assert cat.measured_columns(df, "t", columns=[]).count() == 0


def test_measuring_some_columns_reads_only_those(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = cat.measured_columns(docs, "d", columns=["lang"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string>" in plan


def test_columns_like(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "IDx long, x_id long, numero_a long, Id long")
    assert cat.columns_like(df, ("%ID%", "%id%", "%numero%")) == ["IDx", "x_id", "numero_a"]


def test_readers_and_external_tables(spark, folder, tmp_path):
    assert "orders" in cat.list_folder_tables(spark, folder) and len(cat.list_folder_tables(spark, folder)) == 14
    assert scan.parquet_reader(spark, folder)("region").count() == 5
    region = spark.read.parquet(f"{folder}/region.parquet")
    region.write.parquet(str(tmp_path / "r"))
    scan.create_external_table(spark, "ext_region", str(tmp_path / "r"), "parquet", region.schema)
    try:
        assert bag(scan.catalog_reader(spark, "default")("ext_region")) == bag(region)
        wider = T.StructType([*region.schema.fields, T.StructField("note", T.StringType())])
        assert evolve.add_columns_to_table(spark, "ext_region", wider) is True
        assert evolve.add_columns_to_table(spark, "ext_region", wider) is False
        assert {r.note for r in spark.table("ext_region").collect()} == {None}
    finally:
        spark.sql("DROP TABLE ext_region")


def test_layout_prunes_by_day(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet")
    path = layout.archive_path(str(tmp_path), "shop", "events")
    layout.write_layout(events, path, F.col("ts"), ["user_id"])
    back = layout.read_layout(spark, path)
    assert bag(back.drop("date").select(*events.columns)) == bag(events)
    kept = layout.retained(back, "date", dt.date(2024, 1, 31), 7)
    assert "PartitionFilters: [isnotnull(date" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == events.filter("ts >= '2024-01-24'").count()


def test_key_pages_of_large_keys(spark):
    df = spark.createDataFrame([(2**53 + 1,), (-1,), (None,)], "k long")
    got = {r.k: r.page for r in scan.scan_pages(df, "k", 1).collect()}
    assert got == {2**53 + 1: 2**53 + 1, -1: -1, None: None}


def test_jdbc_pages_follow_the_window(spark):
    reader = scan.JdbcReader(
        spark, "jdbc:x", {"orders": "id"}, {"orders": 1000}, hash_keys={"notes": "crc32(k)"})
    where = "day >= '2001-07-02'"
    options, predicates = reader.pages("orders", where, 2500, 900_001, 902_500)
    assert options["dbtable"] == f"(SELECT * FROM orders WHERE {where}) w" and predicates is None
    assert (options["lowerBound"], options["upperBound"]) == ("900001", "902501")
    assert options["numPartitions"] == "3"
    _, predicates = reader.pages("notes", None, 450_000, None, None)
    assert len(predicates) == 3 and "IS NULL" in predicates[0]
    options, predicates = reader.pages("plain", None, 10, None, None)
    assert "numPartitions" not in options and predicates is None


def test_strict_casts_reject_lossy_values(spark):
    import datetime as dt

    lossy = [
        ("v double", 1.5, "bigint"), ("v decimal(10,4)", Decimal("1.2345"), "decimal(10,2)"),
        ("v timestamp_ntz", dt.datetime(2001, 1, 1, 5), "date"), ("v bigint", 2**53 + 1, "double"),
        ("v double", float("nan"), "bigint"), ("v string", "x", "int"), ("v bigint", 2**40, "int"),
    ]
    for old, value, new in lossy:
        df = spark.createDataFrame([(value,)], old)
        schema = T.StructType.fromDDL(f"v {new}")
        assert ft.cast_rejects(df, schema).first()["rejected"] == 1, (old, new)
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            ft.cast_to_schema(df, schema).collect()
    kept = [
        ("v double", 2.0, "bigint", 2), ("v string", "01", "int", 1), ("v int", None, "date", None),
        ("v timestamp_ntz", dt.datetime(2001, 1, 1), "date", dt.date(2001, 1, 1)),
        ("v decimal(10,4)", Decimal("1.2300"), "decimal(10,2)", Decimal("1.23")),
    ]
    for old, value, new, want in kept:
        if new == "date" and old == "v int":
            continue
        df = spark.createDataFrame([(value,)], old)
        assert ft.cast_to_schema(df, T.StructType.fromDDL(f"v {new}")).first()[0] == want


def test_settings_carry_queries_and_joins():
    from mirrorspan.plans.config import chunk_sizes, strategies_from_settings

    tables = {
        "head": {"strategy": "date_incremental", "watermark_column": "day", "chunk_size": 7},
        "part": {
            "strategy": "date_incremental", "watermark_column": ["day"],
            "custom_query": "SELECT 1", "delete_condition": "WHERE id IN (1)\n",
        },
    }
    clusters = {"c": {"parent_table": "head", "join_column": "id", "child_tables": [
        {"table": "line"}, {"table": "part", "join_via": "line"}]}}
    head, part = strategies_from_settings(tables, clusters)
    assert (part.custom_query, part.delete_condition, part.via) == ("SELECT 1", "id IN (1)", "line")
    assert part.parent == "head" and part.join_columns == ("id",)
    assert chunk_sizes([head, part]) == {"head": 7, "part": None}
    assert chunk_sizes([head, part], 9) == {"head": 9, "part": 9}
