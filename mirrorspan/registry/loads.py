"""Deletes, window replaces, writes, cleaning, casting and schema evolution."""

from dataclasses import replace

from pyspark.sql import functions as F, types as T

from mirrorspan.functions import clean, names, types as ft
from mirrorspan.model import DATE_INCREMENTAL, Strategy
from mirrorspan.operators import evolve, layout
from mirrorspan.operators.window import (
    child_survivors,
    survivors,
    window_keys,
    window_replace,
    window_replace_child,
)
from mirrorspan.plans.config import strategies_from_settings
from mirrorspan.plans.runner import Replicator
from mirrorspan.registry.core import EVENTS_AS_OF, N30, query
from mirrorspan.registry.derived import SOURCE_TYPES
from mirrorspan.session import local_frame, scratch_dir
from mirrorspan.sources.catalog import measured_columns
from mirrorspan.sources.store import TableStore

_CUT = "DATE '2001-07-02'"


def new_store(t, label: str) -> TableStore:
    return TableStore(t.spark, scratch_dir(t.spark, label))


# -- deletes and window replaces -------------------------------------------


@query(
    "delete_window",
    f"SELECT * FROM src_orders_null WHERE NOT coalesce(o_orderdate >= {_CUT}, false)",
    needs=("src_orders_null",),
)
def _(t):
    return survivors(t("src_orders_null"), ["o_orderdate"], N30)


@query(
    "delete_child_window",
    f"""SELECT * FROM tgt_lines l WHERE NOT EXISTS
        (SELECT 1 FROM tgt_orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderdate >= {_CUT})""",
    needs=("tgt_lines", "tgt_orders"),
)
def _(t):
    keys = window_keys(t("tgt_orders"), ["o_orderkey"], ["o_orderdate"], N30)
    return child_survivors(t("tgt_lines"), keys, ["l_orderkey"])


@query(
    "window_replace_parent",
    f"""SELECT * FROM tgt_orders_moved WHERE NOT (o_orderdate >= {_CUT})
        UNION ALL SELECT * FROM src_orders_null WHERE o_orderdate >= {_CUT}""",
    needs=("tgt_orders_moved", "src_orders_null"),
)
def _(t):
    return window_replace(t("tgt_orders_moved"), t("src_orders_null"), ["o_orderdate"], N30)


REPLACED_LINES = f"""
    SELECT * FROM tgt_lines l WHERE l_orderkey NOT IN (
        SELECT o_orderkey FROM (
            SELECT * FROM tgt_orders WHERE NOT (o_orderdate >= {_CUT})
            UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT}) p
        WHERE o_orderdate >= {_CUT})
    UNION ALL
    SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderdate >= {_CUT}"""


@query("window_replace_child", REPLACED_LINES, needs=("tgt_lines", "tgt_orders"))
def window_replace_lines(t):
    # Survivors of the parent lie outside the window by definition, so the
    # in-window keys of its refreshed copy are those of its source.
    keys = window_keys(t("orders"), ["o_orderkey"], ["o_orderdate"], N30)
    return window_replace_child(t("tgt_lines"), t("lineitem"), keys, keys, ["l_orderkey"])


@query("run_incremental_final", REPLACED_LINES, needs=("tgt_lines", "tgt_orders"))
def _(t):
    """A stale copy in a store, one incremental run, and its lines afterwards."""
    store = new_store(t, "run")
    strategies = [
        Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit="year"),
        Strategy("lineitem", DATE_INCREMENTAL, ("o_orderdate",), parent="orders",
                 join_columns=("l_orderkey",), parent_columns=("o_orderkey",), partition_unit="year"),
    ]
    stale = {"orders": t("tgt_orders"), "lineitem": t("tgt_lines")}
    tables = ["lineitem", "orders"]
    before = Replicator(t.spark, "shop", stale.__getitem__, tables, store, strategies)
    before.run_missing(N30)
    ledger = Replicator(t.spark, "shop", t, tables, store, strategies).run(N30)
    if ledger.filter("status <> 'SUCCESS'").count():
        raise RuntimeError("the incremental run failed")
    return store.read("shop_lineitem")


def _line_strategies(unit: str | None) -> list[Strategy]:
    return [
        Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit=unit),
        Strategy("lineitem", DATE_INCREMENTAL, ("o_orderdate",), parent="orders",
                 join_columns=("l_orderkey",), parent_columns=("o_orderkey",), partition_unit=unit),
    ]


def _stale_store(t, label: str, strategies: list[Strategy]) -> TableStore:
    store = new_store(t, label)
    stale = {"orders": t("tgt_orders"), "lineitem": t("tgt_lines")}
    Replicator(t.spark, "shop", stale.__getitem__, list(stale), store, strategies).run_missing(N30)
    return store


def _checked(ledger) -> None:
    if failed := ledger.filter("status <> 'SUCCESS'").collect():
        raise RuntimeError(f"the run failed: {failed}")


@query("run_first_final", "SELECT * FROM lineitem")
def _(t):
    """An incremental run without any copy: the history arrives too."""
    store = new_store(t, "first")
    strategies = _line_strategies("year")
    _checked(Replicator(t.spark, "shop", t, ["lineitem", "orders"], store, strategies).run(N30))
    return store.read("shop_lineitem")


@query(
    "run_child_twice_final",
    f"""SELECT * FROM tgt_lines l
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM tgt_orders WHERE o_orderdate >= {_CUT})
          AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= {_CUT})
        UNION ALL
        SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE o.o_orderdate >= {_CUT}""",
    needs=("tgt_lines", "tgt_orders"),
)
def _(t):
    """A child refreshed twice while its parent's copy lags behind."""
    strategies = _line_strategies("year")
    store = _stale_store(t, "twice", strategies)
    run = Replicator(t.spark, "shop", t, ["lineitem", "orders"], store, strategies)
    run.run_table("lineitem", N30)
    run.run_table("lineitem", N30)
    return store.read("shop_lineitem")


@query(
    "partition_unit_change",
    f"""SELECT d.units, d.unit, o.*
        FROM (VALUES ('month-year', 'year'), ('year-month', 'month')) d(units, unit), (
            SELECT * FROM tgt_orders WHERE NOT (o_orderdate >= {_CUT})
            UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT}) o""",
    needs=("tgt_orders",),
)
def _(t):
    """A copy that is partitioned by another unit than the run wants: the run keeps the
    copy's, and the command for it writes the whole copy anew."""
    out = []
    for old, new in (("month", "year"), ("year", "month")):
        store = new_store(t, "units")
        before, after = (
            [Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit=u)] for u in (old, new)
        )
        stale = {"orders": t("tgt_orders")}
        Replicator(t.spark, "shop", stale.__getitem__, ["orders"], store, before).run_missing(N30)
        run = Replicator(t.spark, "shop", t, ["orders"], store, after)
        _checked(run.run(N30))
        if store.snapshot("shop_orders").spec["unit"] != old:
            raise RuntimeError("the run wrote the copy anew")
        run.repartition("orders")
        unit = F.lit(store.snapshot("shop_orders").spec["unit"]).alias("unit")
        out.append(store.read("shop_orders").select(F.lit(f"{old}-{new}").alias("units"), unit, "*"))
    return out[0].unionByName(out[1])


@query(
    "run_custom_query_final",
    f"""SELECT * FROM tgt_lines
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= {_CUT})
        UNION ALL
        SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE o.o_orderdate >= {_CUT} AND l.l_quantity > 10""",
    needs=("tgt_lines",),
)
def _(t):
    """Query and delete condition from settings, replaced by partition."""
    settings = {
        "orders": {"strategy": "date_incremental", "watermark_column": "o_orderdate",
                   "partition_unit": "year"},
        "lineitem": {
            "strategy": "date_incremental", "watermark_column": ["o_orderdate"],
            "partition_unit": "year", "chunk_size": 50_000,
            "custom_query": "SELECT l.* FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = "
                            "o.o_orderkey WHERE o.o_orderdate >= :cutoff AND l.l_quantity > 10",
            "delete_condition": "WHERE l_orderkey IN (SELECT o_orderkey FROM {orders} "
                                "WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL {lookback_days} DAY)",
        },
    }
    clusters = {"sales": {"parent_table": "orders", "join_column": "l_orderkey",
                          "child_tables": [{"table": "lineitem"}]}}
    strategies = [
        replace(s, parent_columns=("o_orderkey",)) if s.parent else s
        for s in strategies_from_settings(settings, clusters)
    ]
    store = _stale_store(t, "custom", strategies)
    _checked(Replicator(t.spark, "shop", t, ["lineitem", "orders"], store, strategies).run(N30))
    return store.read("shop_lineitem")


@query(
    "load_time_column",
    """SELECT event_id,
              strftime(TIMESTAMP '2000-01-01' + to_seconds(CAST(event_id * 37 % 200000 AS BIGINT)),
                       '%H:%M:%S') AS took
       FROM events""",
)
def _(t):
    """A declared TIME column arrives as a duration and is stored as text."""
    store = new_store(t, "times")
    took = F.make_dt_interval(secs=F.col("event_id") * 37 % 200_000)
    source = {"events": t("events").select("event_id", took.alias("took"))}
    types = {"events": [("event_id", "bigint(20)"), ("took", "time")]}
    _checked(Replicator(
        t.spark, "shop", source.__getitem__, ["events"], store, source_types=types).run(N30))
    return store.read("shop_events")


# -- writes ------------------------------------------------------------------


@query(
    "store_reserved_names",
    """SELECT l_orderkey, l_linenumber, CAST(l_orderkey % 7 AS INT) AS version,
              l_returnflag AS window_part FROM lineitem""",
)
def _(t):
    """Columns that are called like folders of the store."""
    store = new_store(t, "names")
    lines = t("lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 7).cast("int").alias("version"),
        F.col("l_returnflag").alias("window_part"),
    )
    store.overwrite("lines", lines.withColumn("part", F.col("window_part")), "part")
    return store.read("lines")


@query("full_refresh", "SELECT * FROM orders")
def _(t):
    store = new_store(t, "full")
    store.overwrite("shop_orders", t("tgt_orders"))
    Replicator(t.spark, "shop", t, ["orders"], store).load("orders")
    return store.read("shop_orders")


@query(
    "append_load",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, NULL AS b_source FROM part
       UNION ALL
       SELECT p_partkey, p_name, p_brand, p_type, -1, p_retailprice, b_source FROM part_b""",
    needs=("part_b",),
)
def _(t):
    store = new_store(t, "append")
    store.append("shop_part", t("part"))
    Replicator(t.spark, "shop", {"part": t("part_b")}.__getitem__, ["part"], store).load("part", "append")
    return store.read("shop_part").fillna(-1, ["p_size"])


@query("truncate_keep_schema", "SELECT count(*) AS rows_before, 0 AS rows_after, 6 AS columns FROM orders")
def _(t):
    store = new_store(t, "truncate")
    before = store.overwrite("shop_orders", t("orders"))
    store.truncate("shop_orders")
    left = store.read("shop_orders")
    return left.agg(F.count(F.lit(1)).alias("rows_after")).select(
        F.lit(before).alias("rows_before"), "rows_after", F.lit(len(left.columns)).alias("columns")
    )


@query(
    "rebuild_verify",
    "SELECT count(*) AS rows_before, count(*) AS rows_after, true AS equal FROM lineitem",
)
def _(t):
    store = new_store(t, "rebuild")
    store.append("shop_lineitem", t("lineitem"))
    before, after = store.rebuild("shop_lineitem")
    return store.read("shop_lineitem").agg(F.count(F.lit(1)).alias("rows_after")).select(
        F.lit(before).alias("rows_before"), "rows_after", (F.col("rows_after") == after).alias("equal")
    )


def _event_layout(t) -> str:
    path = layout.archive_path(scratch_dir(t.spark, "layout"), "shop", "events")
    layout.write_layout(t("events"), path, F.col("ts"), cluster_by=["user_id"])
    return path


@query("layout_roundtrip", "SELECT *, strftime(ts, '%Y-%m-%d') AS date FROM events")
def _(t):
    events = layout.read_layout(t.spark, _event_layout(t))
    return events.withColumn("date", F.col("date").cast("string"))


@query(
    "retention_filter",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-24'",
)
def _(t):
    events = layout.read_layout(t.spark, _event_layout(t))
    kept = layout.retained(events, "date", EVENTS_AS_OF.date(), keep_days=7)
    return kept.select("event_id", F.col("date").cast("string").alias("date"))


# -- types and cleaning --------------------------------------------------------


@query(
    "type_mapping",
    f"""SELECT l.source_type, m.target_type, count(*) AS rows
        FROM typed_lines l JOIN (VALUES {", ".join(str(p) for p in SOURCE_TYPES.items())})
             AS m(source_type, target_type) ON l.source_type = m.source_type
        GROUP BY 1, 2""",
    needs=("typed_lines",),
)
def _(t):
    typed = t("typed_lines").groupBy("source_type").agg(F.count(F.lit(1)).alias("rows"))
    return typed.select("source_type", ft.map_type_column(F.col("source_type")).alias("target_type"), "rows")


_EVENT_SOURCE_TYPES = [
    ("event_id", "bigint(20) unsigned"), ("ts", "datetime"), ("user_id", "int unsigned"),
    ("event_type", "varchar(20)"), ("value", "double"), ("props", "json"),
]


@query("cast_to_mapped", "SELECT * FROM events")
def _(t):
    return ft.cast_to_schema(t("ev_text"), ft.target_schema(_EVENT_SOURCE_TYPES))


@query(
    "cast_reject_count",
    """SELECT 'event_id' AS column_name, 'bigint' AS target_type, count(*) FILTER (WHERE false) AS rejected
       FROM ev_text_bad
       UNION ALL SELECT 'ts', 'timestamp_ntz', count(*) FILTER (WHERE ts = '2024-13-01') FROM ev_text_bad
       UNION ALL SELECT 'user_id', 'bigint', count(*) FILTER (WHERE try_cast(user_id AS BIGINT) IS NULL) FROM ev_text_bad
       UNION ALL SELECT 'event_type', 'string', 0
       UNION ALL SELECT 'value', 'double', count(*) FILTER (WHERE value = 'x') FROM ev_text_bad
       UNION ALL SELECT 'props', 'string', 0""",
    needs=("ev_text_bad",),
)
def _(t):
    return ft.cast_rejects(t("ev_text_bad"), ft.target_schema(_EVENT_SOURCE_TYPES))


@query(
    "cast_lossy_rejects",
    """SELECT 'whole' AS column_name, 'bigint' AS target_type,
              count(*) FILTER (WHERE l_quantity / 8 <> floor(l_quantity / 8)) AS rejected FROM lineitem
       UNION ALL SELECT 'day', 'date', count(*) FILTER (WHERE l_linenumber % 3 <> 0) FROM lineitem
       UNION ALL SELECT 'cents', 'decimal(15,2)',
              count(*) FILTER (WHERE CAST(l_quantity AS INT) % 4 <> 0) FROM lineitem
       UNION ALL SELECT 'single', 'float', count(*) FILTER (WHERE l_orderkey % 2 = 1) FROM lineitem""",
)
def _(t):
    """Values that a cast would round or cut."""
    lines = t("lineitem").select(
        (F.col("l_quantity") / 8).alias("whole"),
        F.expr("timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(0, l_linenumber % 3)").alias("day"),
        (F.col("l_quantity").cast("int") * F.lit(0.0025).cast("decimal(6,4)")).cast("decimal(15,4)").alias("cents"),
        (F.lit(2**24) + F.col("l_orderkey") % 2).alias("single"),
    )
    schema = T.StructType.fromDDL("whole bigint, day date, cents decimal(15,2), single float")
    return ft.cast_rejects(lines, schema)


_PAIRS = {
    ("int", "float"): "double", ("smallint", "float"): "float", ("bigint", "float"): "string",
    ("bigint", "double"): "string", ("int", "double"): "double", ("int", "bigint"): "bigint",
    ("int", "decimal(15,4)"): "decimal(15,4)", ("bigint", "decimal(15,4)"): "decimal(23,4)",
    ("decimal(10,2)", "decimal(15,4)"): "decimal(15,4)", ("decimal(38,0)", "decimal(15,4)"): "string",
    ("date", "timestamp_ntz"): "timestamp_ntz", ("date", "int"): "string", ("string", "int"): "string",
    ("double", "decimal(15,4)"): "string",
}


@query(
    "schema_reconcile_types",
    f"""WITH p(old, new, wide) AS (VALUES {", ".join(f"('{a}', '{b}', '{w}')" for (a, b), w in _PAIRS.items())})
        SELECT old, new, wide AS catalog, wide AS load, 2 * count(*) AS lines, 2 * count(*) AS kept
        FROM p, lineitem GROUP BY ALL""",
)
def _(t):
    """Columns of every line under an old type, then under a new one, loaded into one table;
    the catalog's rule and the type and values that are read back."""

    def value(number, kind):
        """A line number under a type; for dates so many days."""
        if kind in ("date", "timestamp_ntz"):
            return F.date_add(F.lit("2001-01-01").cast("date"), F.col(number)).cast(kind)
        return F.col(number).cast(kind)

    def typed(side):
        columns = [value("l_linenumber", pair[side]).alias(f"c{k}") for k, pair in enumerate(_PAIRS)]
        return t("lineitem").select(*columns, F.col("l_linenumber").alias("n"))

    store = new_store(t, "types")
    read = {"old": typed(0), "new": typed(1)}
    for state in ("old", "new"):
        source = read[state]
        Replicator(
            t.spark, "shop", lambda _, df=source: df, ["lines"], store, clean=False,
            type_policy=evolve.MOST_PERMISSIVE,
        ).load("lines", "append")
    back = store.read("shop_lines")
    kinds = {f.name: f.dataType for f in back.schema.fields}
    facts = []
    for k, (old, new) in enumerate(_PAIRS):
        # Each value is one of the two that were sent, as the wider type has it.
        sent = [value("n", side).cast(kinds[f"c{k}"]) for side in (old, new)]
        same = (F.col(f"c{k}") == sent[0]) | (F.col(f"c{k}") == sent[1])
        facts.append(F.struct(
            F.lit(old).alias("old"), F.lit(new).alias("new"),
            F.lit(kinds[f"c{k}"].simpleString()).alias("load"),
            F.count(f"c{k}").alias("lines"), F.count_if(same).alias("kept"),
        ))
    found = back.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))
    catalog = evolve.wider_type(F.col("old"), F.col("new")).alias("catalog")
    return found.select("old", "new", catalog, "load", "lines", "kept")


_TOKENS = "('nan', 'None', 'null', 'NULL', '')"


@query(
    "clean_text",
    f"""SELECT doc_id, lang, CASE WHEN replace(text, chr(0), '') IN {_TOKENS} THEN NULL
                                 ELSE replace(text, chr(0), '') END AS text FROM docs_dirty""",
    needs=("docs_dirty",),
)
def _(t):
    return clean.clean_text_columns(t("docs_dirty"))


@query(
    "null_token_counts",
    f"""WITH c AS (SELECT text, CASE WHEN replace(text, chr(0), '') IN {_TOKENS} THEN NULL
                                     ELSE replace(text, chr(0), '') END AS cleaned FROM docs_dirty)
        SELECT 'text' AS column_name, count(*) FILTER (WHERE text IS NULL) AS already_null,
               count(*) FILTER (WHERE text IS NOT NULL AND cleaned IS NULL) AS became_null,
               count(*) FILTER (WHERE cleaned <> text) AS text_changed FROM c""",
    needs=("docs_dirty",),
)
def _(t):
    return clean.null_token_counts(t("docs_dirty"), ["text"])


@query(
    "duration_to_time",
    """WITH d AS (SELECT event_id, (event_id * 37) % 200000 AS s FROM events)
       SELECT event_id, s AS seconds,
              lpad(CAST((s % 86400) // 3600 AS VARCHAR), 2, '0') || ':' ||
              lpad(CAST((s % 3600) // 60 AS VARCHAR), 2, '0') || ':' ||
              lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS time_text,
              s >= 86400 AS out_of_day FROM d""",
)
def _(t):
    seconds = F.col("event_id") * 37 % 200000
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("seconds").cast("decimal(18,6)"))
    return t("events").select("event_id", seconds.alias("seconds")).select(
        "event_id", "seconds",
        clean.duration_to_time(length).alias("time_text"),
        clean.out_of_day(length).alias("out_of_day"),
    )


@query(
    "parse_table_spec",
    """SELECT doc_id, spec,
              CASE WHEN contains(spec, '.') THEN substr(spec, 1, strpos(spec, '.') - 1) END AS database_name,
              CASE WHEN contains(spec, '.') THEN substr(spec, strpos(spec, '.') + 1) END AS table_name
       FROM table_specs""",
    needs=("table_specs",),
)
def _(t):
    database, table = names.split_table_spec(F.col("spec"))
    return t("table_specs").select(
        "doc_id", "spec", database.alias("database_name"), table.alias("table_name")
    )


# -- schema evolution -----------------------------------------------------------

_V1 = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_size": "bigint",
       "p_retailprice": "double", "p_origin": "string"}
_V2 = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
       "p_size": "int", "p_retailprice": "double"}


def _states(t):
    return measured_columns(t("part_v1"), "part"), measured_columns(t("part_v2"), "part")


def _state_sql(table: str, columns: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS full_type, count({c}) < count(*) AS nullable, "
        f"count({c}) AS non_null_rows FROM {table}"
        for c, k in columns.items()
    )


_BOTH_STATES = f"e AS ({_state_sql('part_v1', _V1)}), n AS ({_state_sql('part_v2', _V2)})"


def _reconcile_sql(conflict_type: str) -> str:
    return f"""WITH {_BOTH_STATES}
        SELECT column_name, e.full_type AS existing_type, n.full_type AS new_type,
               CASE WHEN e.full_type <> n.full_type THEN {conflict_type}
                    ELSE coalesce(e.full_type, n.full_type) END AS result_type,
               coalesce(e.nullable, true) AS result_nullable,
               CASE WHEN e.full_type IS NULL THEN 'added' WHEN n.full_type IS NULL THEN 'kept'
                    WHEN e.full_type <> n.full_type THEN 'conflict' ELSE 'same' END AS status
        FROM e FULL JOIN n USING (column_name)"""


_STATES = ("part_v1", "part_v2")


@query("schema_reconcile", _reconcile_sql("e.full_type"), needs=_STATES)
def _(t):
    return evolve.reconcile_catalogs(*_states(t))


@query("schema_reconcile_policy", _reconcile_sql("'bigint'"), needs=_STATES)
def _(t):
    old, new = _states(t)
    return evolve.reconcile_catalogs(old, new, evolve.MOST_PERMISSIVE)


@query(
    "schema_mode_changes",
    f"""WITH {_BOTH_STATES}
        SELECT n.column_name, n.nullable AS source_nullable, coalesce(e.nullable, true) AS result_nullable
        FROM n LEFT JOIN e USING (column_name) WHERE n.nullable <> coalesce(e.nullable, true)""",
    needs=_STATES,
)
def _(t):
    return evolve.mode_changes(*_states(t))


@query(
    "schema_added_columns",
    f"WITH {_BOTH_STATES} SELECT column_name, full_type, non_null_rows FROM n WHERE column_name NOT IN (SELECT column_name FROM e)",
    needs=_STATES,
)
def _(t):
    return evolve.added_columns(*_states(t)).select("column_name", "full_type", "non_null_rows")


@query(
    "evolve_union",
    """SELECT p_partkey, p_name, p_brand, NULL AS p_type, p_size, p_retailprice, p_origin FROM part_v1
       UNION ALL SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, NULL FROM part_v2""",
    needs=_STATES,
)
def _(t):
    return evolve.evolve_union(t("part_v1"), t("part_v2"))


_ORDER_SOURCE_TYPES = [
    ("o_orderkey", "bigint(20)"), ("o_custkey", "int unsigned"), ("o_orderstatus", "char(1)"),
    ("o_totalprice", "decimal(15,2)"), ("o_orderdate", "datetime"), ("o_orderpriority", "varchar(15)"),
]


@query(
    "schema_comparison",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{s}' AS source_type, '{m}' AS target_type, "
        f"count({c}) < count(*) AS nullable, count({c}) AS non_null_rows FROM src_orders_null"
        for (c, s), m in zip(
            _ORDER_SOURCE_TYPES, ["bigint", "bigint", "string", "decimal(15,2)", "timestamp_ntz", "string"]
        )
    ),
    needs=("src_orders_null",),
)
def _(t):
    measured = measured_columns(t("src_orders_null"), "orders")
    declared = local_frame(t.spark, _ORDER_SOURCE_TYPES, "column_name string, source_type string")
    return evolve.schema_comparison(declared, measured)


@query(
    "required_null_counts",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS null_rows FROM src_orders_null"
        for c in ("o_orderkey", "o_custkey", "o_orderdate")
    ),
    needs=("src_orders_null",),
)
def _(t):
    return evolve.required_null_counts(t("src_orders_null"), ["o_orderkey", "o_custkey", "o_orderdate"])


@query(
    "precision_loss_counts",
    """SELECT 'l_quantity' AS column_name, 'double' AS from_type, 'bigint' AS to_type,
              count(*) FILTER (WHERE l_quantity <> floor(l_quantity)) AS changed_rows FROM lineitem
       UNION ALL SELECT 'l_extendedprice', 'double', 'bigint',
              count(*) FILTER (WHERE l_extendedprice <> floor(l_extendedprice)) FROM lineitem
       UNION ALL SELECT 'l_orderkey', 'bigint', 'smallint',
              count(*) FILTER (WHERE l_orderkey NOT BETWEEN -32768 AND 32767) FROM lineitem
       UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', 'date',
              count(*) FILTER (WHERE l_shipdate <> CAST(l_shipdate AS DATE)) FROM lineitem""",
)
def _(t):
    wanted = T.StructType(
        [
            T.StructField("l_quantity", T.LongType()),
            T.StructField("l_extendedprice", T.LongType()),
            T.StructField("l_orderkey", T.ShortType()),
            T.StructField("l_shipdate", T.DateType()),
        ]
    )
    return evolve.precision_loss_counts(t("lineitem"), wanted)


