"""Relations, plans, ledgers, quality checks, views and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from mirrorspan.model import DATE_INCREMENTAL, FULL_REFRESH, Relationship, RunContext, Strategy
from mirrorspan.operators import quality, relate, views
from mirrorspan.operators.joins import join_on, join_test
from mirrorspan.operators.window import window_replace
from mirrorspan.plans import sync_plan as sp
from mirrorspan.registry.core import AS_OF, EVENTS_AS_OF, N30, RELATIONSHIPS, TABLES, query
from mirrorspan.registry.loads import new_store
from mirrorspan.registry.scans import (
    BUSINESS,
    BUSINESS_COLUMNS,
    business_keys,
    catalog_sql,
    columns_of,
)
from mirrorspan.session import local_frame, scratch_dir
from mirrorspan.sources import catalog as cat
from mirrorspan.streaming import incremental as inc

_CUT = "DATE '2001-07-02'"


# -- relations -----------------------------------------------------------------


@query(
    "common_columns",
    f"""WITH c AS ({catalog_sql(BUSINESS_COLUMNS)})
        SELECT a.table_name AS table1, a.column_name AS column1, b.table_name AS table2,
               b.column_name AS column2, a.full_type AS data_type1, b.full_type AS data_type2,
               a.non_null_rows AS values1, b.non_null_rows AS values2
        FROM c a JOIN c b ON a.column_name = b.column_name AND a.table_name <> b.table_name
        WHERE a.column_name LIKE '%ID%' OR a.column_name LIKE '%id%'
           OR a.column_name LIKE '%numero%' OR a.column_name LIKE '%comprobante%'""",
    needs=BUSINESS,
)
def _(t):
    return relate.shared_columns({n: t(n) for n in BUSINESS})


@query(
    "common_columns_order",
    f"""WITH c AS ({catalog_sql(BUSINESS_COLUMNS)})
        SELECT row_number() OVER (ORDER BY a.table_name, a.column_name, b.table_name) AS position,
               a.table_name AS table1, a.column_name AS column1, b.table_name AS table2
        FROM c a JOIN c b ON a.column_name = b.column_name AND a.table_name <> b.table_name
        WHERE a.column_name LIKE '%ID%' OR a.column_name LIKE '%id%'
           OR a.column_name LIKE '%numero%' OR a.column_name LIKE '%comprobante%'""",
    needs=BUSINESS,
)
def _(t):
    """The rows of common_columns with the place at which each comes."""
    found = relate.shared_columns({n: t(n) for n in BUSINESS})
    return cat.numbered(found).select("position", "table1", "column1", "table2")


@query(
    "join_test",
    """SELECT count(*) AS total_joined_rows, count(DISTINCT o_orderkey) AS unique_t1_keys,
              count(DISTINCT l_orderkey) AS unique_t2_keys, count(*) > 0 AS join_works
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def _(t):
    return join_test(t("orders"), t("lineitem"), ["o_orderkey"], ["l_orderkey"])


_TESTED = RELATIONSHIPS + (
    Relationship("fk_absent_column", "lineitem", ("l_batch",), "orders", ("o_batch",)),
)


def _join_test_sql(r: Relationship) -> str:
    head = (
        f"'{r.name}' AS constraint_name, '{r.ref_table}' AS table1, '{r.table}' AS table2, "
        f"'{','.join(r.ref_columns)}={','.join(r.columns)}' AS join_column"
    )
    if r.name == "fk_absent_column":
        return (
            f"SELECT {head}, 0 AS total_joined_rows, 0 AS unique_t1_keys, 0 AS unique_t2_keys, "
            "false AS join_works, 'no column o_batch, l_batch' AS error"
        )
    on = " AND ".join(f"a.{p} = b.{c}" for p, c in zip(r.ref_columns, r.columns))
    key1 = ", ".join(f"a.{c}" for c in r.ref_columns)
    key2 = ", ".join(f"b.{c}" for c in r.columns)
    return (
        f"SELECT {head}, count(*) AS total_joined_rows, count(DISTINCT ({key1})) AS unique_t1_keys, "
        f"count(DISTINCT ({key2})) AS unique_t2_keys, count(*) > 0 AS join_works, NULL AS error "
        f"FROM {r.ref_table} a JOIN {r.table} b ON {on}"
    )


_TESTS_SQL = "\nUNION ALL ".join(_join_test_sql(r) for r in _TESTED)


@query("join_test_all", _TESTS_SQL, needs=("returns",))
def _(t):
    return relate.join_tests(t, _TESTED)


_RECOMMENDED = "\nUNION ALL ".join(
    "SELECT 'confirmed_join' AS type, 'Use {jc} to join {a} and {b}' AS message, "
    "'INNER JOIN {a} ON {on}' AS join_text, count(*) AS total_joined_rows FROM {a} a JOIN {b} b ON {cond} "
    "HAVING count(*) > 0".format(
        jc=",".join(r.ref_columns) + "=" + ",".join(r.columns),
        a=r.ref_table,
        b=r.table,
        on=" AND ".join(f"{r.table}.{c} = {r.ref_table}.{p}" for p, c in zip(r.ref_columns, r.columns)),
        cond=" AND ".join(f"a.{p} = b.{c}" for p, c in zip(r.ref_columns, r.columns)),
    )
    for r in RELATIONSHIPS
)


@query("join_recommendations", _RECOMMENDED, needs=("returns",))
def _(t):
    return relate.join_recommendations(relate.join_tests(t, _TESTED))


_ORPHAN_NAMES = {"lineitem": "lines_orphan"}


def _orphan_sql(r: Relationship) -> str:
    child = _ORPHAN_NAMES.get(r.table, r.table)
    parent = r.ref_table
    on = " AND ".join(f"p.{p} = c.{c}" for p, c in zip(r.ref_columns, r.columns))
    key = ", ".join(f"c.{c}" for c in r.columns)
    lost = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on})"
    return (
        f"SELECT '{r.name}' AS constraint_name, '{r.table}' AS table_name, '{parent}' AS referenced_table, "
        f"count(*) AS child_rows, count(*) FILTER (WHERE lost) AS orphan_rows, "
        f"count(DISTINCT k) FILTER (WHERE lost) AS orphan_keys "
        f"FROM (SELECT ({key}) AS k, {lost} AS lost FROM {child} c)"
    )


_SIMPLE_FKS = tuple(r for r in RELATIONSHIPS if r.kind == "single_column")
_ORPHANS_SQL = "\nUNION ALL ".join(_orphan_sql(r) for r in _SIMPLE_FKS)


@query("fk_orphans", _ORPHANS_SQL, needs=("lines_orphan",))
def _(t):
    return relate.all_fk_orphans(lambda n: t(_ORPHAN_NAMES.get(n, n)), _SIMPLE_FKS)


_FK_ROWS = ", ".join(
    str((r.name, r.kind, r.table, r.ref_table)) for r in RELATIONSHIPS
)
_CHILD_ROWS = "\nUNION ALL ".join(
    f"SELECT '{r.name}' AS constraint_name, count(*) AS child_rows FROM {r.table}" for r in RELATIONSHIPS
)


@query(
    "fk_statistics",
    f"""WITH fks AS (SELECT * FROM (VALUES {_FK_ROWS}) AS v(constraint_name, kind, table_name, referenced_table)),
             n AS ({_CHILD_ROWS})
        SELECT count(*) AS total, count(*) FILTER (WHERE kind = 'single_column') AS single_column,
               count(*) FILTER (WHERE kind = 'composite') AS composite,
               count(DISTINCT referenced_table) AS tables_with_incoming,
               count(DISTINCT table_name) AS tables_with_outgoing,
               CAST(sum(child_rows) AS BIGINT) AS child_rows, 0 AS orphan_rows
        FROM fks JOIN n USING (constraint_name)""",
    needs=("returns",),
)
def _(t):
    checked = relate.all_fk_orphans(t, RELATIONSHIPS).select("constraint_name", "child_rows", "orphan_rows")
    fks = cat.fk_catalog(t.spark, RELATIONSHIPS)
    return relate.fk_statistics(fks.join(checked, "constraint_name"))


_FK_TABLES = sorted({r.table for r in RELATIONSHIPS} | {r.ref_table for r in RELATIONSHIPS})


@query(
    "fk_by_table",
    f"""WITH fks AS (SELECT * FROM (VALUES {_FK_ROWS}) AS v(constraint_name, kind, table_name, referenced_table)),
             n AS ({" UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS rows FROM {x}" for x in _FK_TABLES)})
        SELECT n.table_name, n.rows,
               (SELECT count(*) FROM fks f WHERE f.table_name = n.table_name) AS outgoing_count,
               (SELECT count(*) FROM fks f WHERE f.referenced_table = n.table_name) AS incoming_count,
               coalesce((SELECT string_agg(constraint_name, ',' ORDER BY constraint_name) FROM fks f
                         WHERE f.table_name = n.table_name), '') AS outgoing,
               coalesce((SELECT string_agg(constraint_name, ',' ORDER BY constraint_name) FROM fks f
                         WHERE f.referenced_table = n.table_name), '') AS incoming
        FROM n""",
    needs=("returns",),
)
def _(t):
    lists = relate.fk_by_table(cat.fk_catalog(t.spark, RELATIONSHIPS))
    return lists.join(quality.row_counts({n: t(n) for n in _FK_TABLES}), "table_name")


@query(
    "fk_reverse_index",
    "\nUNION ALL ".join(
        f"SELECT '{ref}' AS referenced, {len(who)} AS \"references\", '{','.join(sorted(who))}' AS referring, "
        f"count({ref.split('.')[1]}) AS referenced_values FROM {ref.split('.')[0]}"
        for ref, who in {
            f"{r.ref_table}.{rc}": [
                f"{x.table}.{c}"
                for x in RELATIONSHIPS
                for c, xc in zip(x.columns, x.ref_columns)
                if (x.ref_table, xc) == (r.ref_table, rc)
            ]
            for r in RELATIONSHIPS
            for rc in r.ref_columns
        }.items()
    ),
)
def _(t):
    index = relate.referenced_by(cat.fk_catalog(t.spark, RELATIONSHIPS))
    keys: dict[str, set[str]] = {}
    for r in RELATIONSHIPS:
        keys.setdefault(r.ref_table, set()).update(r.ref_columns)
    values = cat.column_catalog({n: t(n) for n in keys}, columns=keys).select(
        F.concat("table_name", F.lit("."), "column_name").alias("referenced"),
        F.col("non_null_rows").alias("referenced_values"),
    )
    return index.join(values, "referenced")


_BUSINESS_FKS = (
    Relationship("fk_line_header", "sales_line", ("IDOrder",), "sales_header", ("IDOrder",)),
    Relationship("fk_line_product", "sales_line", ("IDProduct",), "product", ("IDProduct",)),
)


@query(
    "relationship_report",
    f"""WITH c AS ({catalog_sql(BUSINESS_COLUMNS)}),
             f AS (SELECT * FROM (VALUES ('IDOrder', 'sales_header'), ('IDProduct', 'product')) AS v(col, parent)),
             j AS (SELECT 'IDOrder' AS col, 'sales_header' AS parent, count(*) AS n
                   FROM sales_header JOIN sales_line USING (IDOrder)
                   UNION ALL SELECT 'IDProduct', 'product', count(*)
                   FROM product JOIN sales_line USING (IDProduct))
        SELECT 'foreign_key' AS section, 'sales_line.' || col AS subject, parent || '.' || col AS detail FROM f
        UNION ALL
        SELECT 'common_column', a.table_name || '.' || a.column_name, b.table_name || '.' || b.column_name
        FROM c a JOIN c b ON a.column_name = b.column_name AND a.table_name <> b.table_name
        WHERE a.column_name LIKE '%ID%' OR a.column_name LIKE '%id%' OR a.column_name LIKE '%numero%'
        UNION ALL
        SELECT 'key_column', table_name || '.' || column_name, full_type FROM c
        WHERE table_name IN ('sales_header', 'sales_line', 'product')
          AND (column_name LIKE '%ID%' OR column_name LIKE '%numero%' OR table_name || column_name = 'productname')
        UNION ALL SELECT 'join_test', parent || '-sales_line', CAST(n AS VARCHAR) FROM j
        UNION ALL
        SELECT 'recommendation', 'Use ' || col || '=' || col || ' to join ' || parent || ' and sales_line',
               'INNER JOIN ' || parent || ' ON sales_line.' || col || ' = ' || parent || '.' || col
        FROM j WHERE n > 0""",
    needs=BUSINESS,
)
def _(t):
    tables = {n: t(n) for n in BUSINESS}
    named = {n: cat.columns_like(df, relate.SHARED_NAME_PATTERNS) for n, df in tables.items()}
    catalog = cat.column_catalog(tables, columns=named)
    fks = cat.fk_catalog(t.spark, _BUSINESS_FKS)
    return relate.relationship_report(t, fks, catalog, business_keys(t), _BUSINESS_FKS)


@query(
    "join_composite_key",
    """SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_returnflag
       FROM lineitem l JOIN returns r ON l.l_orderkey = r.r_orderkey AND l.l_partkey = r.r_partkey""",
    needs=("returns",),
)
def _(t):
    joined = join_on(t("lineitem"), t("returns"), ["l_orderkey", "l_partkey"], ["r_orderkey", "r_partkey"])
    return joined.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")


# -- plans -----------------------------------------------------------------------

_STRATEGIES = (
    Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), 100_000, priority="critical"),
    Strategy("lineitem", DATE_INCREMENTAL, ("o_orderdate",), 50_000, parent="orders",
             join_columns=("l_orderkey",), parent_columns=("o_orderkey",), priority="critical"),
    Strategy("events", DATE_INCREMENTAL, ("ts",), 50_000, priority="high"),
    Strategy("documents", DATE_INCREMENTAL, ("changed_at",), 100_000, priority="medium"),
    Strategy("part", DATE_INCREMENTAL, (), None, priority="medium"),
    Strategy("customer", FULL_REFRESH, (), 200_000),
)
_STRATEGY_ROWS = ", ".join(
    "('{}', '{}', '{}', {}, {})".format(
        s.table, s.kind, ",".join(s.watermark_columns), s.chunk_rows or "NULL", sp.PRIORITY_RANK[s.priority]
    )
    for s in _STRATEGIES
)
_ALL_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in TABLES)
_SIZE_CHUNK = "CASE WHEN rows > 10000000 THEN 50000 WHEN rows >= 1000000 THEN 100000 ELSE 200000 END"


@query(
    "sync_plan",
    f"""WITH s AS (SELECT * FROM (VALUES {_STRATEGY_ROWS}) AS v(table_name, strategy, watermarks, chunk, rnk)),
             n AS ({_ALL_COUNTS})
        SELECT 'shop' AS database_name, n.table_name, 'shop_' || n.table_name AS target_table,
               coalesce(strategy, 'full_refresh') AS strategy,
               CASE WHEN strategy = 'date_incremental' AND watermarks <> '' THEN 'window_replace'
                    ELSE 'overwrite' END AS action,
               coalesce(watermarks, '') AS watermarks, coalesce(chunk, {_SIZE_CHUNK}) AS chunk_rows,
               CAST(ceil(rows / coalesce(chunk, {_SIZE_CHUNK})) AS BIGINT) AS pages, rows,
               coalesce(rnk, 5) AS priority_rank
        FROM n LEFT JOIN s USING (table_name)""",
)
def _(t):
    plan = sp.sync_plan(cat.table_list(t.all(), "shop"), sp.strategies_frame(t.spark, _STRATEGIES))
    return sp.in_run_order(plan)


_COPIED = ("orders", "lineitem", "customer", "part", "supplier", "nation", "region", "events")


@query(
    "missing_tables",
    f"""WITH n AS ({_ALL_COUNTS})
        SELECT 'shop' AS database_name, table_name, 'shop_' || table_name AS target_table, rows
        FROM n WHERE table_name NOT IN {_COPIED}""",
)
def _(t):
    copies = local_frame(t.spark, [(f"shop_{n}",) for n in _COPIED], "table_name string")
    return sp.missing_tables(cat.table_list(t.all(), "shop"), copies)


@query(
    "config_lint",
    """SELECT 'documents' AS table_name, 'documents' AS owner, 'changed_at' AS watermark_column,
              'unknown_column' AS problem
       UNION ALL SELECT 'part', 'part', NULL, 'no_watermark'
       UNION ALL SELECT 'events', 'events', 'ts', 'empty_column' FROM events HAVING count(ts) = 0
       UNION ALL SELECT 'orders', 'orders', 'o_orderdate', 'empty_column' FROM orders HAVING count(o_orderdate) = 0
       UNION ALL SELECT 'lineitem', 'orders', 'o_orderdate', 'empty_column' FROM orders HAVING count(o_orderdate) = 0""",
)
def _(t):
    watermarks = sp.watermark_columns(_STRATEGIES)
    catalog = cat.column_catalog({n: t(n) for n in watermarks}, columns=watermarks)
    return sp.config_lint(sp.strategies_frame(t.spark, _STRATEGIES), catalog)


# -- counts and ledgers ------------------------------------------------------------


@query("row_counts", _ALL_COUNTS)
def _(t):
    return quality.row_counts(t.all())


@query(
    "query_count",
    """SELECT count(*) AS rows FROM (SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                                     WHERE o.o_orderstatus = 'F')""",
)
def _(t):
    done = t("orders").filter("o_orderstatus = 'F'")
    return quality.query_count(join_on(t("lineitem"), done, ["l_orderkey"], ["o_orderkey"]))


@query(
    "page_counts",
    f"""WITH n AS ({_ALL_COUNTS})
        SELECT table_name, rows, {_SIZE_CHUNK} AS chunk_rows,
               CAST(ceil(rows / ({_SIZE_CHUNK})) AS BIGINT) AS pages FROM n""",
)
def _(t):
    return quality.page_counts(quality.row_counts(t.all()))


_LEDGERS = ("ledger_first", "ledger_second")
_LEDGER = "SELECT * FROM ledger_first UNION ALL SELECT * FROM ledger_second"


def _ledger(t):
    return quality.merge_ledgers(t("ledger_first"), t("ledger_second"))


@query(
    "ledger_summary",
    f"""SELECT run_id, CAST(sum(rows) AS BIGINT) AS total_rows, count(*) AS tables,
               count(*) FILTER (WHERE status = 'SUCCESS' AND rows > 0) AS successful_tables,
               count(*) FILTER (WHERE status = 'FAILED') AS failed_tables,
               CASE WHEN sum(rows) > 0 THEN 'success' ELSE 'warning' END AS run_status
        FROM ({_LEDGER}) GROUP BY run_id""",
    needs=_LEDGERS,
)
def _(t):
    return quality.ledger_summary(_ledger(t))


@query("ledger_below_threshold", f"SELECT * FROM ({_LEDGER}) WHERE rows <= 1000", needs=_LEDGERS)
def _(t):
    return quality.below_threshold(_ledger(t), 1000)


@query("ledger_failures", f"SELECT * FROM ({_LEDGER}) WHERE status = 'FAILED'", needs=_LEDGERS)
def _(t):
    return quality.ledger_failures(_ledger(t))


@query(
    "row_count_anomaly",
    """SELECT table_name, a.rows AS previous_rows, b.rows AS current_rows,
              round(abs(b.rows - a.rows) / a.rows, 4) AS change
       FROM ledger_first a JOIN ledger_second b USING (table_name)
       WHERE abs(b.rows - a.rows) / a.rows > 0.5""",
    needs=_LEDGERS,
)
def _(t):
    return quality.row_count_anomaly(t("ledger_first"), t("ledger_second"))


def _bytes_sql(table: str) -> str:
    # Bytes of the fixed-width types of the driver's tables.
    width = {"int": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8}
    parts = []
    for name, kind in columns_of(table):
        if kind == "string":
            parts.append(f"coalesce(strlen({name}), 0)")
        elif kind == "array<float>":
            parts.append(f"coalesce(len({name}) * 4, 0)")
        else:
            parts.append(f"CASE WHEN {name} IS NULL THEN 0 ELSE {width[kind]} END")
    return f"SELECT '{table}' AS table_name, count(*) AS rows, CAST(sum({' + '.join(parts)}) AS BIGINT) AS bytes FROM {table}"


@query(
    "largest_tables",
    f"SELECT * FROM ({' UNION ALL '.join(_bytes_sql(n) for n in TABLES)}) ORDER BY rows DESC, table_name LIMIT 20",
)
def _(t):
    return quality.largest_tables(t.all(), 20, measure="values")


@query(
    "type_histogram",
    "\nUNION ALL ".join(
        "SELECT '{}' AS table_name, {} AS columns, {} AS strings, {} AS integers, {} AS floats, {} AS dates, "
        "0 AS booleans, {} AS others, count(*) AS rows FROM {}".format(
            n,
            len(columns_of(n)),
            *[sum(k in kinds for _, k in columns_of(n))
              for kinds in (("string",), ("int", "bigint"), ("double",), ("timestamp_ntz",), ("array<float>",))],
            n,
        )
        for n in TABLES
    ),
)
def _(t):
    tables = t.all()
    return cat.type_histogram(cat.declared_columns(t.spark, tables), quality.row_counts(tables))


# -- source against copy -------------------------------------------------------------

_PAIRS = {"orders": "tgt_orders", "lineitem": "tgt_lines", "customer": "customer", "part": "part_b"}


@query(
    "count_parity",
    "SELECT *, target_rows - source_rows AS difference, target_rows = source_rows AS equal FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{a}' AS table_name, (SELECT count(*) FROM {a}) AS source_rows, (SELECT count(*) FROM {b}) AS target_rows"
        for a, b in _PAIRS.items()
    )
    + "\nUNION ALL SELECT 'events', (SELECT count(*) FROM events), 0)",
    needs=("tgt_orders", "tgt_lines", "part_b"),
)
def _(t):
    source = quality.row_counts({a: t(a) for a in (*_PAIRS, "events")})
    return quality.count_parity(source, quality.row_counts({a: t(b) for a, b in _PAIRS.items()}))


@query(
    "sync_drift",
    f"""WITH r AS (SELECT * FROM tgt_orders_moved WHERE NOT (o_orderdate >= {_CUT})
                   UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT}),
             k AS (SELECT o_orderkey, count(*) AS n FROM r GROUP BY 1)
        SELECT coalesce(o.o_orderkey, k.o_orderkey) AS o_orderkey,
               CASE WHEN k.n IS NULL THEN 'missing' WHEN o.o_orderkey IS NULL THEN 'ghost'
                    WHEN k.n > 1 THEN 'duplicate' ELSE 'changed' END AS drift
        FROM orders o FULL JOIN k ON o.o_orderkey = k.o_orderkey
        WHERE k.n IS NULL OR o.o_orderkey IS NULL OR k.n > 1 OR EXISTS
              (SELECT 1 FROM r WHERE r.o_orderkey = o.o_orderkey AND
               (r.o_custkey IS DISTINCT FROM o.o_custkey OR r.o_orderstatus IS DISTINCT FROM o.o_orderstatus
                OR r.o_totalprice IS DISTINCT FROM o.o_totalprice
                OR r.o_orderdate IS DISTINCT FROM o.o_orderdate
                OR r.o_orderpriority IS DISTINCT FROM o.o_orderpriority))""",
    needs=("tgt_orders_moved",),
)
def _(t):
    refreshed = window_replace(t("tgt_orders_moved"), t("orders"), ["o_orderdate"], N30)
    return quality.sync_drift(t("orders"), refreshed, ["o_orderkey"])


@query(
    "sync_drift_bags",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem),
            c AS (SELECT * FROM s WHERE l_orderkey % 7 <> 0
                  UNION ALL SELECT * FROM s WHERE l_orderkey % 11 = 0
                  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM s
                            WHERE l_orderkey % 7 = 0 AND l_orderkey % 13 = 0),
            n AS (SELECT l_orderkey, l_linenumber, l_quantity, sum(src) AS a, sum(1 - src) AS b
                  FROM (SELECT *, 1 AS src FROM s UNION ALL SELECT *, 0 FROM c) GROUP BY ALL),
            k AS (SELECT l_orderkey, l_linenumber, sum(a) AS a, sum(b) AS b,
                         count(*) FILTER (WHERE a <> b) AS differ FROM n GROUP BY ALL)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN b = 0 THEN 'missing' WHEN a = 0 THEN 'ghost' WHEN b > a THEN 'duplicate'
                   WHEN b < a THEN 'fewer' ELSE 'changed' END AS drift
       FROM k WHERE differ > 0""",
)
def _(t):
    """A key that is not unique: rows are compared as bags."""
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    copy = (
        lines.filter("l_orderkey % 7 <> 0")
        .unionByName(lines.filter("l_orderkey % 11 = 0"))
        .unionByName(lines.filter("l_orderkey % 7 = 0 AND l_orderkey % 13 = 0").withColumn(
            "l_quantity", F.col("l_quantity") + 1))
    )
    return quality.sync_drift(lines, copy, ["l_orderkey", "l_linenumber"])


@query(
    "row_count_anomaly_vanished",
    """SELECT a.table_name, a.rows AS previous_rows, coalesce(b.rows, 0) AS current_rows,
              round(abs(coalesce(b.rows, 0) - a.rows) / a.rows, 4) AS change
       FROM ledger_first a LEFT JOIN (SELECT * FROM ledger_second WHERE table_name NOT LIKE '%orders%') b
            USING (table_name)
       WHERE abs(coalesce(b.rows, 0) - a.rows) / a.rows > 0.5 OR b.rows IS NULL""",
    needs=_LEDGERS,
)
def _(t):
    """A table that the current run lacks."""
    current = t("ledger_second").filter("table_name NOT LIKE '%orders%'")
    return quality.row_count_anomaly(t("ledger_first"), current)


_TS = "TIMESTAMP '2024-01-31 00:00:00'"


@query(
    "freshness",
    f"""WITH m AS (SELECT 'events' AS table_name, max(ts) AS newest FROM events
                   UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
                   UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)
        SELECT table_name, newest,
               CAST(floor((epoch_us({_TS}) - epoch_us(newest)) / 3600000000) AS BIGINT) AS age_hours,
               epoch_us({_TS}) - epoch_us(newest) > 13 * 3600000000 AS stale FROM m""",
)
def _(t):
    tables = {"events": (t("events"), "ts"), "orders": (t("orders"), "o_orderdate"),
              "lineitem": (t("lineitem"), "l_shipdate")}
    return quality.freshness(tables, EVENTS_AS_OF)


@query(
    "watermark_ledger",
    "\nUNION ALL ".join(
        f"SELECT 'shop' AS database_name, '{n}' AS table_name, '{c}' AS watermark_column, max({c}) AS last_value, "
        f"{_TS} AS updated_at, CASE WHEN max({c}) IS NULL THEN 'EMPTY' ELSE 'SUCCESS' END AS status FROM {n}"
        for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ),
)
def _(t):
    columns = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return quality.watermark_ledger({("shop", n): (t(n), c) for n, c in columns.items()}, EVENTS_AS_OF)


def _quality_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows, "
        f"count(*) - count({c}) AS null_rows, count(DISTINCT {c}) AS distinct_values, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {table}"
        for c in columns
    )


@query(
    "column_quality",
    _quality_sql("src_orders_null", [c for c, _ in columns_of("orders")])
    + "\nUNION ALL "
    + _quality_sql("documents", [c for c, _ in columns_of("documents")]),
    needs=("src_orders_null",),
)
def _(t):
    return cat.union_all(
        quality.column_quality(t(n), n, exact_distinct=True) for n in ("src_orders_null", "documents")
    )


# -- views ------------------------------------------------------------------------------

_KEYS = {
    "line_header": "l_orderkey", "header": "o_orderkey", "line_branch": "l_suppkey", "branch": "s_suppkey",
    "line_product": "l_partkey", "product": "p_partkey", "line_amount": "l_extendedprice",
    "header_date": "o_orderdate", "branch_name": "s_name", "line_status": "l_linestatus", "open_value": "O",
    "line_date": "l_shipdate",
}


@query(
    "view_invoices_consolidated",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey, l_linenumber, s_suppkey, s_name,
              p_partkey, p_name, l_quantity, l_extendedprice
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN part ON l_partkey = p_partkey""",
)
def _(t):
    joined = views.invoices_consolidated(t("orders"), t("lineitem"), t("supplier"), t("part"), _KEYS)
    return joined.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_custkey", "l_linenumber",
        "s_suppkey", "s_name", "p_partkey", "p_name", "l_quantity", "l_extendedprice",
    )


@query(
    "view_daily_sales",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, s_suppkey AS branch_key, s_name AS branch_name,
              count(*) AS lines, count(DISTINCT o_orderkey) AS invoices,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       GROUP BY 1, 2, 3""",
)
def _(t):
    lines = t("lineitem")
    # A count of whole files is answered from their footers.
    sales = views.daily_sales(t("orders"), lines, t("supplier"), _KEYS, lines.count())
    return sales.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "view_stock_union",
    """SELECT l_suppkey AS branch_key, l_partkey AS product_key,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, count(*) AS entries
       FROM (SELECT * FROM lineitem WHERE l_linestatus = 'F'
             UNION ALL SELECT * FROM lineitem WHERE l_linestatus = 'O') GROUP BY 1, 2""",
)
def _(t):
    def stock(status):
        return t("lineitem").filter(F.col("l_linestatus") == status).select(
            F.col("l_suppkey").alias("branch_key"), F.col("l_partkey").alias("product_key"),
            F.col("l_quantity").alias("quantity"),
        )

    return views.stock_union(stock("F"), stock("O"))


@query(
    "view_stock_fractions",
    """SELECT l_suppkey AS branch_key, l_partkey AS product_key,
              CAST(sum(CAST(l_quantity * 0.0625 AS DECIMAL(15,4))) AS DOUBLE) AS quantity,
              count(*) AS entries
       FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    """Quantities of four decimals."""
    def stock(status):
        return t("lineitem").filter(F.col("l_linestatus") == status).select(
            F.col("l_suppkey").alias("branch_key"), F.col("l_partkey").alias("product_key"),
            (F.col("l_quantity") * 0.0625).cast("decimal(15,4)").alias("quantity"),
        )

    return views.stock_union(stock("F"), stock("O"))


@query(
    "view_product_master",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, NULL AS b_source FROM part
       UNION ALL SELECT p_partkey, p_name, p_brand, p_type, -1, p_retailprice, b_source FROM part_b""",
    needs=("part_b",),
)
def _(t):
    return views.product_master(t("part"), t("part_b")).fillna(-1, ["p_size"])


@query(
    "view_order_tracking",
    """SELECT o_orderkey, count(l_orderkey) AS lines,
              count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
              min(l_shipdate) AS first_date, max(l_shipdate) AS last_date,
              CASE WHEN count(l_orderkey) = 0 THEN 'empty'
                   WHEN count(*) FILTER (WHERE l_linestatus = 'O') = 0 THEN 'closed'
                   WHEN count(*) FILTER (WHERE l_linestatus = 'O') = count(l_orderkey) THEN 'open'
                   ELSE 'partial' END AS tracking_status
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def _(t):
    return views.order_tracking(t("orders"), t("lineitem"), _KEYS)


# -- streams ------------------------------------------------------------------------------


def _orders_stream(t):
    # The pattern makes Spark list it: a file is taken as it is, a folder's files one by one.
    return inc.stream_files(t.spark, f"{t.folder}/orders.parque[t]", t("orders").schema)


@query("stream_append_final", "SELECT * FROM orders")
def _(t):
    store = new_store(t, "stream")
    write = inc.append_batches(store, "shop", "orders", "orders-files")
    inc.run_to_end(inc.start(_orders_stream(t), write, scratch_dir(t.spark, "checkpoint")))
    return store.read("shop_orders")


@query(
    "stream_window_replace_final",
    f"""SELECT * FROM tgt_orders WHERE NOT (o_orderdate >= {_CUT})
        UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT}""",
    needs=("tgt_orders",),
)
def _(t):
    store = new_store(t, "stream")
    store.append("shop_orders", t("tgt_orders"))
    strategy = Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",))
    write = inc.replace_window_batches(store, "shop", strategy, N30, "orders-window")
    inc.run_to_end(inc.start(_orders_stream(t), write, scratch_dir(t.spark, "checkpoint")))
    return store.read("shop_orders")


@query(
    "stream_second_run_final",
    """SELECT * FROM orders WHERE o_orderdate < DATE '2001-07-03'
       UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
       WHERE o_orderdate >= DATE '2001-07-03'""",
)
def _(t):
    """Two days of one stream under one name and checkpoint; the second day's files
    hold the window again, with other prices."""
    store, files = new_store(t, "stream"), scratch_dir(t.spark, "stream-files")
    checkpoint = scratch_dir(t.spark, "checkpoint")
    orders = t("orders")
    strategy = Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit="month")
    store.append("shop_orders", orders.withColumn("o_totalprice", F.lit(0.0)).filter(
        F.col("o_orderdate") >= F.lit(N30.cutoff)))
    store.append("shop_orders", orders.filter(F.col("o_orderdate") < F.lit(N30.cutoff)))
    next_day = RunContext(AS_OF + dt.timedelta(days=1), 30)
    for ctx, extra in ((N30, 0), (next_day, 1)):
        day = orders.withColumn("o_totalprice", F.col("o_totalprice") + extra)
        day.write.mode("append").parquet(files)
        write = inc.replace_window_batches(store, "shop", strategy, ctx, "orders-days")
        stream = inc.stream_files(t.spark, files, orders.schema)
        inc.run_to_end(inc.start(stream, write, checkpoint))
    return store.read("shop_orders")
