"""Queries of what keeps copies up cheaply: streams of children, kept views, skipping, trees,
pages, chains of references, curves, sketches and buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mirrorspan.model import DATE_INCREMENTAL, Relationship, Strategy
from mirrorspan.operators import (
    hash_tree,
    inclusion,
    layout,
    maintain,
    paths,
    quality,
    sketches,
    views,
)
from mirrorspan.operators.joins import key_set, rows_with_keys
from mirrorspan.operators.window import window_keys, window_replace
from mirrorspan.plans.runner import PARTITION, Replicator
from mirrorspan.registry.checks import _KEYS
from mirrorspan.registry.core import N30, RELATIONSHIPS, TABLES, query
from mirrorspan.registry.loads import _CUT, REPLACED_LINES, _checked, new_store
from mirrorspan.session import materialized, scratch_dir
from mirrorspan.sources import bucketed
from mirrorspan.sources import catalog as cat
from mirrorspan.sources.catalog import union_all
from mirrorspan.sources.pages import scan_balanced, table_pages
from mirrorspan.streaming import children as ch
from mirrorspan.streaming import incremental as inc


def _strategies(unit: str = "year") -> list[Strategy]:
    return [
        Strategy("orders", DATE_INCREMENTAL, ("o_orderdate",), partition_unit=unit,
                 index_columns=("o_orderkey",)),
        Strategy("lineitem", DATE_INCREMENTAL, ("o_orderdate",), parent="orders",
                 join_columns=("l_orderkey",), parent_columns=("o_orderkey",), partition_unit=unit),
    ]


def _stale(t, label: str, orders: str = "tgt_orders", unit: str = "year"):
    """A store with stale copies, and a replicator of the real tables."""
    store = new_store(t, label)
    stale = {"orders": t(orders), "lineitem": t("tgt_lines")}
    names = ["orders", "lineitem"]
    before = Replicator(t.spark, "shop", stale.__getitem__, names, store, _strategies(unit))
    _checked(before.run_missing(N30))
    return store, Replicator(t.spark, "shop", t, names, store, _strategies(unit))


# -- streams of children -------------------------------------------------------------------


@query("stream_child_window_final", REPLACED_LINES, needs=("tgt_lines", "tgt_orders"))
def _(t):
    """Orders and lines as files in no order: the first start sees some lines without their
    order and some orders without lines, the second one, of the same checkpoint, the rest."""
    store, run = _stale(t, "stream-children")
    run.run_table("orders", N30)
    strategy = _strategies()[1]
    orders, lines = t("orders"), t("lineitem")
    folders = {n: scratch_dir(t.spark, f"stream-{n}") for n in ("orders", "lineitem")}
    checkpoint = scratch_dir(t.spark, "checkpoint")
    write = ch.replace_child_batches(store, "shop", strategy, N30, "lines", lines.schema)
    for early in (True, False):
        first = (F.col("o_orderkey") % 2 == 0) == early
        orders.filter(first).write.mode("append").parquet(folders["orders"])
        first = ((F.col("l_orderkey") + F.col("l_linenumber")) % 3 > 0) == early
        lines.filter(first).write.mode("append").parquet(folders["lineitem"])
        routed = ch.routed_children(
            inc.stream_files(t.spark, folders["orders"], orders.schema),
            inc.stream_files(t.spark, folders["lineitem"], lines.schema),
            strategy, N30, salts=1,
        )
        inc.run_to_end(inc.start(routed, write, checkpoint))
    return store.read("shop_lineitem")


# -- kept views -----------------------------------------------------------------------------


def daily_view() -> maintain.View:
    return maintain.View(
        "view_daily", {"headers": "shop_orders", "lines": "shop_lineitem"},
        lambda f: views.daily_sums(f["headers"], f["lines"], _KEYS),
        ("day", "branch_key"), "lines",
        {"headers": ("o_orderkey",), "lines": ("l_orderkey",)},
        F.date_format("day", "yyyy-MM"),
    )


@query(
    "view_daily_sales_kept",
    f"""WITH o AS (SELECT o_orderkey, o_orderdate FROM tgt_orders_moved WHERE NOT (o_orderdate >= {_CUT})
                   UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= {_CUT}),
             l AS ({REPLACED_LINES}),
             i AS (SELECT l_orderkey, l_suppkey, count(*) AS n,
                          sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM l GROUP BY 1, 2)
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, s_suppkey AS branch_key, s_name AS branch_name,
               CAST(sum(n) AS BIGINT) AS lines, count(*) AS invoices, CAST(sum(amount) AS DOUBLE) AS amount
        FROM i JOIN o ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY 1, 2, 3""",
    needs=("tgt_orders_moved", "tgt_lines"),
)
def _(t):
    """The view of stale copies, brought up to an incremental run that deletes, adds and
    moves orders."""
    store, run = _stale(t, "kept-sales", "tgt_orders_moved")
    view = daily_view()
    maintain.follow(store, view)
    _checked(run.run(N30))
    maintain.follow(store, view)
    sales = views.named_sales(maintain.read_view(store, view), t("supplier"), _KEYS)
    return sales.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "view_stock_kept",
    f"""SELECT l_suppkey AS branch_key, l_partkey AS product_key,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, count(*) AS entries
        FROM ({REPLACED_LINES}) GROUP BY 1, 2""",
    needs=("tgt_lines", "tgt_orders"),
)
def _(t):
    """Stock of two states, as sums over rows, brought up to an incremental run."""

    def stock(df, status):
        return df.filter(F.col("l_linestatus") == status).select(
            F.col("l_suppkey").alias("branch_key"), F.col("l_partkey").alias("product_key"),
            F.col("l_quantity").alias("quantity"),
        )

    store, run = _stale(t, "kept-stock")
    view = maintain.View(
        "view_stock", {"lines": "shop_lineitem"},
        lambda f: views.stock_sums(stock(f["lines"], "F"), stock(f["lines"], "O")),
        ("branch_key", "product_key"), "entries",
    )
    maintain.follow(store, view)
    _checked(run.run(N30))
    maintain.follow(store, view)
    return maintain.read_view(store, view).withColumn("quantity", F.col("quantity").cast("double"))


# -- skipping -------------------------------------------------------------------------------


@query(
    "skipping_index_parts",
    f"""SELECT strftime(p.o_orderdate, '%Y-%m') AS part, count(*) AS rows
        FROM tgt_lines l JOIN tgt_orders p ON l.l_orderkey = p.o_orderkey
        WHERE l.l_orderkey IN (SELECT o_orderkey FROM tgt_orders WHERE o_orderdate >= {_CUT})
        GROUP BY 1""",
    needs=("tgt_lines", "tgt_orders"),
)
def _(t):
    """Partitions of a child's copy that hold the window's keys, and how many rows; only
    those that the index leaves are read."""
    store, _ = _stale(t, "skipping", unit="month")
    keys = window_keys(store.read("shop_orders"), ["o_orderkey"], ["o_orderdate"], N30)
    may = store.parts_with_keys("shop_lineitem", keys, ["l_orderkey"])
    read = store.read("shop_lineitem", may.__contains__, keep_partition=True)
    found = rows_with_keys(read, keys, ["l_orderkey"])
    return found.groupBy(F.col(PARTITION).alias("part")).agg(F.count(F.lit(1)).alias("rows"))


# -- drift by tree ----------------------------------------------------------------------------


@query(
    "sync_drift_tree",
    """WITH c AS (SELECT * FROM lineitem WHERE l_orderkey % 701 <> 0
                  UNION ALL SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem
                            WHERE l_orderkey % 701 = 0 AND l_linenumber > 1
                  UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 997 = 0),
            n AS (SELECT * EXCLUDE (src), sum(src) AS a, sum(1 - src) AS b
                  FROM (SELECT *, 1 AS src FROM lineitem UNION ALL SELECT *, 0 FROM c)
                  GROUP BY ALL),
            k AS (SELECT l_orderkey, l_linenumber, sum(a) AS a, sum(b) AS b,
                         count(*) FILTER (WHERE a <> b) AS differ FROM n GROUP BY ALL)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN b = 0 THEN 'missing' WHEN a = 0 THEN 'ghost' WHEN b > a THEN 'duplicate'
                   WHEN b < a THEN 'fewer' ELSE 'changed' END AS drift
       FROM k WHERE differ > 0""",
)
def _(t):
    """A copy that differs in a few orders: only the leaves they lie in are compared."""
    lines = t("lineitem")
    late = lines.filter("l_orderkey % 701 = 0 AND l_linenumber > 1")
    copy = (
        lines.filter("l_orderkey % 701 <> 0")
        .unionByName(late.withColumn("l_quantity", F.col("l_quantity") + 1))
        .unionByName(lines.filter("l_orderkey % 997 = 0"))
    )
    return hash_tree.sync_drift_tree(lines, copy, ["l_orderkey", "l_linenumber"])


@query(
    "sync_drift_tree_window",
    f"""WITH r AS (SELECT * FROM tgt_orders_moved WHERE NOT (o_orderdate >= {_CUT})
                   UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT}),
             k AS (SELECT o_orderkey, count(*) AS n FROM r GROUP BY 1)
        SELECT coalesce(o.o_orderkey, k.o_orderkey) AS o_orderkey,
               CASE WHEN k.n IS NULL THEN 'missing' WHEN o.o_orderkey IS NULL THEN 'ghost'
                    WHEN k.n > 1 THEN 'duplicate' ELSE 'changed' END AS drift
        FROM orders o FULL JOIN k ON o.o_orderkey = k.o_orderkey
        WHERE k.n IS NULL OR o.o_orderkey IS NULL OR k.n > 1 OR EXISTS
              (SELECT 1 FROM r WHERE r.o_orderkey = o.o_orderkey AND
               (r.o_totalprice <> o.o_totalprice OR r.o_orderdate <> o.o_orderdate))""",
    needs=("tgt_orders_moved",),
)
def _(t):
    """A copy of which a third differs: everything is looked at, and the rows are the same."""
    refreshed = window_replace(t("tgt_orders_moved"), t("orders"), ["o_orderdate"], N30)
    return hash_tree.sync_drift_tree(t("orders"), refreshed, ["o_orderkey"])


# -- inclusion dependencies ---------------------------------------------------------------------

_DISCOVERED = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"),
}
_TEXTS = {
    "r_name", "n_name", "c_name", "c_mktsegment", "s_name", "p_name", "p_brand", "p_type",
    "o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus",
}


def _inclusions_sql() -> str:
    values = " UNION ALL ".join(
        f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, '{'text' if c in _TEXTS else 'whole'}' AS k, "
        f"CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL"
        for t, columns in _DISCOVERED.items() for c in columns
    )
    rows = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS rows FROM {t}" for t in _DISCOVERED)
    return f"""
        WITH v AS ({values}), r AS ({rows}),
             d AS (SELECT t, c, k, count(*) AS n FROM v GROUP BY ALL),
             keys AS (SELECT d.* FROM d JOIN r USING (t) WHERE d.n = r.rows),
             common AS (SELECT a.t AS t1, a.c AS c1, b.t AS t2, b.c AS c2, count(*) AS n
                        FROM v a JOIN v b ON a.k = b.k AND a.v = b.v AND (a.t <> b.t OR a.c <> b.c)
                        JOIN keys ON keys.t = b.t AND keys.c = b.c GROUP BY ALL)
        SELECT t1 AS table_name, c1 AS column_name, t2 AS ref_table, c2 AS ref_column,
               d.n AS distinct_values, keys.n AS key_values
        FROM common JOIN d ON d.t = t1 AND d.c = c1 JOIN keys ON keys.t = t2 AND keys.c = c2
        WHERE common.n = d.n"""


@query("inclusion_dependencies", _inclusions_sql())
def _(t):
    """Columns whose values all stand in a key column, whatever the columns are called."""
    return inclusion.inclusions({n: t(n) for n in _DISCOVERED}, _DISCOVERED)


# -- pages of equal depth ------------------------------------------------------------------------

_SKEWED = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7
                         ELSE l_orderkey * l_orderkey END AS k, l_orderkey, l_partkey, l_linenumber
             FROM {lineitem}"""


@query(
    "scan_balanced_pages",
    f"""SELECT k, l_orderkey, l_partkey, l_linenumber, true AS fits
        FROM ({_SKEWED.format(lineitem="lineitem")})""",
)
def _(t):
    """A key with a hot value and ever wider gaps, in pages of at most 5,000 rows; ``fits``
    says that a row's page is no larger, or is of one key."""
    lines = t.spark.sql(_SKEWED, lineitem=t("lineitem"))
    found = table_pages(lines, "k", 5000)
    paged = scan_balanced(lines, "k", found)
    sizes = paged.groupBy("page").agg(
        ((F.count(F.lit(1)) <= 5000) | (F.min("k") == F.max("k"))).alias("fits")
    )
    return paged.join(sizes, "page").drop("page")


# -- chains of references ---------------------------------------------------------------------------

_CYCLE = Relationship("fk_region_best", "region", ("r_best",), "customer", ("c_custkey",))


def _edges_sql() -> str:
    rows = ", ".join(str((r.table, r.name, r.ref_table)) for r in (*RELATIONSHIPS, _CYCLE))
    return f"edges(from_table, constraint_name, to_table) AS (VALUES {rows})"


@query(
    "fk_closure",
    f"""WITH RECURSIVE {_edges_sql()},
        sizes AS ({" UNION ALL ".join(f"SELECT '{n}' AS t, count(*) AS n FROM {n}" for n in TABLES[:7])}),
        {paths.CLOSURE_SQL.format(edges="edges").replace("WITH RECURSIVE", "").replace(
            "SELECT from_table, to_table, hops, path, is_cycle FROM chains",
            "SELECT c.*, s.n AS to_rows FROM (SELECT from_table, to_table, hops, path, is_cycle FROM chains) c "
            "LEFT JOIN sizes s ON c.to_table = s.t")}""",
)
def _(t):
    """Chains of references, a cycle among them, with the rows of the table they end in."""
    fks = cat.fk_catalog(t.spark, (*RELATIONSHIPS, _CYCLE))
    sizes = quality.row_counts({n: t(n) for n in TABLES[:7]})
    sizes = sizes.select(F.col("table_name").alias("to_table"), F.col("rows").alias("to_rows"))
    return paths.closure(fks).join(sizes, "to_table", "left")


@query(
    "rows_along_four_hops",
    """SELECT l.* FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 2""",
)
def _(t):
    """Lines of one region, its key carried down nation, customer and orders."""
    by_name = {r.name: r for r in RELATIONSHIPS}
    path = [by_name[n] for n in (
        "fk_nation_region", "fk_customer_nation", "fk_order_customer", "fk_line_order")]
    start = key_set(t("region").filter("r_regionkey = 2"), ["r_regionkey"])
    return paths.rows_along(t, start, path)


# -- seasonal counts ---------------------------------------------------------------------------------


@query(
    "row_count_seasonal",
    """WITH runs AS (
           SELECT event_type AS table_name, CAST(ts AS DATE) AS run_date, count(*) AS rows FROM events
           WHERE dayofweek(ts) NOT IN (0, 6) OR event_id % 5 = 0
           GROUP BY 1, 2),
       odd AS (SELECT table_name, run_date,
                      CASE WHEN run_date = DATE '2024-01-23' THEN rows // 3 ELSE rows END AS rows FROM runs),
       before AS (SELECT *, list(CAST(rows AS DOUBLE)) OVER (
                      PARTITION BY table_name, isodow(run_date) ORDER BY run_date
                      ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS past FROM odd),
       centred AS (SELECT *, list_median(past) AS expected_rows FROM before WHERE len(past) >= 3),
       spread AS (SELECT *, greatest(
                      1.4826 * list_median(list_transform(past, lambda x: abs(x - expected_rows))),
                      0.05 * expected_rows) AS spread FROM centred)
       SELECT table_name, run_date, rows, expected_rows,
              round(abs(rows - expected_rows) / spread, 4) AS score,
              abs(rows - expected_rows) / spread > 4 AS anomalous
       FROM spread""",
)
def _(t):
    """Daily counts of event types, few at weekends, with one day that lost two thirds."""
    kept = t("events").filter((~F.weekday("ts").isin(5, 6)) | (F.col("event_id") % 5 == 0))
    runs = kept.groupBy(F.col("event_type").alias("table_name"), F.to_date("ts").alias("run_date")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    lost = F.col("run_date") == F.lit("2024-01-23").cast("date")
    runs = runs.withColumn("rows", F.when(lost, F.floor(F.col("rows") / 3)).otherwise(F.col("rows")))
    return quality.seasonal_anomaly(runs)


# -- curve layout ---------------------------------------------------------------------------------------


@query(
    "curve_layout_filter",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
       WHERE l_suppkey BETWEEN 3 AND 5 OR l_shipdate >= TIMESTAMP '2001-06-01 00:00:00'""",
)
def _(t):
    """Lines in Z-order by part, supplier and date, filtered by the latter two."""
    path = scratch_dir(t.spark, "curve")
    layout.write_curve(t("lineitem"), path, ["l_partkey", "l_suppkey", "l_shipdate"], 8)
    lines = layout.read_layout(t.spark, path)
    late = F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    return lines.filter(F.col("l_suppkey").between(3, 5) | late).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


# -- quality by partition ---------------------------------------------------------------------------------


@query(
    "column_quality_kept",
    f"""WITH r AS (SELECT * FROM tgt_orders WHERE NOT (o_orderdate >= {_CUT})
                   UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT})
        SELECT 'o_orderkey' AS column_name, count(*) AS rows, count(*) - count(o_orderkey) AS null_rows,
               CAST(min(o_orderkey) AS DOUBLE) AS low_number, CAST(max(o_orderkey) AS DOUBLE) AS high_number,
               '-' AS low_text, '-' AS high_text, true AS distinct_near, true AS median_near FROM r
        UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), min(o_custkey), max(o_custkey),
               '-', '-', true, true FROM r
        UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice), min(o_totalprice),
               max(o_totalprice), '-', '-', true, true FROM r
        UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), -1, -1,
               min(o_orderstatus), max(o_orderstatus), true, true FROM r
        UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), -1, -1,
               min(o_orderpriority), max(o_orderpriority), true, true FROM r
        UNION ALL SELECT 'o_orderdate', count(*), count(*) - count(o_orderdate), -1, -1,
               strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'), strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'),
               true, true FROM r""",
    needs=("tgt_orders",),
)
def _(t):
    """Quality of a copy from sketches by month, of which a refresh renews the last ones; the
    estimates are held against exact numbers."""
    store, run = _stale(t, "sketches")
    sketches.follow_quality(store, "shop_orders", "orders_quality")
    _checked(run.run(N30, ["orders"]))
    sketches.follow_quality(store, "shop_orders", "orders_quality")
    # A sketch's quantiles are drawn by chance, so they are made once.
    found = materialized(sketches.read_quality(store, "orders_quality"), "orders-quality")
    copy = store.read("shop_orders")
    numbers = ("o_orderkey", "o_custkey", "o_totalprice")
    exact = union_all(
        copy.select(c).distinct().agg(F.lit(c).alias("column_name"), F.count(c).alias("exact"))
        for c in copy.columns
    )
    medians = {r[0]: r[1] for r in found.select("column_name", "q50").collect()}  # a row a column
    ranks = copy.agg(F.array(*(
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.count_if(F.col(c).cast("double") < F.lit(medians[c]).cast("double")).alias("less"),
            F.count_if(F.col(c).cast("double") <= F.lit(medians[c]).cast("double")).alias("most"),
        )
        for c in numbers
    )).alias("all")).select(F.inline("all"))
    off = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.06)
    # The median is one of the values, so its rank says whether it lies between two quantiles.
    last = F.col("n") - 1
    median = (F.col("most") > F.ceil(F.lit(0.45) * last)) & (F.col("less") <= F.floor(F.lit(0.55) * last))
    median = F.coalesce(F.when(F.col("n") > 0, median & F.col("q50").isNotNull()), F.lit(True))
    return found.join(exact, "column_name").join(F.broadcast(ranks), "column_name", "left").select(
        "column_name", "rows", "null_rows",
        F.coalesce("low_number", F.lit(-1.0)).alias("low_number"),
        F.coalesce("high_number", F.lit(-1.0)).alias("high_number"),
        F.coalesce("low_text", F.lit("-")).alias("low_text"),
        F.coalesce("high_text", F.lit("-")).alias("high_text"),
        off.alias("distinct_near"), median.alias("median_near"),
    )


# -- bucketed tables ----------------------------------------------------------------------------------------


@query(
    "view_invoices_bucketed",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey, l_linenumber, l_suppkey,
               l_partkey, l_quantity, l_extendedprice
        FROM ({REPLACED_LINES}) l JOIN (
            SELECT * FROM tgt_orders WHERE NOT (o_orderdate >= {_CUT})
            UNION ALL SELECT * FROM orders WHERE o_orderdate >= {_CUT}) o ON l_orderkey = o_orderkey""",
    needs=("tgt_lines", "tgt_orders"),
)
def _(t):
    """Lines with their orders from bucketed tables that followed a refresh: no shuffle."""
    store, run = _stale(t, "buckets", unit="year")
    tag = uuid.uuid4().hex[:8]
    names = {n: f"mirrorspan_{n}_{tag}" for n in ("orders", "lineitem")}
    keys = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey"]}
    paths_of = {n: scratch_dir(t.spark, f"bucketed-{n}") for n in names}
    buckets = bucketed.buckets_for(max(store.read(f"shop_{n}").count() for n in names))

    def publish():
        for n, name in names.items():
            bucketed.publish(store, f"shop_{n}", name, keys[n], buckets, paths_of[n])

    publish()
    _checked(run.run(N30))
    publish()
    lines, orders = (bucketed.read_published(t.spark, names[n]) for n in ("lineitem", "orders"))
    joined = bucketed.join_published(lines, orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_custkey", "l_linenumber",
        "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")
