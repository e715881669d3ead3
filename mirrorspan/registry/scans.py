"""Sources, catalogs, projections and lookback filters."""

import uuid

from pyspark.sql import functions as F

from mirrorspan.functions import clean
from mirrorspan.functions.dates import in_window, in_window_null_guarded
from mirrorspan.operators import views
from mirrorspan.operators.joins import keys_via, rows_with_keys
from mirrorspan.operators.relate import KEY_NAME_PATTERNS
from mirrorspan.operators.window import child_window_rows, window_keys, window_rows
from mirrorspan.registry.core import EVENTS_N3, N3, N30, RELATIONSHIPS, TABLES, query
from mirrorspan.session import scratch_dir
from mirrorspan.sources import catalog as cat, scan

# The schemas of the driver's tables, for the oracle side.
SCHEMAS = {
    "region": "r_regionkey:int,r_name:string",
    "nation": "n_nationkey:int,n_name:string,n_regionkey:int",
    "customer": "c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string",
    "supplier": "s_suppkey:bigint,s_name:string,s_nationkey:int,s_acctbal:double",
    "part": "p_partkey:bigint,p_name:string,p_brand:string,p_type:string,p_size:int,p_retailprice:double",
    "orders": "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,"
              "o_orderdate:timestamp_ntz,o_orderpriority:string",
    "lineitem": "l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double,"
                "l_extendedprice:double,l_discount:double,l_tax:double,l_returnflag:string,"
                "l_linestatus:string,l_shipdate:timestamp_ntz",
    "events": "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string",
    "documents": "doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint",
    "embeddings": "vec_id:bigint,embedding:array<float>,label:int",
    "pages": "page_id:bigint,url:string,html:string",
    "benchmark": "item_id:bigint,text:string",
    "labels": "doc_id:bigint,quality:int,toxic:int",
    "conversations": "conv_id:bigint,turn:bigint,role:string,text:string",
}


def columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in SCHEMAS[table].split(",")]


def catalog_sql(columns: dict[str, list[tuple[str, str]]]) -> str:
    """Oracle for a measured catalog of the given tables."""
    rows = []
    for table, cols in columns.items():
        for i, (name, kind) in enumerate(cols, start=1):
            length = f"max(length({name}))" if kind == "string" else "NULL"
            rows.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, {i} AS ordinal_position, "
                f"'{kind}' AS full_type, count({name}) < count(*) AS nullable, "
                f"coalesce({length}, -1) AS max_length, count(*) AS table_rows, "
                f"count({name}) AS non_null_rows FROM {table}"
            )
    return "\nUNION ALL ".join(rows)


@query("scan_full", "SELECT * FROM orders")
def _(t):
    return scan.scan_table(t.spark, f"{t.folder}/orders.parquet")


@query(
    "scan_query",
    """SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       WHERE o.o_orderdate >= DATE '2001-07-02'""",
)
def _(t):
    return scan.scan_query(
        t.spark,
        "SELECT l.* FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey "
        "WHERE o.o_orderdate >= :cutoff",
        {"lineitem": t("lineitem"), "orders": t("orders")},
        N30,
    )


@query(
    "scan_key_pages",
    """SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS page, min(o_orderkey) AS first_key,
              max(o_orderkey) AS last_key, count(*) AS rows
       FROM orders GROUP BY 1""",
)
def _(t):
    return scan.key_pages(t("orders"), "o_orderkey", 1000)


@query("scan_pages_union", "SELECT *, CAST(floor(o_orderkey / 1000) AS BIGINT) AS page FROM orders")
def _(t):
    return scan.scan_pages(t("orders"), "o_orderkey", 1000)


@query(
    "sample_rows",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10",
)
def _(t):
    return scan.sample_rows(t("customer"), ["c_custkey", "c_name", "c_mktsegment"], ["c_custkey"], 10)


@query(
    "table_info",
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, {len(columns_of(n))} AS columns, '{s}' AS schema_text, "
        f"count(*) AS rows FROM {n}"
        for n, s in SCHEMAS.items()
    ),
)
def _(t):
    return cat.union_all(cat.table_info(df, name) for name, df in t.all().items())


@query(
    "table_info_sample",
    """SELECT 'nation' AS table_name, 3 AS columns,
              'n_nationkey:int,n_name:string,n_regionkey:int' AS schema_text, count(*) AS rows,
              (SELECT list(CAST(to_json({'n_nationkey': n_nationkey, 'n_name': n_name,
                                         'n_regionkey': n_regionkey}) AS VARCHAR) ORDER BY n_nationkey)
               FROM (SELECT * FROM nation ORDER BY n_nationkey LIMIT 5)) AS sample
       FROM nation""",
)
def _(t):
    return cat.table_info(t("nation"), "nation", ["n_nationkey"])


@query(
    "target_listing",
    "SELECT 'orders' AS table_name, count(*) AS rows FROM orders UNION ALL "
    "SELECT 'lineitem', count(*) FROM lineitem",
)
def _(t):
    """Catalog tables of a database, none where there is no such database."""
    spark = t.spark
    names = {n: f"mirrorspan_listed_{n}" for n in ("orders", "lineitem")}
    for n, view in names.items():
        t(n).createOrReplaceTempView(view)
    if cat.list_catalog_tables(spark, "no_such_database").count():
        raise RuntimeError("a database that isn't there has tables")
    listed = cat.list_catalog_tables(spark, spark.catalog.currentDatabase())
    rows = cat.table_list({n: spark.table(v) for n, v in names.items()}, "shop")
    there = listed.select(F.regexp_replace("table_name", "^mirrorspan_listed_", "").alias("table_name"))
    return rows.join(there, "table_name", "left_semi").select("table_name", "rows")


@query(
    "create_view",
    "SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY 1",
)
def _(t):
    t("customer").createOrReplaceTempView("mirrorspan_customers")
    return views.create_view(
        t.spark, "mirrorspan_segments",
        "SELECT c_mktsegment, count(*) AS customers FROM mirrorspan_customers "
        "WHERE c_acctbal > 0 GROUP BY 1",
    )


@query(
    "create_view_persistent",
    """SELECT c_mktsegment, o_orderpriority, count(*) AS orders FROM customer
       JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def _(t):
    """A view in the catalog, over catalog tables, as another session sees it."""
    run = uuid.uuid4().hex[:8]
    names = {n: f"mirrorspan_{n}_{run}" for n in ("customer", "orders")}
    for n, name in names.items():
        path = scratch_dir(t.spark, f"view-{n}")
        t(n).write.parquet(path)
        scan.create_external_table(t.spark, name, path, "parquet")
    view = f"mirrorspan_segments_{run}"
    views.create_view(
        t.spark, view,
        f"SELECT c_mktsegment, o_orderpriority, count(*) AS orders FROM {names['customer']} "
        f"JOIN {names['orders']} ON c_custkey = o_custkey GROUP BY 1, 2",
        persistent=True,
    )
    return t.spark.newSession().table(view)


@query(
    "clean_bad_utf8",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || chr(65533) || 'x' ELSE text END AS text
       FROM documents""",
)
def _(t):
    """Broken bytes at both ends and in the middle of whole texts are dropped; all else stays,
    a replacement character that the text itself has included."""
    half = F.floor(F.char_length("text") / 2).cast("int")
    parts = [F.substring("text", 1, half), F.substring("text", half + 1, F.char_length("text"))]
    first, rest = (F.encode(p, "utf-8") for p in parts)
    own = F.when(F.col("doc_id") % 3 == 0, F.lit("\ufffdx")).otherwise("")
    broken = F.concat(
        F.unhex(F.lit("FF")), first, F.unhex(F.lit("C3")), rest, F.encode(own, "utf-8"), F.unhex(F.lit("E282"))
    )
    docs = t("documents").select("doc_id", broken.cast("string").alias("text"))
    return clean.clean_text_columns(docs)


@query(
    "table_list",
    "\nUNION ALL ".join(
        f"SELECT 'shop' AS database_name, '{n}' AS table_name, count(*) AS rows FROM {n}" for n in TABLES
    ),
)
def _(t):
    return cat.table_list(t.all(), "shop")


@query("column_catalog", catalog_sql({n: columns_of(n) for n in TABLES}))
def _(t):
    return cat.column_catalog(t.all(), lengths=True).select(
        "table_name", "column_name", "ordinal_position", "full_type", "nullable",
        F.coalesce("max_length", F.lit(-1)).alias("max_length"), "table_rows", "non_null_rows",
    )


_FK_TABLES = ("customer", "supplier", "nation", "orders", "lineitem", "returns")


@query(
    "fk_catalog",
    "\nUNION ALL ".join(
        f"SELECT '{r.name}' AS constraint_name, '{r.kind}' AS kind, '{r.table}' AS table_name, "
        f"'{c}' AS column_name, {i} AS key_position, '{r.ref_table}' AS referenced_table, "
        f"'{rc}' AS referenced_column, count({c}) AS non_null_rows FROM {r.table}"
        for r in RELATIONSHIPS
        for i, (c, rc) in enumerate(zip(r.columns, r.ref_columns), start=1)
    ),
    needs=("returns",),
)
def _(t):
    fks = cat.fk_catalog(t.spark, RELATIONSHIPS)
    keys = {n: {c for r in RELATIONSHIPS if r.table == n for c in r.columns} for n in _FK_TABLES}
    values = cat.column_catalog({n: t(n) for n in _FK_TABLES}, columns=keys)
    return fks.join(
        values.select("table_name", "column_name", "non_null_rows"), ["table_name", "column_name"]
    )


BUSINESS = ("sales_header", "sales_line", "client", "product", "branch")
BUSINESS_COLUMNS = {
    "sales_header": [("IDOrder", "bigint"), ("IDClient", "bigint"), ("emitted", "timestamp_ntz")],
    "sales_line": [("IDOrder", "bigint"), ("IDProduct", "bigint"), ("IDBranch", "bigint"),
                   ("numero", "int"), ("quantity", "double")],
    "client": [("IDClient", "bigint"), ("name", "string"), ("nation_id", "int")],
    "product": [("IDProduct", "bigint"), ("name", "string"), ("numero", "int")],
    "branch": [("IDBranch", "bigint"), ("name", "string"), ("nation_id", "int")],
}
BUSINESS_KEYS = {"sales_header": ["IDOrder"], "client": ["IDClient"], "product": ["name", "IDProduct"]}


def business_keys(t):
    tables = {n: t(n) for n in ("sales_header", "sales_line", "product")}
    keys = {
        n: cat.columns_like(df, KEY_NAME_PATTERNS) + BUSINESS_KEYS.get(n, []) for n, df in tables.items()
    }
    catalog = cat.column_catalog(tables, columns=keys)
    return cat.key_columns(catalog, list(tables), BUSINESS_KEYS, KEY_NAME_PATTERNS)


@query(
    "key_columns",
    f"""WITH c AS ({catalog_sql(BUSINESS_COLUMNS)})
        SELECT table_name, column_name, full_type, nullable, non_null_rows,
               CASE WHEN (table_name, column_name) IN (('sales_header', 'IDOrder'), ('product', 'name'),
                         ('product', 'IDProduct')) THEN 'PRI' ELSE '' END AS column_key
        FROM c WHERE table_name IN ('sales_header', 'sales_line', 'product')
          AND (column_name LIKE '%ID%' OR column_name LIKE '%numero%' OR column_name LIKE '%comprobante%'
               OR (table_name = 'product' AND column_name = 'name'))""",
    needs=BUSINESS,
)
def _(t):
    return business_keys(t).select(
        "table_name", "column_name", "full_type", "nullable", "non_null_rows", "column_key"
    )


@query("external_csv_scan", "SELECT * FROM customer")
def _(t):
    path = scratch_dir(t.spark, "csv")
    customer = t("customer")
    customer.write.option("header", "true").csv(path)
    return scan.read_external(t.spark, path, "csv", customer.schema, header="true")


@query("project_columns", "SELECT doc_id, lang, n_chars FROM documents")
def _(t):
    return scan.project_columns(t("documents"), ["doc_id", "lang", "n_chars"])


@query(
    "required_columns",
    "\nUNION ALL ".join(
        f"SELECT 'src_orders_null' AS table_name, '{c}' AS column_name, '{k}' AS full_type, "
        f"count(*) AS non_null_rows FROM src_orders_null HAVING count({c}) = count(*)"
        for c, k in columns_of("orders")
    ),
    needs=("src_orders_null",),
)
def _(t):
    measured = cat.measured_columns(t("src_orders_null"), "src_orders_null")
    return cat.required_columns(measured).select("table_name", "column_name", "full_type", "non_null_rows")


@query("lookback_single", "SELECT * FROM orders WHERE o_orderdate >= DATE '2001-07-29'")
def _(t):
    return window_rows(t("orders"), ["o_orderdate"], N3)


@query(
    "lookback_multi",
    """SELECT * FROM lines_dates
       WHERE o_orderdate >= DATE '2001-07-02' OR l_shipdate >= DATE '2001-07-02'""",
    needs=("lines_dates",),
)
def _(t):
    return t("lines_dates").filter(in_window(["o_orderdate", "l_shipdate"], N30))


@query(
    "lookback_null_guard",
    """SELECT * FROM lines_dates_null
       WHERE (o_orderdate IS NOT NULL AND o_orderdate >= DATE '2001-07-02')
          OR (l_shipdate IS NOT NULL AND l_shipdate >= DATE '2001-07-02')""",
    needs=("lines_dates_null",),
)
def _(t):
    return t("lines_dates_null").filter(in_window_null_guarded(["o_orderdate", "l_shipdate"], N30))


@query("lookback_timestamp", "SELECT * FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-28'")
def _(t):
    return window_rows(t("events"), ["ts"], EVENTS_N3)


@query("recent_count", "SELECT count(*) AS rows FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-28'")
def _(t):
    return window_rows(t("events"), ["ts"], EVENTS_N3).agg(F.count(F.lit(1)).alias("rows"))


def _lines_of_window(t, ctx):
    keys = window_keys(t("orders"), ["o_orderkey"], ["o_orderdate"], ctx)
    return child_window_rows(t("lineitem"), keys, ["l_orderkey"])


@query(
    "child_window_semi",
    """SELECT * FROM lineitem WHERE l_orderkey IN
       (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '2001-07-29')""",
)
def _(t):
    return _lines_of_window(t, N3)


@query(
    "child_window_join",
    """SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       WHERE o.o_orderdate >= DATE '2001-07-02'""",
)
def _(t):
    return _lines_of_window(t, N30)


@query(
    "child_window_two_hop",
    """SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN client_dated c ON o.o_custkey = c.c_custkey WHERE c.c_since >= DATE '2001-07-02'""",
    needs=("client_dated",),
)
def _(t):
    clients = window_keys(t("client_dated"), ["c_custkey"], ["c_since"], N30)
    orders = keys_via(t("orders"), clients, ["o_custkey"], ["o_orderkey"])
    return rows_with_keys(t("lineitem"), orders, ["l_orderkey"])
