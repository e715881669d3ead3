"""Inputs derived from the driver's tables, in SQL that Spark and DuckDB share.

The tables hold no stale copies, NULL dates, orphans or dirty texts; these
statements make them, over whole tables, by rules on the keys. ``{name}``
stands for a table or another derived input; ``{as_of_midnight}`` for a
zone-less timestamp, which the two engines spell differently.
"""

AS_OF_MIDNIGHT = {
    "spark": "TIMESTAMP_NTZ '2001-08-01 00:00:00'",
    "duckdb": "TIMESTAMP '2001-08-01 00:00:00'",
}

_O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_L = (
    "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
# Added to a key to make one that the source does not have, at any scale.
GHOST = 1_000_000_000_000_000

# Source types by remainder, with the Spark type each maps to.
SOURCE_TYPES = {
    "tinyint(4)": "bigint", "smallint(6)": "bigint", "mediumint(9)": "bigint", "int(11)": "bigint",
    "INTEGER": "bigint", "bigint(20)": "bigint", "year(4)": "bigint", "tinyint(1)": "boolean",
    "tinyint(1) unsigned": "boolean", "int(10) unsigned": "bigint", "int unsigned": "bigint",
    "bigint(20) unsigned": "bigint", "float": "double", "double": "double", "double(10,2)": "double",
    "decimal": "decimal(38,9)", "decimal(15,4)": "decimal(15,4)", "numeric(10)": "decimal(10,0)",
    "decimal(65,30)": "decimal(38,9)", "char(1)": "string", " VARCHAR(50) ": "string", "text": "string",
    "mediumtext": "string", "longtext": "string", "enum(a,b)": "string", "set(a,b)": "string",
    "json": "string", "date": "date", "datetime": "timestamp_ntz", "timestamp": "timestamp",
    "time": "string", "binary(16)": "binary", "varbinary(20)": "binary", "blob": "binary",
    "longblob": "binary", "bit(8)": "boolean", "bool": "boolean", "geometry": "string",
}
_TYPE_CASES = " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(SOURCE_TYPES)
)

DERIVED = {
    # A copy of orders that missed rows, kept old values and rows deleted at the source.
    "tgt_orders": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {{orders}} WHERE o_orderkey % 7 <> 0
        UNION ALL
        SELECT o_orderkey + {GHOST}, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM {{orders}} WHERE o_orderkey % 11 = 0""",
    # ... whose dates moved: some 60 days back, some into the window.
    "tgt_orders_moved": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate - INTERVAL 60 DAY
                    WHEN o_orderkey % 17 = 0
                    THEN {as_of_midnight}
                    ELSE o_orderdate END AS o_orderdate, o_orderpriority
        FROM {tgt_orders}""",
    "src_orders_null": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority
        FROM {orders}""",
    "tgt_lines": f"""
        SELECT l_orderkey, {_L} FROM {{lineitem}} WHERE l_orderkey % 7 <> 0
        UNION ALL
        SELECT l_orderkey + {GHOST}, {_L} FROM {{lineitem}} WHERE l_orderkey % 11 = 0""",
    "lines_orphan": f"""
        SELECT l_orderkey,
               CASE WHEN l_orderkey % 23 = 0 THEN l_partkey + {GHOST} ELSE l_partkey END AS l_partkey,
               {_L.split(', ', 1)[1]}
        FROM {{lineitem}}""",
    # Line items with two optional dates of their own.
    "lines_dates": """
        SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
               o.o_orderdate, l.l_shipdate
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "lines_dates_null": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
               CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
               CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_shipdate END AS l_shipdate
        FROM {lines_dates}""",
    "client_dated": """
        SELECT c_custkey, c_name, DATE '2001-08-01' - CAST(c_custkey % 1000 AS INT) AS c_since
        FROM {customer}""",
    "returns": """
        SELECT DISTINCT l_orderkey AS r_orderkey, l_partkey AS r_partkey
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "docs_dirty": """
        SELECT doc_id, lang,
               CASE WHEN doc_id % 50 = 49 THEN chr(0)
                    WHEN doc_id % 8 = 0 THEN 'nan' WHEN doc_id % 8 = 1 THEN 'None'
                    WHEN doc_id % 8 = 2 THEN 'null' WHEN doc_id % 8 = 3 THEN 'NULL'
                    WHEN doc_id % 8 = 4 THEN '' WHEN doc_id % 8 = 5 THEN concat(chr(0), text, chr(0))
                    WHEN doc_id % 16 = 6 THEN 'Null' WHEN doc_id % 16 = 7 THEN ' '
                    ELSE text END AS text
        FROM {documents}""",
    "ev_text": """
        SELECT CAST(event_id AS VARCHAR(40)) AS event_id, CAST(ts AS VARCHAR(40)) AS ts,
               CAST(user_id AS VARCHAR(40)) AS user_id, event_type,
               CAST(value AS VARCHAR(40)) AS value, props
        FROM {events}""",
    "ev_text_bad": """
        SELECT event_id, CASE WHEN user_id = '7' THEN '2024-13-01' ELSE ts END AS ts,
               user_id, event_type,
               CASE WHEN event_id LIKE '%0' THEN 'x' ELSE value END AS value, props
        FROM {ev_text}""",
    "part_b": f"""
        SELECT p_partkey + {GHOST} AS p_partkey, p_name, p_brand, p_type, p_retailprice, 'b' AS b_source
        FROM {{part}}""",
    # Two states of one table: modes, types and columns differ.
    "part_v1": """
        SELECT p_partkey, p_name, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS p_brand,
               CAST(p_size AS BIGINT) AS p_size, p_retailprice, 'v1' AS p_origin
        FROM {part}""",
    "part_v2": """
        SELECT p_partkey, CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_name END AS p_name,
               p_brand, p_type, p_size, p_retailprice
        FROM {part}""",
    "typed_lines": f"""
        SELECT l_orderkey, CASE l_orderkey % {len(SOURCE_TYPES)} {_TYPE_CASES} END AS source_type
        FROM {{lineitem}}""",
    "table_specs": """
        SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN source
                            ELSE concat(source, '.', lang, CASE WHEN doc_id % 3 = 0 THEN '.x' ELSE '' END)
                       END AS spec
        FROM {documents}""",
    # The same business tables under names that share key columns.
    "sales_header": 'SELECT o_orderkey AS IDOrder, o_custkey AS IDClient, o_orderdate AS emitted FROM {orders}',
    "sales_line": (
        "SELECT l_orderkey AS IDOrder, l_partkey AS IDProduct, l_suppkey AS IDBranch, "
        "l_linenumber AS numero, l_quantity AS quantity FROM {lineitem}"
    ),
    "client": "SELECT c_custkey AS IDClient, c_name AS name, c_nationkey AS nation_id FROM {customer}",
    "product": "SELECT p_partkey AS IDProduct, p_name AS name, p_size AS numero FROM {part}",
    "branch": "SELECT s_suppkey AS IDBranch, s_name AS name, s_nationkey AS nation_id FROM {supplier}",
    # Two runs: the second lost half of orders and failed on part.
    "ledger_first": """
        SELECT 'run1' AS run_id, 'shop_orders' AS table_name, count(*) AS rows, 'SUCCESS' AS status FROM {orders}
        UNION ALL SELECT 'run1', 'shop_lineitem', count(*), 'SUCCESS' FROM {lineitem}
        UNION ALL SELECT 'run1', 'shop_customer', count(*), 'SUCCESS' FROM {customer}
        UNION ALL SELECT 'run1', 'shop_part', count(*), 'SUCCESS' FROM {part}
        UNION ALL SELECT 'run1', 'shop_supplier', count(*), 'SUCCESS' FROM {supplier}""",
    "ledger_second": """
        SELECT 'run2' AS run_id, 'shop_orders' AS table_name, count(*) AS rows, 'SUCCESS' AS status
        FROM {orders} WHERE o_orderkey % 5 < 2
        UNION ALL SELECT 'run2', 'shop_lineitem', count(*), 'SUCCESS' FROM {lineitem}
        UNION ALL SELECT 'run2', 'shop_customer', count(*), 'SUCCESS' FROM {customer} WHERE c_custkey % 10 > 0
        UNION ALL SELECT 'run2', 'shop_part', count(*), 'FAILED' FROM {part} WHERE p_partkey < 0
        UNION ALL SELECT 'run2', 'shop_supplier', count(*), 'SUCCESS' FROM {supplier}""",
}
