"""Chains of foreign keys of any length: reachable tables, cycles, and keys carried along.

The closure is a recursive common table expression over the key catalog: one row for
each chain of constraints that meets no table twice, and one for each chain that comes
back to its first table, so a cycle is an answer instead of an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from mirrorspan.model import Relationship, SourceReader
from mirrorspan.operators.joins import KeySet, keys_via, rows_with_keys

# Shared by Spark and DuckDB; ``{edges}`` has from_table, constraint_name, to_table.
CLOSURE_SQL = """
    WITH RECURSIVE chains(from_table, to_table, hops, path, tables, is_cycle) AS (
        SELECT from_table, to_table, 1, constraint_name,
               concat('/', from_table, '/', to_table, '/'), from_table = to_table
        FROM {edges}
        UNION ALL
        SELECT c.from_table, e.to_table, c.hops + 1, concat(c.path, ' > ', e.constraint_name),
               concat(c.tables, e.to_table, '/'), e.to_table = c.from_table
        FROM chains c JOIN {edges} e ON e.from_table = c.to_table
        WHERE NOT c.is_cycle
          AND (e.to_table = c.from_table OR c.tables NOT LIKE concat('%/', e.to_table, '/%'))
    )
    SELECT from_table, to_table, hops, path, is_cycle FROM chains"""


def edges(fks: DataFrame) -> DataFrame:
    """(from_table, constraint_name, to_table) of a foreign-key catalog: a row a constraint."""
    return fks.filter("key_position = 1").selectExpr(
        "table_name AS from_table", "constraint_name", "referenced_table AS to_table"
    )


def closure(fks: DataFrame) -> DataFrame:
    """Every chain of references: from_table, to_table, hops, path, is_cycle."""
    return fks.sparkSession.sql(CLOSURE_SQL, edges=edges(fks))


def reachable(fks: DataFrame) -> DataFrame:
    """Fewest hops and number of chains for each pair of tables, cycles included."""
    return closure(fks).groupBy("from_table", "to_table").agg(
        {"hops": "min", "path": "count"}
    ).withColumnsRenamed({"min(hops)": "fewest_hops", "count(path)": "chains"})


def keys_along(read: SourceReader, start: KeySet, path: Sequence[Relationship]) -> list[KeySet]:
    """Keys that belong to ``start``, table by table down the path; the last table has none.

    ``path`` leads from the table of ``start`` to its children, their children and so on;
    each relationship refers to the table before. Every hop is a semi-join of the child by
    measured keys and gives the keys that the next hop refers to.
    """
    found = [start]
    for hop, after in zip(path, path[1:]):
        if after.ref_table != hop.table:
            raise ValueError(f"{after.name} does not refer to {hop.table}")
        found.append(keys_via(read(hop.table), found[-1], list(hop.columns), list(after.ref_columns)))
    return found


def rows_along(read: SourceReader, start: KeySet, path: Sequence[Relationship]) -> DataFrame:
    """Rows of the last table of the path that belong to ``start`` over all hops."""
    last, table = path[-1], read(path[-1].table)
    found = rows_with_keys(table, keys_along(read, start, path)[-1], list(last.columns))
    return found.select(*(f"`{c}`" for c in table.columns))
