"""Table naming as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def target_name(database: Column, table: Column) -> Column:
    """Name of the copy: ``database_table``."""
    return F.concat(database, F.lit("_"), table)


def split_table_spec(spec: Column) -> tuple[Column, Column]:
    """(database, table) of ``database.table``, cut at the first dot.

    Both are NULL when there is no dot.
    """
    parts = F.split(spec, r"\.", 2)
    ok = F.size(parts) == 2
    return F.when(ok, parts[0]), F.when(ok, parts[1])


def require_table_spec(spec: Column) -> Column:
    """``spec`` itself; the job fails where it has no dot."""
    message = F.concat(F.lit("expected database.table: "), spec)
    return F.when(spec.contains("."), spec).otherwise(F.raise_error(message).cast("string"))
