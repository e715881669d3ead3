"""Strategies and relationships from plain nested settings (parsed JSON or YAML)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from mirrorspan.model import DATE_INCREMENTAL, FULL_REFRESH, Relationship, Strategy
from mirrorspan.session import local_frame

CLUSTER_SCHEMA = "cluster string, parent_table string, child_table string, join_column string, relationship string"


def strategies_from_settings(
    tables: Mapping[str, Mapping],
    clusters: Mapping[str, Mapping] | None = None,
    priorities: Mapping[str, Sequence[str]] | None = None,
    critical_fields: Mapping[str, Sequence[str]] | None = None,
) -> list[Strategy]:
    """One strategy per configured table.

    ``tables``: name -> strategy, watermark_column(s), chunk_size, lookback_days,
    partition_unit, custom_query, delete_condition (its leading WHERE may stay).
    In their SQL ``{table}`` is a table (of the source in a query, of the copies in
    a condition), ``:cutoff`` the first day of the window and ``{lookback_days}``
    its length.
    ``clusters``: name -> parent_table, join_column, child_tables [{table,
    join_via, join_column}]; an incremental child takes its window from the
    cluster's parent, with ``join_via`` through that table.
    ``priorities``: class -> table names. ``critical_fields``: table -> columns
    that must always have a value.
    """
    parent_of = {
        child["table"]: (
            c["parent_table"], child.get("join_column", c["join_column"]), child.get("join_via")
        )
        for c in (clusters or {}).values()
        for child in c.get("child_tables", ())
    }
    rank = {t: cls for cls, names in (priorities or {}).items() for t in names}
    out = []
    for name, raw in tables.items():
        kind = raw.get("strategy", FULL_REFRESH)
        watermarks = raw.get("watermark_columns", raw.get("watermark_column")) or ()
        if isinstance(watermarks, str):
            watermarks = (watermarks,)
        none = (None, None, None)
        parent, column, via = parent_of.get(name, none) if kind != FULL_REFRESH else none
        columns = (column,) if isinstance(column, str) else tuple(column or ())
        condition = raw.get("delete_condition")
        if isinstance(condition, str):
            condition = re.sub(r"^\s*where\b", "", condition.strip().rstrip(";"), flags=re.I).strip()
        out.append(
            Strategy(
                name,
                FULL_REFRESH if kind == FULL_REFRESH else DATE_INCREMENTAL,
                tuple(watermarks),
                raw.get("chunk_size"),
                parent=parent,
                join_columns=columns,
                lookback_days=raw.get("lookback_days"),
                priority=rank.get(name, "low"),
                required=tuple((critical_fields or {}).get(name, ())),
                partition_unit=raw.get("partition_unit", "day"),
                custom_query=raw.get("custom_query"),
                delete_condition=condition,
                via=via,
            )
        )
    return out


def relationships_from_settings(foreign_keys: Sequence[Mapping]) -> list[Relationship]:
    """Foreign keys given as name, table, column(s), referenced_table, referenced_column(s)."""

    def columns(raw: Mapping, prefix: str) -> tuple[str, ...]:
        value = raw.get(f"{prefix}columns", raw.get(f"{prefix}column"))
        return (value,) if isinstance(value, str) else tuple(value)

    return [
        Relationship(
            fk["name"], fk["table"], columns(fk, ""), fk["referenced_table"], columns(fk, "referenced_")
        )
        for fk in foreign_keys
    ]


def clusters_frame(spark: SparkSession, clusters: Mapping[str, Mapping]) -> DataFrame:
    """The clusters flattened to one row per parent and child."""
    rows = [
        (name, c["parent_table"], child["table"], c["join_column"], child.get("relationship"))
        for name, c in clusters.items()
        for child in c.get("child_tables", ())
    ]
    return local_frame(spark, rows, CLUSTER_SCHEMA)


def chunk_sizes(strategies: Sequence[Strategy], override: int | None = None) -> dict[str, int | None]:
    """Rows of a page per table for the reader of a run; ``override`` holds for all."""
    return {s.table: override or s.chunk_rows for s in strategies}
