"""Which table is loaded how, in what order, and whether the settings make sense."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mirrorspan.functions.names import target_name
from mirrorspan.model import FULL_REFRESH, Relationship, Strategy
from mirrorspan.operators.joins import names_missing
from mirrorspan.session import local_frame
from mirrorspan.sources.scan import chunk_rows_column

# Run order of the priority classes.
PRIORITY_RANK = {"critical": 1, "high": 2, "medium": 3, "low": 4}

STRATEGY_SCHEMA = (
    "table_name string, strategy string, watermark_columns array<string>, chunk_rows bigint, "
    "parent string, priority string"
)


def strategies_frame(spark: SparkSession, strategies: Sequence[Strategy]) -> DataFrame:
    rows = [
        (s.table, s.kind, list(s.watermark_columns), s.chunk_rows, s.parent, s.priority)
        for s in strategies
    ]
    return local_frame(spark, rows, STRATEGY_SCHEMA)


def sync_plan(tables: DataFrame, strategies: DataFrame, force_full_refresh: bool = False) -> DataFrame:
    """One row per listed table: strategy, action, page size and pages.

    ``tables`` has database_name, table_name and rows. A table without
    settings is fully refreshed; so is an incremental one that has no
    watermark at all (appending a full scan would duplicate it).
    """
    joined = tables.join(strategies, "table_name", "left")
    configured = F.coalesce("strategy", F.lit(FULL_REFRESH))
    windowed = (configured != FULL_REFRESH) & (F.size(F.coalesce("watermark_columns", F.array())) > 0)
    if force_full_refresh:
        windowed = F.lit(False)
    rank = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(x) for kv in PRIORITY_RANK.items() for x in kv]), F.col("priority")
        ),
        F.lit(len(PRIORITY_RANK) + 1),
    )
    chunk = F.coalesce("chunk_rows", chunk_rows_column(F.col("rows")).cast("bigint"))
    return joined.select(
        "database_name",
        "table_name",
        target_name(F.col("database_name"), F.col("table_name")).alias("target_table"),
        configured.alias("strategy"),
        F.when(windowed, "window_replace").otherwise("overwrite").alias("action"),
        F.array_join(F.coalesce("watermark_columns", F.array().cast("array<string>")), ",").alias("watermarks"),
        chunk.alias("chunk_rows"),
        F.ceil(F.col("rows") / chunk).cast("bigint").alias("pages"),
        "rows",
        rank.cast("bigint").alias("priority_rank"),
    )


def in_run_order(plan: DataFrame) -> DataFrame:
    return plan.orderBy("priority_rank", "table_name")


def missing_tables(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source tables whose copy does not exist.

    ``source`` has database_name and table_name, ``target`` has table_name.
    """
    named = source.withColumn("target_table", target_name(F.col("database_name"), F.col("table_name")))
    return names_missing(named, target.select(F.col("table_name").alias("target_table")), "target_table")


def watermark_columns(strategies: Sequence[Strategy]) -> dict[str, set[str]]:
    """Columns that :func:`config_lint` needs to know, by the table that owns them."""
    out: dict[str, set[str]] = {}
    for s in strategies:
        if s.incremental and s.watermark_columns:
            out.setdefault(s.parent or s.table, set()).update(s.watermark_columns)
    return out


def config_lint(strategies: DataFrame, catalog: DataFrame) -> DataFrame:
    """Settings that cannot work as written.

    A watermark column must exist in the table, or in its parent when there is
    one, and hold at least one value; an incremental table needs a watermark.
    """
    owner = F.coalesce("parent", F.col("table_name"))
    wanted = strategies.filter(F.col("strategy") != FULL_REFRESH)
    columns = wanted.select(
        "table_name", owner.alias("owner"), F.explode("watermark_columns").alias("watermark_column")
    )
    known = catalog.select(
        F.col("table_name").alias("owner"),
        F.lower("column_name").alias("wm"),
        F.col("non_null_rows").alias("values"),
    )
    checked = (
        columns.withColumn("wm", F.lower("watermark_column"))
        .join(known, ["owner", "wm"], "left")
        .withColumn(
            "problem",
            F.when(F.col("values").isNull(), "unknown_column").when(F.col("values") == 0, "empty_column"),
        )
        .filter(F.col("problem").isNotNull())
        .select("table_name", "owner", "watermark_column", "problem")
    )
    none = wanted.filter(F.size("watermark_columns") == 0).select(
        "table_name",
        owner.alias("owner"),
        F.lit(None).cast("string").alias("watermark_column"),
        F.lit("no_watermark").alias("problem"),
    )
    return checked.unionByName(none)


def dependency_levels(
    tables: Sequence[str],
    strategies: Mapping[str, Strategy],
    relationships: Sequence[Relationship] = (),
) -> list[list[str]]:
    """Tables grouped so that parents come in an earlier group than children.

    A self-reference does not count. Within a group: priority, then name.
    """
    parents: dict[str, set[str]] = {t: set() for t in tables}
    for t in tables:
        s = strategies.get(t)
        if s:
            parents[t] |= {p for p in (s.parent, s.via) if p in parents and p != t}
    for r in relationships:
        if r.table in parents and r.ref_table in parents and r.table != r.ref_table:
            parents[r.table].add(r.ref_table)
    levels, placed = [], set()
    while len(placed) < len(parents):
        ready = [t for t in parents if t not in placed and parents[t] <= placed]
        if not ready:
            raise ValueError(f"tables depend on each other: {sorted(set(parents) - placed)}")
        levels.append(sorted(ready, key=lambda t: (_rank(strategies.get(t)), t)))
        placed |= set(ready)
    return levels


def _rank(strategy: Strategy | None) -> int:
    return PRIORITY_RANK.get(strategy.priority, 5) if strategy else 5


def default_strategy(table: str) -> Strategy:
    return Strategy(table, FULL_REFRESH)
