"""Plain descriptions of tables, strategies, relationships and runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

FULL_REFRESH = "full_refresh"
DATE_INCREMENTAL = "date_incremental"

# Runtime defaults.
DEFAULT_LOOKBACK_DAYS = 3
DEFAULT_CHUNK_ROWS = 100_000

# Rows that a partition must hold on average to be worth a folder of its own.
AUTO_PARTITION_ROWS = 100_000


@dataclass(frozen=True)
class TableRef:
    """A table of a source database."""

    database: str
    name: str

    @property
    def target_name(self) -> str:
        return f"{self.database}_{self.name}"

    @classmethod
    def parse(cls, spec: str) -> TableRef:
        database, dot, name = spec.partition(".")
        if not dot:
            raise ValueError(f"expected 'database.table', got {spec!r}")
        return cls(database, name)


@dataclass(frozen=True)
class Relationship:
    """A declared foreign key; more than one column makes it composite."""

    name: str
    table: str
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]

    @property
    def kind(self) -> str:
        return "single_column" if len(self.columns) == 1 else "composite"


@dataclass(frozen=True)
class RunContext:
    """The clock and window of one run. Both sides use the same ``as_of``."""

    as_of: dt.date
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    force_full_refresh: bool = False

    def __post_init__(self):
        if self.lookback_days < 0:
            raise ValueError("lookback_days must not be negative")

    @property
    def cutoff(self) -> dt.date:
        """First day inside the window."""
        day = self.as_of.date() if isinstance(self.as_of, dt.datetime) else self.as_of
        return day - dt.timedelta(days=self.lookback_days)


SourceReader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Strategy:
    """How one table is kept up to date.

    A table with ``parent`` takes its window from the parent's watermark
    columns through ``join_columns`` (child column names; the parent uses
    ``parent_columns`` or the same names). ``cluster_by`` sorts the files, so
    that row-group statistics can skip by those columns; children are sorted
    by their join columns unless told otherwise. ``type_policy`` overrides the
    run's rule for columns whose type changed at the source. A NULL in a
    ``required`` column fails the load (files would not enforce it).

    ``curve_columns`` sort the files along a Z-order curve instead, so that row groups can be
    skipped by any of them.

    ``index_columns`` are the key columns of the copy's skipping index; by default those
    by which its runs delete.

    With ``via`` the table refers to another child of ``parent`` instead of the
    parent itself: ``join_columns`` then are columns of that table.

    ``partition_unit`` is the unit of the copy's partitions: day, month, year, None
    for none, or "auto": the finest one whose partitions hold ``AUTO_PARTITION_ROWS``
    rows on average when the copy is made. A run keeps the unit its copy has.

    ``custom_query`` (SQL text with ``{table}`` and ``:cutoff``, or a callable of reader and
    context) and ``delete_condition`` (SQL predicate with ``:cutoff``, or a
    callable returning a Column) replace the built-in window.
    """

    table: str
    kind: str = FULL_REFRESH
    watermark_columns: tuple[str, ...] = ()
    chunk_rows: int | None = DEFAULT_CHUNK_ROWS
    parent: str | None = None
    join_columns: tuple[str, ...] = ()
    parent_columns: tuple[str, ...] = ()
    lookback_days: int | None = None
    priority: str = "low"
    partition_unit: str | None = "auto"
    custom_query: str | Callable[[SourceReader, RunContext], DataFrame] | None = None
    delete_condition: str | Callable[[RunContext], Column] | None = None
    unique_key: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    type_policy: str | None = None
    required: tuple[str, ...] = ()
    via: str | None = None
    index_columns: tuple[str, ...] = ()
    curve_columns: tuple[str, ...] = ()

    @property
    def clustering(self) -> tuple[str, ...]:
        return self.cluster_by or (self.join_columns if self.incremental else ())

    @property
    def incremental(self) -> bool:
        return self.kind != FULL_REFRESH

    @property
    def parent_keys(self) -> tuple[str, ...]:
        return self.parent_columns or self.join_columns
