"""Running a plan: one Spark write per table, then one ledger row.

Every load is staged, counted and switched in by the store. A table that
fails keeps its old version, is recorded as FAILED with the reason and does not
stop the others, but for its children, which are recorded as SKIPPED. A table
without a copy is loaded in full, whatever its strategy.

Incremental tables are partitioned by the day (or month, year) of their
window: a table with watermarks of its own by the latest of them, a child by
its parent's. A window replace then drops, rewrites and adds partitions; the
rest of the table is neither read nor written.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mirrorspan.functions.clean import clean_text_columns, duration_to_time
from mirrorspan.functions.dates import window_day
from mirrorspan.functions.types import all_nullable, base_type, cast_to_schema, target_schema
from mirrorspan.model import (
    AUTO_PARTITION_ROWS,
    Relationship,
    RunContext,
    SourceReader,
    Strategy,
    TableRef,
)
from mirrorspan.operators.evolve import USE_EXISTING, reconcile
from mirrorspan.operators.layout import curve_key
from mirrorspan.operators.joins import KeySet, key_set, rows_with_keys, rows_without_keys
from mirrorspan.operators.quality import LEDGER_SCHEMA
from mirrorspan.operators.window import keys_before_and_after, survivors, window_keys, window_rows
from mirrorspan.plans.ledger import record_run
from mirrorspan.plans.sync_plan import (
    default_strategy,
    dependency_levels,
    in_run_order,
    strategies_frame,
    sync_plan,
)
from mirrorspan.session import local_frame
from mirrorspan.sources.catalog import table_list, union_all
from mirrorspan.sources.scan import JdbcReader, scan_query
from mirrorspan.sources.store import NULL_PARTITION, TableStore

log = logging.getLogger(__name__)

# Name of the partition folders; no table may have a column of this name.
PARTITION = "mirrorspan_part"
RUN_SCHEMA = (
    f"{LEDGER_SCHEMA}, error string, started_at timestamp_ntz, finished_at timestamp_ntz"
)
# Partition unit -> Spark and Python format of its value.
PARTITION_FORMATS = {
    "day": ("yyyy-MM-dd", "%Y-%m-%d"),
    "month": ("yyyy-MM", "%Y-%m"),
    "year": ("yyyy", "%Y"),
}


class Replicator:
    """Copies the tables of one source database into a store."""

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        read: SourceReader,
        list_tables: Sequence[str],
        store: TableStore,
        strategies: Iterable[Strategy] = (),
        relationships: Sequence[Relationship] = (),
        source_types: Mapping[str, Sequence[tuple[str, str]]] | None = None,
        clean: bool = True,
        type_policy: str = USE_EXISTING,
        parallel_tables: int = 1,
        delete_orphans: bool = False,
        batch: dict[str, int] | None = None,
        record: bool = False,
        keep_versions: int | None = None,
    ):
        self.spark = spark
        self.database = database
        self.read = read
        self.source_tables = list(list_tables)
        self.store = store
        self.strategies = {s.table: s for s in strategies}
        self.relationships = list(relationships)
        self.source_types = dict(source_types or {})
        self.clean = clean
        self.type_policy = type_policy
        self.parallel_tables = parallel_tables
        self.delete_orphans = delete_orphans  # children of parents the run removed go too
        self.versions: dict[str, int] = {}  # of the copies before the run
        self.batch = batch  # stream -> micro-batch that the source rows come from
        self.record = record  # append each run to the store's run ledger
        self.keep_versions = keep_versions  # older ones are deleted after a run

    # -- whole runs -------------------------------------------------------

    def run(self, ctx: RunContext, tables: Sequence[str] | None = None) -> DataFrame:
        """Refresh all (or the given) tables, parents first; returns the ledger."""
        wanted = list(tables) if tables is not None else self.source_tables
        run_id = uuid.uuid4().hex
        copies = [self.target(t) for t in wanted]
        self.versions = {c: self.store.snapshot(c).version for c in copies if self.store.exists(c)}
        rows = []
        without: set[str] = set()  # tables that have not been refreshed
        for level in dependency_levels(wanted, self.strategies, self.relationships):
            rows += self._run_level(level, ctx, run_id, without)
        ledger = local_frame(self.spark, rows, RUN_SCHEMA)
        if self.record:
            record_run(self.store, ledger)
        if self.keep_versions is not None:
            for copy in copies:
                if self.store.exists(copy):
                    self.store.drop_old_versions(copy, self.keep_versions)
        return ledger

    def run_missing(self, ctx: RunContext) -> DataFrame:
        """Load the tables that have no copy yet."""
        present = set(self.store.tables())
        missing = [t for t in self.source_tables if self.target(t) not in present]
        return self.run(RunContext(ctx.as_of, ctx.lookback_days, True), missing)

    def plan(self, ctx: RunContext) -> DataFrame:
        """What :meth:`run` would do, without doing it."""
        tables = table_list({t: self.read(t) for t in self.source_tables}, self.database)
        strategies = strategies_frame(self.spark, list(self.strategies.values()))
        return in_run_order(sync_plan(tables, strategies, ctx.force_full_refresh))

    def reprocess(self, ctx: RunContext, tables: Sequence[str], min_rows: int) -> DataFrame:
        """Load the given tables in full and flag those at or below ``min_rows``."""
        ledger = self.run(RunContext(ctx.as_of, ctx.lookback_days, True), tables)
        low = (F.col("status") == "SUCCESS") & (F.col("rows") <= min_rows)
        return ledger.withColumn("status", F.when(low, "BELOW_THRESHOLD").otherwise(F.col("status")))

    def _run_level(
        self, level: Sequence[str], ctx: RunContext, run_id: str, without: set[str]
    ) -> list[tuple]:
        def one(table: str) -> tuple:
            start = dt.datetime.now()
            s = self.strategies.get(table, default_strategy(table))
            lacking = [t for t in (s.parent, s.via) if t in without]
            rows, status, error = 0, "SUCCESS", None
            if lacking:
                status, error = "SKIPPED", f"{lacking[0]} was not refreshed"
            else:
                try:
                    rows = self.run_table(table, ctx)
                except Exception as exc:  # recorded; the other tables go on
                    log.warning("%s failed: %s: %s", self.target(table), type(exc).__name__, exc)
                    status, error = "FAILED", f"{type(exc).__name__}: {exc}"
            if status != "SUCCESS":
                without.add(table)
            return run_id, self.target(table), rows, status, error, start, dt.datetime.now()

        if self.parallel_tables <= 1 or len(level) == 1:
            return [one(t) for t in level]
        with ThreadPoolExecutor(self.parallel_tables) as pool:
            return list(pool.map(one, level))

    # -- one table --------------------------------------------------------

    def target(self, table: str) -> str:
        return TableRef(self.database, table).target_name

    def run_spec(self, spec: str, ctx: RunContext) -> int:
        """Refresh ``database.table``."""
        ref = TableRef.parse(spec)
        if ref.database != self.database:
            raise ValueError(f"{spec}: this replicator copies {self.database}")
        return self.run_table(ref.name, ctx)

    def load(self, table: str, mode: str = "overwrite") -> int:
        """Load the whole source table, whatever its strategy says."""
        s = self.strategies.get(table, default_strategy(table))
        if mode == "overwrite":
            return self._full_refresh(s)
        return self._append(s, self._source(table))

    def append_window(self, table: str, ctx: RunContext) -> int:
        """Add the window's rows without deleting any: later parts of a window
        whose first part :meth:`run_table` has put in place."""
        s = self.strategies[table]
        if s.parent or not s.watermark_columns:
            raise ValueError(f"{table} has no window of its own")
        return self._append(s, window_rows(self._source(table), s.watermark_columns, ctx))

    def run_table(self, table: str, ctx: RunContext) -> int:
        """Refresh one table by its strategy; returns the rows loaded."""
        s = self.strategies.get(table, default_strategy(table))
        if ctx.force_full_refresh or not s.incremental:
            return self._full_refresh(s)
        if not self.store.exists(self.target(table)):
            return self._full_refresh(s)  # a window alone would pass for the whole table
        ctx = self._window_of(s, ctx)
        if not s.watermark_columns and s.custom_query is None:
            # Without a window nothing would be deleted: appending the whole
            # table again would only duplicate it.
            return self._full_refresh(s)
        s = self._as_stored(s)
        if s.custom_query is not None:
            return self._custom(s, ctx)
        return self._child(s, ctx) if s.parent else self._own_window(s, ctx)

    def _window_of(self, s: Strategy, ctx: RunContext) -> RunContext:
        """The run's window, or the table's (or its parent's) own if that is wider."""
        parent = self.strategies.get(s.parent) if s.parent else None
        days = [x.lookback_days for x in (s, parent) if x is not None and x.lookback_days is not None]
        return replace(ctx, lookback_days=max([ctx.lookback_days, *days]))

    def _full_refresh(self, s: Strategy) -> int:
        incoming = self._source(s.table)
        s = self._measured(s)
        df, partition = self._for_append(s, incoming, fresh=True)
        return self.store.overwrite(
            self.target(s.table), df, partition, self._order(s, df), batch=self.batch,
            spec=self._spec(s) if partition else None,
            index=self._indexed(s) if partition else (),
        )

    @staticmethod
    def _spec(s: Strategy) -> dict | None:
        """How the partitions of a copy are made; None if it has none."""
        if not (s.incremental and s.watermark_columns and s.partition_unit):
            return None
        return {
            "unit": s.partition_unit,
            "columns": list(s.watermark_columns),
            "parent": s.parent,
            "join": list(s.join_columns),
            "via": s.via,
        }

    def _as_stored(self, s: Strategy) -> Strategy:
        """``s`` with the partitions that its copy has.

        A run doesn't write a copy anew because another unit is wanted by now
        (:meth:`repartition` does); only partitions that are made of other columns, which
        say nothing about this window, force it.
        """
        spec = self.store.snapshot(self.target(s.table)).spec
        if spec is None:
            return replace(s, partition_unit=None)
        stored = replace(s, partition_unit=spec["unit"])
        if self._spec(stored) != spec:
            log.warning("%s is partitioned by other columns and written anew", self.target(s.table))
            self.repartition(s.table)
            return self._measured(s)
        return stored

    def repartition(self, table: str) -> None:
        """Writes a copy anew with the partitions that the strategy asks for."""
        s = self._measured(self.strategies[table])
        name = self.target(table)
        spec = self._spec(s)
        if self.store.snapshot(name).spec == spec:
            return
        df = self.store.read(name)
        if spec is not None:
            df = self._with_part(s, df)
        self.store.overwrite(
            name, df, PARTITION if spec else None, self._order(s, df), spec=spec,
            index=self._indexed(s) if spec else (),
        )

    def _measured(self, s: Strategy) -> Strategy:
        """``s`` with a definite unit: the finest whose partitions are large enough.

        One pass over the watermarks of the table (or of its parent, whose days a child
        shares) counts the days, months and years that there are.
        """
        if s.partition_unit != "auto":
            return s
        if not (s.incremental and s.watermark_columns):
            return replace(s, partition_unit=None)
        dated = self.read(s.parent or s.table)
        day = window_day(s.watermark_columns)
        row = dated.agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.count_distinct(F.date_format(day, f)).alias(u) for u, (f, _) in PARTITION_FORMATS.items()),
        ).first()
        rows = self.read(s.table).count() if s.parent else row["rows"]
        fits = (u for u in PARTITION_FORMATS if rows >= AUTO_PARTITION_ROWS * max(1, row[u]))
        return replace(s, partition_unit=next(fits, None))

    @staticmethod
    def _order(s: Strategy, df: DataFrame) -> tuple[str | Column, ...]:
        """What the rows of files are sorted by."""
        return (curve_key(df, s.curve_columns),) if s.curve_columns else s.clustering

    @staticmethod
    def _indexed(s: Strategy) -> tuple[str, ...]:
        """Key columns by which runs look for the partitions to write anew."""
        return s.index_columns or (tuple(s.join_columns) if s.parent else tuple(s.unique_key))

    def _append(self, s: Strategy, incoming: DataFrame) -> int:
        name = self.target(s.table)
        s = self._as_stored(s) if self.store.exists(name) else self._measured(s)
        df, partition = self._for_append(s, incoming)
        if self.store.exists(name) and self._retyped(name, df):
            return self._store_replace(s, [self._stored(name, df), df])
        return self._store_append(s, df, partition)

    def _store_append(self, s: Strategy, df: DataFrame, partition: str | None) -> int:
        return self.store.append(
            self.target(s.table), df, partition, batch=self.batch, cluster_by=self._order(s, df),
            spec=self._spec(s) if partition else None,
            index=self._indexed(s) if partition else (),
        )

    def _store_replace(self, s: Strategy, frames: list[DataFrame], parts: set[str] | None = None) -> int:
        """Rows of the last frame, after all of them became one version."""
        chosen = None if parts is None else parts.__contains__
        return self.store.replace(
            self.target(s.table), frames, chosen, batch=self.batch,
            cluster_by=self._order(s, frames[-1]),
        )[-1]

    def _own_window(self, s: Strategy, ctx: RunContext) -> int:
        name = self.target(s.table)
        incoming = self._prepared(s.table, self._read_window(s.table, s.watermark_columns, ctx))
        partitioned = bool(self.store.snapshot(name).partition_by)
        loaded = self._agreed(s, self._with_part(s, incoming) if partitioned else incoming)
        moved = key_set(incoming, s.unique_key) if s.unique_key else None
        if not partitioned or self._retyped(name, loaded):
            kept = self._kept(s, self._stored(name, loaded), ctx, moved)
            return self._store_replace(s, [kept, loaded])
        first = self._first_part(s, ctx)
        stored = self.store.snapshot(name).partitions
        replaced = {p for p in stored if p != NULL_PARTITION and p >= first}
        # Only the partition of the cutoff can mix rows of both sides.
        mixed = {first} & replaced if s.partition_unit != "day" else set()
        if moved is not None:
            mixed |= self._parts_with_keys(name, moved, s.unique_key)
        kept = [self._kept(s, self._stored(name, loaded, mixed), ctx, moved)] if mixed else []
        return self._store_replace(s, [*kept, loaded], replaced | mixed)

    def _kept(self, s: Strategy, df: DataFrame, ctx: RunContext, moved: KeySet | None) -> DataFrame:
        kept = survivors(df, s.watermark_columns, ctx)
        return kept if moved is None else rows_without_keys(kept, moved, s.unique_key)

    def _child(self, s: Strategy, ctx: RunContext) -> int:
        name, parent = self.target(s.table), self.strategies.get(s.parent, default_strategy(s.parent))
        parents = self._read_window(s.parent, s.watermark_columns, ctx)
        days = key_set(self._days(s, parents), [*s.parent_keys, PARTITION])
        child = days.within_range(self._source(s.table), s.join_columns[0])
        incoming = child.join(days.frame([*s.join_columns, PARTITION]), list(s.join_columns))
        incoming = incoming.select(*child.columns, PARTITION)
        partitioned = bool(self.store.snapshot(name).partition_by)
        if not partitioned:
            incoming = incoming.drop(PARTITION)
        # What is inserted is deleted before, also if the parent's copy lags behind.
        inserted = KeySet(days.df.select(*s.parent_keys), tuple(s.parent_keys)).measured()
        stored_keys = self._deleted_keys(s, parent, ctx)
        deleted = inserted if stored_keys is None else keys_before_and_after(stored_keys, inserted)
        return self._replace_children(s, incoming, deleted)

    def replace_children(self, table: str, rows: DataFrame, day: str, deleted: KeySet) -> int:
        """Deletes the children of some parent keys and adds ``rows``; ``day`` is the column
        (yyyy-MM-dd) of their parent's day. Returns the rows added."""
        s = self._as_stored(self.strategies[table])
        incoming = self._prepared(table, rows, also=[day])
        if self.store.snapshot(self.target(table)).partition_by:
            part = self._part(s, F.to_date(F.col(day), "yyyy-MM-dd"))
            incoming = incoming.withColumn(PARTITION, part)
        return self._replace_children(s, incoming.drop(day), deleted)

    def _replace_children(self, s: Strategy, incoming: DataFrame, deleted: KeySet) -> int:
        name = self.target(s.table)
        loaded = self._agreed(s, incoming)
        if not self.store.snapshot(name).partition_by or self._retyped(name, loaded):
            kept = rows_without_keys(self._stored(name, loaded), deleted, s.join_columns)
            return self._store_replace(s, [kept, loaded])
        touched = self._parts_with_keys(name, deleted, s.join_columns)
        kept = []
        if touched:
            stored = self._stored(name, loaded, touched)
            kept = [rows_without_keys(stored, deleted, s.join_columns)]
        return self._store_replace(s, [*kept, loaded], touched)

    def _deleted_keys(self, s: Strategy, parent: Strategy, ctx: RunContext) -> KeySet | None:
        """In-window keys of the refreshed parent copy; None when it has no copy."""
        name = self.target(s.parent)
        if not self.store.exists(name):
            return None
        only = None
        same_window = set(s.watermark_columns) == set(parent.watermark_columns)
        if self.store.snapshot(name).partition_by and not parent.parent and same_window:
            first = self._first_part(parent, ctx)

            def only(part: str) -> bool:
                return part != NULL_PARTITION and part >= first

        between = self.strategies[s.via] if s.via else None
        keys = between.parent_keys if between else s.parent_keys

        def referred(parents: DataFrame) -> KeySet:
            found = window_keys(parents, keys, s.watermark_columns, ctx)
            if between is None:
                return found
            rows = rows_with_keys(self.store.read(self.target(s.via)), found, between.join_columns)
            return key_set(rows, s.parent_keys)

        if between is not None and not self.store.exists(self.target(s.via)):
            return None
        after = referred(self.store.read(name, only))
        if not self.delete_orphans or name not in self.versions:
            return after
        old = self.store.read(name, only, version=self.versions[name])
        return keys_before_and_after(referred(old), after)

    def _custom(self, s: Strategy, ctx: RunContext) -> int:
        name = self.target(s.table)
        if callable(s.custom_query):
            incoming = s.custom_query(self.read, ctx)
        else:
            sql = _with_days(s.custom_query, ctx)
            used = {t: self.read(t) for t in self.source_tables if "{" + t + "}" in sql}
            incoming = scan_query(self.spark, sql, used, ctx)
        incoming = self._prepared(s.table, incoming)
        partitioned = bool(self.store.snapshot(name).partition_by)
        loaded = self._agreed(s, self._with_part(s, incoming) if partitioned else incoming)
        if not partitioned or self._retyped(name, loaded):
            kept = self._rows_where(s, self._stored(name, loaded), ctx, deleted=False)
            return self._store_replace(s, [kept, loaded])
        # Only partitions that lose rows are written anew.
        stored = self.store.read(name, keep_partition=True)
        doomed = self._rows_where(s, stored, ctx, deleted=True).select(PARTITION).distinct()
        touched = {r[0] if r[0] is not None else NULL_PARTITION for r in doomed.collect()}
        kept = []
        if touched:
            kept = [self._rows_where(s, self._stored(name, loaded, touched), ctx, deleted=False)]
        return self._store_replace(s, [*kept, loaded], touched)

    def _rows_where(self, s: Strategy, df: DataFrame, ctx: RunContext, deleted: bool) -> DataFrame:
        """Rows the delete condition is true for, or all others (NULL does not delete).
        Without a condition it is the window of the table's own watermarks."""
        condition = s.delete_condition
        if condition is None:
            if not s.watermark_columns or s.parent:
                return df.filter(F.lit(not deleted))
            own = window_rows if deleted else survivors
            return own(df, s.watermark_columns, ctx)
        if callable(condition):
            hit = F.coalesce(condition(ctx), F.lit(False))
            return df.filter(hit if deleted else ~hit)
        condition = _with_days(condition, ctx)
        copies = {t: self.target(t) for t in self.source_tables if "{" + t + "}" in condition}
        tables = {t: self.store.read(c) for t, c in copies.items()}
        sql = "SELECT * FROM {kept_rows} WHERE " + ("" if deleted else "NOT ")
        sql += "coalesce((" + condition + "), false)"
        return scan_query(self.spark, sql, {"kept_rows": df, **tables}, ctx)

    # -- pieces -----------------------------------------------------------

    def _source(self, table: str) -> DataFrame:
        return self._prepared(table, self.read(table))

    def _read_window(self, table: str, watermarks: Sequence[str], ctx: RunContext) -> DataFrame:
        """The window's rows; a reader that pages by query gets the window for its pages."""
        if isinstance(self.read, JdbcReader):
            cutoff = ctx.cutoff.isoformat()
            where = " OR ".join(f"{c} >= '{cutoff}'" for c in watermarks)
            return window_rows(self.read.window(table, where), watermarks, ctx)
        return window_rows(self.read(table), watermarks, ctx)

    def _prepared(self, table: str, df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
        """``df`` cleaned and typed as its copy's rows; columns in ``also`` stay beside them."""
        if PARTITION in (c.lower() for c in df.columns):
            raise ValueError(f"{table}: the column name {PARTITION} is reserved")
        df = self._times(table, df)
        if self.clean:
            df = clean_text_columns(df)
        if table in self.source_types:
            beside = [df.schema[c] for c in also]
            typed = target_schema(self.source_types[table])
            df = cast_to_schema(df, T.StructType([*typed.fields, *beside]))
        for c in self.strategies.get(table, default_strategy(table)).required:
            missing = F.raise_error(F.lit(f"{table}.{c} has no value")).cast(df.schema[c].dataType)
            df = df.withColumn(c, F.coalesce(F.col(c), missing))
        return df

    def _times(self, table: str, df: DataFrame) -> DataFrame:
        """Times of day, which readers give as durations or instants, as HH:mm:ss text."""
        timed = {c.lower() for c, kind in self.source_types.get(table, ()) if base_type(kind) == "time"}
        out = {}
        for f in df.schema.fields:
            if f.name.lower() not in timed:
                continue
            value = F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.DayTimeIntervalType):
                out[f.name] = duration_to_time(value)
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
                midnight = F.date_trunc("day", value)
                out[f.name] = duration_to_time(value - midnight)
        return df.withColumns(out) if out else df

    def _for_append(self, s: Strategy, df: DataFrame, fresh: bool = False) -> tuple[DataFrame, str | None]:
        """``df`` ready to be stored, and the name of its partition column if any."""
        name = self.target(s.table)
        known = not fresh and self.store.exists(name)
        if known:
            partitioned = bool(self.store.snapshot(name).partition_by)
        else:
            partitioned = self._spec(s) is not None
        if partitioned:
            df = self._with_part(s, df)
        return self._agreed(s, df) if known else df, PARTITION if partitioned else None

    def _with_part(self, s: Strategy, df: DataFrame) -> DataFrame:
        if not s.parent:
            return df.withColumn(PARTITION, self._part(s, window_day(s.watermark_columns)))
        days = self._days(s, self.read(s.parent)).toDF(*s.join_columns, PARTITION)
        return df.join(days, list(s.join_columns), "left").select(*df.columns, PARTITION)

    def _days(self, s: Strategy, parents: DataFrame) -> DataFrame:
        """(parent keys of ``s``, partition): one value for each key, since a parent
        key that repeats must not repeat children."""
        day = self._part(s, window_day(s.watermark_columns)).alias(PARTITION)
        if s.via is None:
            days = parents.select(*s.parent_keys, day)
        else:
            between = self.strategies[s.via]
            days = parents.select(*between.parent_keys, day).toDF(*between.join_columns, PARTITION)
            days = self.read(s.via).join(days, list(between.join_columns))
            days = days.select(*s.parent_keys, PARTITION)
        return days.groupBy(*s.parent_keys).agg(F.max(PARTITION).alias(PARTITION))

    def _agreed(self, s: Strategy, df: DataFrame) -> DataFrame:
        """``df`` under the schema its table will have after this load."""
        new = all_nullable(df.drop(PARTITION).schema)
        existing = self.store.snapshot(self.target(s.table)).schema
        schema = reconcile(existing, new, s.type_policy or self.type_policy)
        if PARTITION in df.columns:
            schema = T.StructType([*schema.fields, T.StructField(PARTITION, T.StringType())])
        return cast_to_schema(df, schema)

    def _part(self, s: Strategy, day: Column) -> Column:
        return F.date_format(day, PARTITION_FORMATS[s.partition_unit or "day"][0])

    def _first_part(self, s: Strategy, ctx: RunContext) -> str:
        return ctx.cutoff.strftime(PARTITION_FORMATS[s.partition_unit or "day"][1])

    def _parts_with_keys(self, name: str, keys: KeySet, columns: Sequence[str]) -> set[str]:
        """Partitions that hold any of the keys. The copy's skipping index names those
        that may; of them only the key columns are read. What comes back is a list of
        folder names, never rows."""
        may = self.store.parts_with_keys(name, keys, columns)
        if may is not None and not may:
            return set()
        only = None if may is None else may.__contains__
        stored = self.store.read(name, only, keep_partition=True).select(*columns, PARTITION)
        rows = rows_with_keys(stored, keys, columns).select(PARTITION).distinct().collect()
        return {r[0] if r[0] is not None else NULL_PARTITION for r in rows}

    def _stored(self, name: str, like: DataFrame, parts: set[str] | None = None) -> DataFrame:
        """Rows of the copy (or some partitions of it) in the shape of ``like``."""
        only = None if parts is None else parts.__contains__
        stored = self.store.read(name, only, keep_partition=PARTITION in like.columns)
        return cast_to_schema(stored, like.schema)

    def _retyped(self, name: str, loaded: DataFrame) -> bool:
        """True when a stored column gets another type: its files must then be
        written anew, partitions cannot be carried over."""
        old = self.store.snapshot(name).schema
        return any(loaded.schema[f.name].dataType != f.dataType for f in old.fields)


def _with_days(sql: str, ctx: RunContext) -> str:
    """The lookback stands where SQL takes no parameter, as in an interval."""
    return sql.replace("{lookback_days}", str(ctx.lookback_days))


def run_databases(replicators: Sequence[Replicator], ctx: RunContext) -> DataFrame:
    """Refresh several databases one after the other under one ledger."""
    return union_all(r.run(ctx) for r in replicators)
