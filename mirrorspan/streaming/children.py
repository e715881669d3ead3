"""Window refresh of a child table as a stream of its parents' and its own files.

The batch refresh takes the children whose parent lies in the window. In a stream the two
arrive in any order, so rows are dealt by the parent's key over ``GROUPS`` groups with state,
which know of each of their keys what has come:

* a parent says whether its key is inside the run's window, and on which day;
  a key inside gives a ``delete`` row, once a run;
* a child whose parent has come in this run goes to its parent's day, or nowhere
  if the parent lies outside the window;
* an early child is held until its parent comes, also across restarts.

The files of a run hold the window's parents and their children, as a source does
when its last N days are read. A run is what one ``ctx`` covers; runs go forward.
The event time is the run's own date, never the clock: what has waited ``hold_days``
for a parent that doesn't come is dropped, and so are old keys.

Each micro-batch deletes the children of the keys that came in, in the partitions
that hold any, and adds the routed ones, in one switch. A replayed batch is recognised
as in ``incremental``. A hot key is dealt over ``salts`` groups, each with the parent. A call
and a state for each key would cost more than its few rows; the groups of a checkpoint
are as many as they were when it began.

Children travel as text of exact values, so state and Python never see a number that
they could round. Rows with a NULL in the key have no parent and are left out.
"""

from __future__ import annotations

import datetime as dt
import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mirrorspan.functions.dates import in_window, window_day
from mirrorspan.model import RunContext, Strategy
from mirrorspan.operators.joins import KeySet, without_nulls
from mirrorspan.plans.runner import Replicator
from mirrorspan.session import materialized
from mirrorspan.sources.store import TableStore
from mirrorspan.streaming.incremental import batch_mark

ROW, DELETE = "row", "delete"
STATE_SCHEMA = "keys binary"
# Groups that keys are dealt over, for each salt.
GROUPS = 4096
_ATOMIC = (
    T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
    T.DoubleType, T.DecimalType, T.DateType, T.TimestampNTZType, T.TimestampType,
)


def _written(f: T.StructField) -> Column:
    value = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.BinaryType):
        return F.base64(value)
    if not isinstance(f.dataType, _ATOMIC):
        raise ValueError(f"{f.name}: {f.dataType.simpleString()} can't be held as text")
    return value.cast("string")


def payload(schema: T.StructType) -> Column:
    """All values of a row as one text."""
    return F.to_json(F.array(*map(_written, schema.fields)), {"ignoreNullFields": "false"})


def unpacked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows behind ``payload``, with the other columns of ``df`` after them."""
    values = df.withColumn("_values", F.from_json("payload", "array<string>"))
    columns = []
    for k, f in enumerate(schema.fields):
        value = F.element_at("_values", k + 1)
        value = F.unbase64(value) if isinstance(f.dataType, T.BinaryType) else value.cast(f.dataType)
        columns.append(value.alias(f.name))
    return values.select(*columns, *(c for c in df.columns if c != "payload"))


@dataclass(slots=True)
class _Key:
    """What has come of a key: the run of its parent, whether that lies in the window, its
    day, the latest run of any row, and the children that wait."""

    run: str | None = None
    inside: bool = False
    day: str | None = None
    latest: str = ""
    held: list[str] = field(default_factory=list)


def _packed(keys: dict[tuple, _Key]) -> bytes:
    plain = {k: (v.run, v.inside, v.day, v.latest, v.held) for k, v in keys.items()}
    return zlib.compress(pickle.dumps(plain, pickle.HIGHEST_PROTOCOL), 1)


def _unpacked(state: GroupState) -> dict[tuple, _Key]:
    if not state.exists:
        return {}
    return {k: _Key(*v) for k, v in pickle.loads(zlib.decompress(state.get[0])).items()}


def _route(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Routes the rows of one group of keys (and salt); the last two parts of the key are the
    salt and the days that a key is kept after its latest row."""
    _, salt, hold_days = key
    keys, touched, deletes, children = _unpacked(state), set(), {}, []
    for frame in frames:
        names = [c for c in frame.columns if c.startswith("key")]
        columns = (frame[c].tolist() for c in ("run", "parent", "inside", "day", "payload"))
        for own, *row in zip(zip(*(frame[c].tolist() for c in names)), *columns):
            run, parent, coming, day, text = row
            known = keys.setdefault(own, _Key())
            known.latest = max(known.latest, run)
            touched.add(own)
            if not parent:
                children.append((own, text))
                continue
            if known.run is None or run > known.run:
                known.run, known.inside, known.day = run, False, None
            if run == known.run and coming:
                if not known.inside:
                    deletes[own] = None
                known.inside, known.day = True, max(filter(None, (known.day, day)), default=None)
    # All parents have been seen by now.
    for own, text in children:
        keys[own].held.append(text)
    rows = []
    for own in touched:
        known = keys[own]
        if known.run == known.latest:
            if known.inside:
                rows += [(*own, ROW, known.day, text) for text in known.held]
            known.held = []
    if salt == 0:
        rows += [(*own, DELETE, keys[own].day, None) for own in deletes]
    if rows:
        yield pd.DataFrame(rows, columns=[*names, "kind", "day", "payload"])
    ends: dict[str, int] = {}
    for latest in {known.latest for known in keys.values()}:
        until = dt.datetime.fromisoformat(latest).replace(tzinfo=dt.timezone.utc)
        ends[latest] = int((until + dt.timedelta(days=int(hold_days))).timestamp() * 1000)
    now = state.getCurrentWatermarkMs()
    keys = {own: known for own, known in keys.items() if own in touched or ends[known.latest] >= now}
    if not keys:
        state.remove()
        return
    state.update((_packed(keys),))
    state.setTimeoutTimestamp(max(min(ends[known.latest] for known in keys.values()), now + 1))


def routed_children(
    parents: DataFrame,
    children: DataFrame,
    strategy: Strategy,
    ctx: RunContext,
    salts: int = 4,
    hold_days: int | None = None,
) -> DataFrame:
    """A stream of (key columns, kind, day, payload) from streams of parents and children.

    ``hold_days`` is how long an early child and a key are remembered; by default as long
    as the window.
    """
    s = strategy
    if not s.parent or s.via or not s.watermark_columns:
        raise ValueError(f"{s.table}: only a child that refers to its parent itself can be streamed")
    hold = F.lit(max(1, ctx.lookback_days if hold_days is None else hold_days))
    as_of = ctx.as_of.date() if isinstance(ctx.as_of, dt.datetime) else ctx.as_of
    run = F.lit(as_of.isoformat())
    names = [f"key{k}" for k in range(len(s.join_columns))]
    kinds = [children.schema[c].dataType for c in s.join_columns]
    keyed = [F.col(f"`{c}`").cast(k).alias(n) for c, k, n in zip(s.parent_keys, kinds, names)]
    day = F.date_format(window_day(s.watermark_columns), "yyyy-MM-dd")
    from_parents = parents.select(
        *keyed,
        F.explode(F.array(*map(F.lit, range(salts)))).alias("salt"),
        F.lit(True).alias("parent"),
        F.coalesce(in_window(s.watermark_columns, ctx), F.lit(False)).alias("inside"),
        day.alias("day"),
        F.lit(None).cast("string").alias("payload"),
    )
    text = payload(children.schema)
    from_children = children.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(s.join_columns, names)),
        F.pmod(F.xxhash64(text), F.lit(salts)).cast("int").alias("salt"),
        F.lit(False).alias("parent"),
        F.lit(False).alias("inside"),
        F.lit(None).cast("string").alias("day"),
        text.alias("payload"),
    )
    both = from_parents.unionByName(from_children).dropna(subset=names)
    group = F.pmod(F.xxhash64(*names), F.lit(GROUPS)).cast("int")
    timed = both.withColumns(
        {"group": group, "run": run, "hold": hold, "at": run.cast("timestamp")}
    ).withWatermark("at", "1 day")
    schema = ", ".join(f"{n} {k.simpleString()}" for n, k in zip(names, kinds))
    return timed.groupBy("group", "salt", "hold").applyInPandasWithState(
        _route, f"{schema}, kind string, day string, payload string", STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def replace_child_batches(
    store: TableStore, database: str, strategy: Strategy, ctx: RunContext, stream: str,
    schema: T.StructType,
) -> Callable[[DataFrame, int], None]:
    """Writes the batches of :func:`routed_children` to the child's copy, which must be there.

    ``schema`` is that of the children's files.
    """
    as_of = ctx.as_of.date() if isinstance(ctx.as_of, dt.datetime) else ctx.as_of

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = batch_mark(batch, stream)
        run = Replicator(
            batch.sparkSession, database, _no_source, [strategy.table], store, [strategy],
            batch={mark: batch_id, f"{mark}|run": as_of.toordinal()},
        )
        target = run.target(strategy.table)
        if not store.exists(target):
            raise ValueError(f"{target} has no copy yet: load it before its stream is started")
        if store.applied_batch(target, f"{mark}|run") > as_of.toordinal():
            raise ValueError(f"{target}: a later run than that of {as_of} has been written")
        if store.applied_batch(target, mark) >= batch_id:
            return
        # The state must not be asked twice.
        rows = materialized(batch, "stream-children")
        names = [c for c in rows.columns if c not in ("kind", "day", "payload")]
        gone = rows.filter(F.col("kind") == DELETE).select(*names).toDF(*strategy.join_columns)
        deleted = KeySet(without_nulls(gone), tuple(strategy.join_columns)).measured()
        routed = rows.filter(F.col("kind") == ROW).select("payload", F.col("day").alias("_day"))
        if deleted.rows or not routed.isEmpty():
            run.replace_children(strategy.table, unpacked(routed, schema), "_day", deleted)

    return write


def _no_source(table: str) -> DataFrame:
    raise ValueError(f"{table} is only known as a stream")
