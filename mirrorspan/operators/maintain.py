"""Views that follow their tables: only what a refresh has replaced is read again.

A view is kept as a table of sums per group. Two versions of a source table differ
in the folders that were replaced, so the rows that came and went are known without
reading the rest. Two kinds of views are kept:

* sums over rows (no ``keys``): each row adds to its group by itself, so the sums of
  the rows that went are taken off and those of the rows that came are put on;
* sums over keys: a key's rows of all its tables together (an invoice and its lines)
  add to their groups. The keys whose rows differ are found from the replaced folders;
  for these keys alone, the sums of before are taken off and those of now put on. Rows
  of such keys in other folders are found by the tables' skipping indexes.

A group whose ``count`` becomes zero is gone. The view names the versions it was made
of in its manifest, in the same switch as its rows; following twice changes nothing,
and a failed refresh leaves the view as it was. Where an old version is no longer there,
or a column that the view reads has changed its type, the view is made anew.

Sums must be whole numbers or decimals: they have to cancel out exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mirrorspan.operators.joins import KeySet, key_set, rows_with_keys
from mirrorspan.session import materialized
from mirrorspan.sources.store import NULL_PARTITION, Changes, TableStore

VIEW_PART = "view_part"


@dataclass(frozen=True)
class View:
    """``sums`` gives, for frames by role, groups and their sums.

    ``tables`` maps each role to a table of the store, ``keys`` each role to the columns that
    name the key its rows belong to. ``part`` is the text that groups are partitioned by.
    """

    name: str
    tables: Mapping[str, str]
    sums: Callable[[Mapping[str, DataFrame]], DataFrame]
    groups: Sequence[str]
    count: str
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    part: Column | None = None


def read_view(store: TableStore, view: View) -> DataFrame:
    return store.read(view.name)


def follow(store: TableStore, view: View) -> int:
    """Brings the view up to its tables; returns the groups that were written."""
    now = {t: store.snapshot(t).version for t in view.tables.values()}
    marks = {_mark(t): v for t, v in now.items()}
    if not store.exists(view.name):
        return _anew(store, view, marks)
    seen = store.snapshot(view.name).batches
    since = {t: seen.get(_mark(t)) for t in now}
    if since == now:
        return 0
    try:
        changes = {
            role: store.changes(t, since[t]) for role, t in view.tables.items() if since[t] != now[t]
        }
    except (FileNotFoundError, TypeError):  # an older version is gone, or was never seen
        return _anew(store, view, marks)
    if any(c.removed.schema != c.added.schema for c in changes.values()):
        return _anew(store, view, marks)
    before, after = (_of_keys if view.keys else _of_rows)(store, view, changes, since)
    return _apply(store, view, before, after, marks)


def _mark(table: str) -> str:
    return f"version of {table}"


def _anew(store: TableStore, view: View, marks: dict[str, int]) -> int:
    frames = {role: store.read(t) for role, t in view.tables.items()}
    return store.overwrite(view.name, *_parted(view, view.sums(frames)), batch=marks)


def _parted(view: View, df: DataFrame) -> tuple[DataFrame, str | None]:
    if view.part is None:
        return df, None
    return df.withColumn(VIEW_PART, view.part), VIEW_PART


def _of_rows(
    store: TableStore, view: View, changes: Mapping[str, Changes], since: Mapping[str, int]
) -> tuple[DataFrame, DataFrame]:
    """Sums of the rows that went and of those that came."""
    del since
    none = {
        role: store.spark.createDataFrame([], store.snapshot(t).schema)
        for role, t in view.tables.items()
    }
    gone = {role: c.removed for role, c in changes.items()}
    come = {role: c.added for role, c in changes.items()}
    return view.sums({**none, **gone}), view.sums({**none, **come})


def _of_keys(
    store: TableStore, view: View, changes: Mapping[str, Changes], since: Mapping[str, int]
) -> tuple[DataFrame, DataFrame]:
    """Sums of the keys whose rows differ, before and now."""
    first = next(iter(view.keys.values()))
    names = [f"key{k}" for k in range(len(first))]
    differing = [
        _differing(c, view.keys[role]).toDF(*names) for role, c in changes.items()
    ]
    keys = differing[0]
    for other in differing[1:]:
        keys = keys.unionByName(other)
    touched = key_set(materialized(keys.distinct(), "view-keys"), names)
    frames = []
    for versions in (since, {}):
        frames.append({
            role: _rows_of(store, view, role, touched, changes.get(role), versions.get(t))
            for role, t in view.tables.items()
        })
    return view.sums(frames[0]), view.sums(frames[1])


def _differing(change: Changes, key: Sequence[str]) -> DataFrame:
    """Keys with a row that came or went, as bags of rows.

    A row is compared by two 64-bit hashes of its values and of which are NULL.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in df.columns]
        flags = [c.isNull() for c in columns]
        return df.select(
            *(F.col(f"`{c}`") for c in key),
            F.xxhash64(F.lit(1), *columns, *flags).alias("_h1"),
            F.xxhash64(F.lit(2), *reversed(columns), *flags).alias("_h2"),
            F.lit(sign).alias("_side"),
        )

    rows = side(change.removed, -1).unionByName(side(change.added, 1))
    differ = rows.groupBy(*key, "_h1", "_h2").agg(F.sum("_side").alias("_n")).filter("_n <> 0")
    return differ.select(*key)


def _rows_of(
    store: TableStore, view: View, role: str, keys: KeySet, change: Changes | None,
    version: int | None,
) -> DataFrame:
    """All rows of the keys in one version: by index, else in the replaced folders and
    wherever the key's range may lie."""
    table, columns = view.tables[role], list(view.keys[role])
    own = KeySet(keys.df.toDF(*columns), tuple(columns), keys.rows, keys.bytes, keys.low, keys.high)
    may = store.parts_with_keys(table, own, columns, version)
    only = None if may is None else may.__contains__
    return rows_with_keys(store.read(table, only, version=version), own, columns)


def _apply(
    store: TableStore, view: View, before: DataFrame, after: DataFrame, marks: dict[str, int]
) -> int:
    """Takes the sums of before off the view and puts those of now on."""
    values = [f.name for f in after.schema.fields if f.name not in view.groups]
    wide = {f.name: f.dataType for f in after.schema.fields if f.name in values}
    inexact = [c for c, t in wide.items() if isinstance(t, (T.FloatType, T.DoubleType))]
    if inexact:
        raise ValueError(f"{view.name}: {', '.join(inexact)} can't be summed exactly")
    signed = before.select(*view.groups, *((-F.col(c)).cast(wide[c]).alias(c) for c in values))
    delta = signed.unionByName(after).groupBy(*view.groups).agg(*(F.sum(c).alias(c) for c in values))
    changed = delta.filter(" OR ".join(f"`{c}` <> 0" for c in values))
    changed, part = _parted(view, changed)
    changed = materialized(changed, "view-changes")
    touched = None
    if part:
        touched = {
            r[0] if r[0] is not None else NULL_PARTITION
            for r in changed.select(part).distinct().collect()
        }
    only = None if touched is None else touched.__contains__
    stored = store.read(view.name, only)
    both = stored.select(*view.groups, *values).unionByName(changed.select(*view.groups, *values))
    sums = both.groupBy(*view.groups).agg(*(F.sum(c).cast(wide[c]).alias(c) for c in values))
    kept, _ = _parted(view, sums.filter(F.col(view.count) != 0))
    return store.replace(view.name, [kept], only, batch=marks)[0]
