"""Window replace: delete the last N days from the copy, insert them again.

    W(x)     = any watermark of x >= as_of - N    (NULL never matches)
    parent'  = rows of the copy outside W  +  source rows inside W
    child'   = rows of the copy whose parent is not being replaced
               +  source rows whose parent is inside W

Everything is bag semantics (no DISTINCT): repeated rows are data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from mirrorspan.functions.dates import in_window, outside_window
from mirrorspan.model import RunContext
from mirrorspan.operators.joins import KeySet, key_set, rows_with_keys, rows_without_keys


def window_rows(df: DataFrame, watermarks: Sequence[str], ctx: RunContext) -> DataFrame:
    return df.filter(in_window(watermarks, ctx))


def survivors(df: DataFrame, watermarks: Sequence[str], ctx: RunContext) -> DataFrame:
    """What a range delete leaves, including rows without any date."""
    return df.filter(outside_window(watermarks, ctx))


def window_keys(parent: DataFrame, keys: Sequence[str], watermarks: Sequence[str],
                ctx: RunContext) -> KeySet:
    """Measured primary keys of the parents inside the window."""
    return key_set(window_rows(parent, watermarks, ctx), keys)


def child_window_rows(child: DataFrame, keys: KeySet, columns: Sequence[str] | None = None) -> DataFrame:
    """Children of the window. A parent key is unique, so this semi-join gives
    the same rows as joining the parent and keeping the child's columns."""
    return rows_with_keys(child, keys, columns)


def child_survivors(child: DataFrame, keys: KeySet, columns: Sequence[str] | None = None) -> DataFrame:
    return rows_without_keys(child, keys, columns)


def window_replace(
    target: DataFrame,
    source: DataFrame,
    watermarks: Sequence[str],
    ctx: RunContext,
    unique_key: Sequence[str] = (),
) -> DataFrame:
    """Refreshed copy of a table with its own watermark columns.

    With ``unique_key`` a row whose date moved into the window replaces its old
    version too; by default the old version survives, as a plain range delete
    leaves it.
    """
    incoming = window_rows(source, watermarks, ctx)
    kept = survivors(target, watermarks, ctx)
    if unique_key:
        kept = rows_without_keys(kept, key_set(incoming, unique_key))
    return kept.unionByName(incoming)


def window_replace_child(
    target_child: DataFrame,
    source_child: DataFrame,
    deleted: KeySet,
    inserted: KeySet,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Refreshed copy of a child table.

    ``deleted`` are in-window keys of the refreshed copy of the parent,
    ``inserted`` those of the source parent. To also remove children of
    parents that vanished at the source, delete the keys before and after.
    """
    return child_survivors(target_child, deleted, columns).unionByName(
        child_window_rows(source_child, inserted, columns)
    )


def keys_before_and_after(before: KeySet, after: KeySet) -> KeySet:
    """Both key sets; repeated keys do no harm in a semi- or anti-join."""
    both = before.df.toDF(*after.columns).unionByName(after.df)
    return KeySet(both, after.columns).measured()
