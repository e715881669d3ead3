"""Lookback windows over one or more date columns.

The comparison is always made on the bare column, so it reaches the scan as a
pushed filter; ``date(col) >= cutoff`` and ``col >= cutoff`` (midnight) select
the same rows for dates and timestamps alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from mirrorspan.model import RunContext


def ntz(value: dt.datetime) -> Column:
    """A zone-less literal (``F.lit`` would make an instant of it)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def in_window(columns: Sequence[str | Column], ctx: RunContext) -> Column:
    """True where any column lies on or after the cutoff; NULL never counts."""
    cutoff = F.lit(ctx.cutoff)
    return reduce(lambda a, b: a | b, (_col(c) >= cutoff for c in columns))


def in_window_null_guarded(columns: Sequence[str | Column], ctx: RunContext) -> Column:
    """The same window with the NULL test spelled out (never yields NULL)."""
    cutoff = F.lit(ctx.cutoff)
    return reduce(
        lambda a, b: a | b,
        (_col(c).isNotNull() & (_col(c) >= cutoff) for c in columns),
    )


def outside_window(columns: Sequence[str | Column], ctx: RunContext) -> Column:
    """Exact complement of :func:`in_window`, keeping rows without a date.

    Written as comparisons rather than ``NOT coalesce(...)`` so that it can be
    pushed down as well.
    """
    cutoff = F.lit(ctx.cutoff)
    return reduce(
        lambda a, b: a & b,
        (_col(c).isNull() | (_col(c) < cutoff) for c in columns),
    )


def window_day(columns: Sequence[str | Column]) -> Column:
    """The latest of the watermark dates.

    Any column in the window means the latest one is, so a table partitioned
    by this single value can drop or read its window by partition even when
    several columns define it. ``greatest`` skips NULLs; all NULL gives NULL.
    """
    days = [F.to_date(_col(c)) for c in columns]
    return days[0] if len(days) == 1 else F.greatest(*days)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
