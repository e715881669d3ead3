"""Pages of equal depth: key ranges that hold about as many rows each.

Pages of equal width hold anything from no row to nearly all when keys have gaps or crowd.
Here the source is asked to count instead. The key range is cut into cells of equal
width and one grouped query counts them; cells with more rows than a page may have are cut
further, all in one query a round, until every cell fits or is a single key. Neighbouring
cells are then joined up to the page size. So no page has more rows than asked for,
unless one key alone has.

Only counts of cells come to the driver, some ``CELLS`` for each page.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

CELLS = 16


@dataclass(frozen=True)
class Page:
    """Keys ``first`` to ``last``, both inside, and their rows."""

    first: int
    last: int
    rows: int


# (ranges, width) -> {first key of a cell: rows} for all cells of ``width`` keys that have rows;
# cells of a range start at its first key.
CountCells = Callable[[Sequence[tuple[int, int]], int], dict[int, int]]


def equal_depth(count: CountCells, low: int, high: int, rows: int, page_rows: int) -> list[Page]:
    """Pages that cover ``low`` to ``high`` without gaps; ``rows`` of them is a guess of the whole."""
    if page_rows < 1:
        raise ValueError("a page holds a row at least")
    wanted = CELLS * max(1, -(-rows // page_rows))
    width = max(1, -(-(high - low + 1) // wanted))
    heavy = [(low, high)]
    cells: list[Page] = []
    while heavy:
        next_heavy = []
        for first, n in sorted(count(heavy, width).items()):
            # A cell ends with its range, whose width need not be a multiple.
            last = min(first + width - 1, _end(heavy, first))
            if n > page_rows and last > first:
                next_heavy.append((first, last))
            else:
                cells.append(Page(first, last, n))
        heavy, width = next_heavy, max(1, -(-width // (4 * CELLS)))
    return _joined(sorted(cells, key=lambda c: c.first), low, high, page_rows)


def _end(ranges: Sequence[tuple[int, int]], key: int) -> int:
    """Last key of the range, of sorted ones, that holds ``key``."""
    at, step = 0, len(ranges)
    while step > 1:  # binary search for the last range that begins at or before the key
        half = step // 2
        if ranges[at + half][0] <= key:
            at += half
        step -= half
    return ranges[at][1]


def _joined(cells: list[Page], low: int, high: int, page_rows: int) -> list[Page]:
    groups: list[tuple[int, int]] = []  # (first key, rows); a group ends where the next begins
    for c in cells:
        if groups and groups[-1][1] + c.rows <= page_rows:
            groups[-1] = (groups[-1][0], groups[-1][1] + c.rows)
        else:
            groups.append((c.first, c.rows))
    if not groups:
        return [Page(low, high, 0)]
    begins = [low, *(first for first, _ in groups[1:])]
    ends = [*(b - 1 for b in begins[1:]), high]
    return [Page(a, b, n) for a, b, (_, n) in zip(begins, ends, groups)]


def frame_counter(df: DataFrame, key: str) -> CountCells:
    """Counts cells of a DataFrame: one scan of the key column a round."""
    value = F.col(f"`{key}`").cast("bigint")

    def count(ranges: Sequence[tuple[int, int]], width: int) -> dict[int, int]:
        begins = F.array(*(F.lit(a).cast("bigint") for a, _ in ranges))
        ends = F.array(*(F.lit(b).cast("bigint") for _, b in ranges))
        inside = df.filter(value.between(ranges[0][0], ranges[-1][1])).select(value.alias("k"))
        at = last_at_most(begins, F.col("k"), len(ranges))
        placed = inside.withColumn("at", at).filter(F.col("k") <= F.get(ends, F.col("at")))
        # Differences of keys of either sign may need more than 63 bits.
        wide = "decimal(20,0)" if ranges[-1][1] - ranges[0][0] >= 2**63 else "bigint"
        offset = F.col("k").cast(wide) - F.get(begins, F.col("at")).cast(wide)
        cell = (F.col("k").cast(wide) - F.pmod(offset, F.lit(width).cast(wide))).cast("bigint")
        return {r[0]: r[1] for r in placed.groupBy(cell.alias("cell")).count().collect()}

    return count


def last_at_most(sorted_values: Column, value: Column, n: int) -> Column:
    """Place (from 0) of the last of ``n`` sorted values that is not above ``value``; -1 for
    none. A binary search as an expression."""
    steps = [1 << k for k in reversed(range(max(1, n).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= n) & (F.get(sorted_values, at + step - 1) <= value), at + step
        ).otherwise(at),
    ) - 1


def cells_sql(table: str, key: str, ranges: Sequence[tuple[int, int]], width: int, where: str | None = None) -> str:
    """The counting query of a round in the SQL of common databases."""
    parts = []
    for a, b in ranges:
        condition = f"{key} BETWEEN {a} AND {b}" + (f" AND ({where})" if where else "")
        cell = f"{key} - MOD({key} - {a}, {width})"
        parts.append(f"SELECT {cell} AS cell, count(*) AS n FROM {table} WHERE {condition} GROUP BY {cell}")
    return " UNION ALL ".join(parts)


def page_predicates(key: str, pages: Sequence[Page]) -> list[str]:
    """Conditions of the pages' reads; rows without a key go with the first one."""
    found = [f"{key} BETWEEN {p.first} AND {p.last}" for p in pages]
    return [f"({found[0]} OR {key} IS NULL)", *found[1:]]


def table_pages(df: DataFrame, key: str, page_rows: int) -> list[Page]:
    """Pages of a DataFrame by its whole-number key; none if it has no key at all."""
    value = F.col(f"`{key}`").cast("bigint")
    low, high, rows = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if low is None:
        return []
    return equal_depth(frame_counter(df, key), low, high, rows, page_rows)


def scan_balanced(df: DataFrame, key: str, pages: Sequence[Page]) -> DataFrame:
    """The whole table with the number of each row's page: a projection, no shuffle.
    Rows without a key are of no page."""
    if not pages:
        return df.withColumn("page", F.lit(None).cast("bigint"))
    begins = F.array(*(F.lit(p.first).cast("bigint") for p in pages))
    value = F.col(f"`{key}`").cast("bigint")
    page = last_at_most(begins, value, len(pages)).cast("bigint")
    return df.withColumn("page", F.when(value.isNotNull(), page))
