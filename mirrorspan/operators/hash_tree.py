"""Drift by a hash tree: only what differs is compared row by row.

Each side sums its rows into leaves, buckets of key hashes: the number of rows and two
sums of row hashes. That is one pass with map-side combining, and each side can do it
where it lies and keep it with its version. Leaves make up nodes, ``FANOUT`` at a time, up
to a root. Two trees are compared from the root down: children are looked at only
below nodes that differ. Rows of the leaves that differ in the end, and no others, go
through the exact comparison by key.

``leaf_rows`` trades the size of the tree against the rows that share a leaf with
a difference: of n rows with a share d of them changed, about n * d * leaf_rows are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mirrorspan.operators.quality import sync_drift
from mirrorspan.session import materialized

FANOUT = 64
LEAF_ROWS = 16
_SUMS = ("n", "h1", "h2")


def levels_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Levels below the root, so that a leaf holds ``leaf_rows`` of so many rows or fewer."""
    levels = 1
    while FANOUT**levels * leaf_rows < rows:
        levels += 1
    return levels


def leaves_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Leaves of a tree over so many rows: a power of two, with half of ``leaf_rows`` each
    or more. Full levels would give up to ``FANOUT`` times as many, near one for each row."""
    count = 1
    while count * leaf_rows < rows:
        count *= 2
    return count


def leaf(key: Sequence[str], count: int) -> Column:
    """The leaf of a row, of ``count``. Equal keys share one on both sides."""
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in key)), F.lit(count))


def leaves(df: DataFrame, key: Sequence[str], count: int, columns: Sequence[str] | None = None) -> DataFrame:
    """(node, n, h1, h2) of the leaves that have rows.

    Hashes are 31 bits of a row's, so their sums stay exact; the flags keep (NULL, x) and
    (x, NULL) apart.
    """
    cols = [F.col(f"`{c}`") for c in (columns or df.columns)]
    flags = [c.isNull() for c in cols]
    limit = F.lit(2**31 - 1)
    return (
        df.select(
            leaf(key, count).alias("node"),
            F.pmod(F.xxhash64(F.lit(1), *cols, *flags), limit).alias("h1"),
            F.pmod(F.xxhash64(F.lit(2), *reversed(cols), *flags), limit).alias("h2"),
        )
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    )


def tree(leaf_sums: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes of every level, the root's children first, the leaves last."""
    nodes = [leaf_sums]
    for _ in range(levels - 1):
        up = nodes[0].withColumn("node", F.floor(F.col("node") / FANOUT))
        nodes.insert(0, up.groupBy("node").agg(*(F.sum(c).alias(c) for c in _SUMS)))
    return nodes


def differing_leaves(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """(node) of the leaves that differ, looked for below differing nodes only."""
    below = None
    for a, b in zip(left, right):
        if below is not None:
            parent = F.floor(F.col("node") / FANOUT)
            a, b = (
                side.withColumn("_parent", parent).join(below, "_parent", "left_semi").drop("_parent")
                for side in (a, b)
            )
        both = a.join(b.toDF("_node", *(f"_{c}" for c in _SUMS)), F.col("node") == F.col("_node"), "full")
        same = F.lit(True)
        for c in _SUMS:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        differ = both.filter(~same).select(F.coalesce("node", "_node").alias("node"))
        below = differ.withColumnRenamed("node", "_parent")
    return below.withColumnRenamed("_parent", "node")


def suspects(
    source: DataFrame, target: DataFrame, key: Sequence[str], rows: int | None = None,
    leaf_rows: int = LEAF_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides that lie in a leaf that differs.

    ``rows`` is the number of rows of the larger side, counted if it isn't given.
    """
    if rows is None:
        rows = max(source.count(), target.count())
    levels, count = levels_for(rows, leaf_rows), leaves_for(rows, leaf_rows)
    columns = source.columns
    target = target.select(*(F.col(f"`{c}`") for c in columns))
    left, right = (
        tree(materialized(leaves(side, key, count), "hash-tree"), levels) for side in (source, target)
    )
    differ = materialized(differing_leaves(left, right), "hash-tree-differ")
    return tuple(
        side.withColumn("_leaf", leaf(key, count))
        .join(differ.withColumnRenamed("node", "_leaf"), "_leaf", "left_semi")
        .drop("_leaf")
        for side in (source, target)
    )


def sync_drift_tree(
    source: DataFrame, target: DataFrame, key: Sequence[str], rows: int | None = None,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The rows of :func:`~mirrorspan.operators.quality.sync_drift`, from suspects alone."""
    return sync_drift(*suspects(source, target, key, rows, leaf_rows), key)
