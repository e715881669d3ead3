"""Key-set joins: children of a window, anti-joins, multi-hop, join tests.

A key set is measured before it is broadcast. Catalyst cannot know how few
rows a date window keeps (a filter does not shrink its size estimate without
column statistics), so it would shuffle a huge child table to meet a handful
of keys; on the other hand a window can be large. One narrow aggregation over
the pushed-down window decides. Beyond the limit the join stays a shuffle
join, where adaptive execution splits a hot key of the child side over many
tasks (the key side is unique, so the copies it needs stay small).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from mirrorspan.functions.dates import ntz
from mirrorspan.model import Relationship, SourceReader

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD_BYTES = 32


@dataclass(frozen=True)
class KeySet:
    """Key columns of some rows and, once measured, an upper bound of their size
    and the range of the first key column."""

    df: DataFrame
    columns: tuple[str, ...]
    rows: int | None = None
    bytes: int | None = None
    low: object = None
    high: object = None

    @property
    def small(self) -> bool:
        return self.bytes is not None and self.bytes <= BROADCAST_LIMIT_BYTES

    def frame(self, names: Sequence[str] | None = None) -> DataFrame:
        """Keys renamed to ``names``, marked for broadcast only if measured small."""
        df = self.df if names is None else self.df.toDF(*names)
        return F.broadcast(df) if self.small else df

    def measured(self) -> KeySet:
        if self.bytes is not None:
            return self
        first = F.col(f"`{self.columns[0]}`")
        row = self.df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(_row_bytes(self.df)).alias("bytes"),
            F.min(first).alias("low"),
            F.max(first).alias("high"),
        ).first()
        return replace(
            self, rows=row["rows"], bytes=int(row["bytes"] or 0), low=row["low"], high=row["high"]
        )

    def within_range(self, df: DataFrame, column: str) -> DataFrame:
        """Rows of ``df`` whose key can be in the set at all.

        Keys of recent rows usually lie close together; as a plain comparison
        this skips files and row groups (or source pages) before the join.
        """
        if self.low is None:
            return df
        # A zone-less instant must not be read in the session's zone.
        zoneless = isinstance(df.schema[column].dataType, T.TimestampNTZType)
        literal = ntz if zoneless else F.lit
        return df.filter(F.col(f"`{column}`").between(literal(self.low), literal(self.high)))


def without_nulls(df: DataFrame) -> DataFrame:
    """Rows with a value in every column, as filters that reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, (F.col(f"`{c}`").isNotNull() for c in df.columns)))


def _row_bytes(df: DataFrame):
    size = F.lit(_ROW_OVERHEAD_BYTES)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        else:
            size = size + F.lit(16)
    return size.cast("bigint")


def key_set(df: DataFrame, columns: Sequence[str], unique: bool = True) -> KeySet:
    """Measured keys of ``df``; rows with a NULL key can match nothing and are left out."""
    keys = without_nulls(df.select(*columns))
    if not unique:
        keys = keys.distinct()
    return KeySet(keys, tuple(columns)).measured()


def rows_with_keys(df: DataFrame, keys: KeySet, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in the set (all their columns, each row once)."""
    names = list(columns or keys.columns)
    return keys.within_range(df, names[0]).join(keys.frame(names), names, "left_semi")


def rows_without_keys(df: DataFrame, keys: KeySet, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key is not in the set; rows with a NULL key stay."""
    names = list(columns or keys.columns)
    return df.join(keys.frame(names), names, "left_anti")


def keys_via(child: DataFrame, parent_keys: KeySet, child_columns: Sequence[str],
             own_columns: Sequence[str]) -> KeySet:
    """Keys of the rows of ``child`` that belong to ``parent_keys`` (one hop)."""
    return key_set(rows_with_keys(child, parent_keys, child_columns), own_columns)


def join_on(left: DataFrame, right: DataFrame, left_columns: Sequence[str],
            right_columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join over one or several key columns with different names."""
    on = [left[l] == right[r] for l, r in zip(left_columns, right_columns)]
    return left.join(right, on, how)


def names_missing(wanted: DataFrame, present: DataFrame, column: str) -> DataFrame:
    return wanted.join(present.select(column).distinct(), column, "left_anti")


def _key_counts(df: DataFrame, columns: Sequence[str], count: str) -> DataFrame:
    names = [f"k{i}" for i in range(len(columns))]
    keys = without_nulls(df.select(*[F.col(c).alias(n) for c, n in zip(columns, names)]))
    return keys.groupBy(*names).agg(F.count(F.lit(1)).alias(count))


def join_test(left: DataFrame, right: DataFrame, left_columns: Sequence[str],
              right_columns: Sequence[str]) -> DataFrame:
    """Size of an equi-join and distinct keys on each side, without joining rows.

    The rows of both sides are counted per key in one grouping (with map-side combining,
    so a hot key is one row before the shuffle); the joined size is the sum of products.
    Nothing is sorted and a task holds one table of counts.
    """
    names = [f"k{i}" for i in range(len(left_columns))]

    def marked(df: DataFrame, columns: Sequence[str], n1: int, n2: int) -> DataFrame:
        keys = without_nulls(df.select(*[F.col(c).alias(n) for c, n in zip(columns, names)]))
        return keys.select(*names, F.lit(n1).alias("n1"), F.lit(n2).alias("n2"))

    both = marked(left, left_columns, 1, 0).unionByName(marked(right, right_columns, 0, 1))
    counts = both.groupBy(*names).agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"))
    joined = F.coalesce(F.sum(F.col("n1") * F.col("n2")), F.lit(0)).cast("bigint")
    matched = F.count(F.lit(1))
    return counts.filter("n1 > 0 AND n2 > 0").agg(
        joined.alias("total_joined_rows"),
        matched.alias("unique_t1_keys"),
        matched.alias("unique_t2_keys"),
    ).withColumn("join_works", F.col("total_joined_rows") > 0)


# Result names of the join tests.
def labelled_join_test(read: SourceReader, rel: Relationship) -> DataFrame:
    """The join test of one relationship as one row; columns that do not exist
    are reported in ``error`` instead of failing the other tests."""
    parent, child = read(rel.ref_table), read(rel.table)
    head = [
        F.lit(rel.name).alias("constraint_name"),
        F.lit(rel.ref_table).alias("table1"),
        F.lit(rel.table).alias("table2"),
        F.lit("=".join(",".join(c) for c in (rel.ref_columns, rel.columns))).alias("join_column"),
    ]
    absent = [
        c
        for df, columns in ((parent, rel.ref_columns), (child, rel.columns))
        for c in columns
        if c.lower() not in {x.lower() for x in df.columns}
    ]
    if not absent:
        result = join_test(parent, child, rel.ref_columns, rel.columns)
        return result.select(*head, "*", F.lit(None).cast("string").alias("error"))
    zero = F.lit(0).cast("bigint")
    return child.sparkSession.range(1).select(
        *head,
        zero.alias("total_joined_rows"),
        zero.alias("unique_t1_keys"),
        zero.alias("unique_t2_keys"),
        F.lit(False).alias("join_works"),
        F.lit("no column " + ", ".join(absent)).alias("error"),
    )


def fk_orphans(read: SourceReader, rel: Relationship) -> DataFrame:
    """Child rows and distinct child keys without a parent, for one foreign key.

    Children are counted per key before the join, so neither side is skewed;
    rows with a NULL in the key reference nothing and are no orphans.
    """
    names = [f"k{i}" for i in range(len(rel.columns))]
    child = _key_counts(read(rel.table), rel.columns, "n")
    parent = read(rel.ref_table).select(*[F.col(c).alias(n) for c, n in zip(rel.ref_columns, names)])
    parent = without_nulls(parent).distinct().withColumn("found", F.lit(True))
    lost = F.col("found").isNull()
    return (
        child.join(parent, names, "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows"),
            F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(lost).alias("orphan_keys"),
        )
        .select(
            F.lit(rel.name).alias("constraint_name"),
            F.lit(rel.table).alias("table_name"),
            F.lit(rel.ref_table).alias("referenced_table"),
            "*",
        )
    )
