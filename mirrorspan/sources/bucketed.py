"""Copies as bucketed catalog tables, so that tables of one key join without a shuffle.

A published table has the rows of a copy in buckets by a key, sorted by it within files. Two
such tables of as many buckets are joined bucket by bucket. It is partitioned as the copy,
so a refresh writes the partitions anew that the copy's refresh has replaced; the version
that a table shows is one of its properties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mirrorspan.sources.store import NULL_PARTITION, TableStore

PUBLISHED = "published_part"
VERSION = "mirrorspan.version"
ROWS_A_BUCKET = 1_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """How many buckets a table of so many rows, and those it is joined with, should have: a
    power of two, so that one task's bucket doesn't grow with the table."""
    buckets = least
    while buckets * ROWS_A_BUCKET < rows:
        buckets *= 2
    return buckets


def publish(
    store: TableStore, table: str, name: str, key: Sequence[str], buckets: int, path: str | None = None
) -> int:
    """Brings catalog table ``name`` up to the copy; returns the partitions written.

    The first time, or where the version it shows is no longer there, it is written whole.
    ``path`` is the folder of the files, in the warehouse by default.
    """
    spark = store.spark
    snap = store.snapshot(table)
    shown = _version(spark, name)
    if shown == snap.version:
        return 0
    changed = None
    if shown is not None and snap.partition_by is not None:
        try:
            changes = store.changes(table, shown)
            same = changes.removed.schema == changes.added.schema
            changed = changes.partitions if same and not changes.whole else None
        except FileNotFoundError:
            changed = None
    if changed is None:
        rows = _rows(store, table, None)
        writer = rows.repartition(buckets, *key).write.mode("overwrite").format("parquet")
        if snap.partition_by is not None:
            writer = writer.partitionBy(PUBLISHED)
        if path is not None:
            writer = writer.option("path", path)
        writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
        written = max(1, len(snap.partitions))
    else:
        rows = _rows(store, table, changed)
        gone = changed - set(snap.partitions)
        if changed - gone:
            new = rows.select(*spark.table(name).columns).repartition(buckets, *key)
            # A bucketed table takes this from the session, not from the writer.
            setting = "spark.sql.sources.partitionOverwriteMode"
            before = spark.conf.get(setting)
            spark.conf.set(setting, "dynamic")
            try:
                new.write.mode("overwrite").insertInto(name)
            finally:
                spark.conf.set(setting, before)
        for part in sorted(gone):
            value = "NULL" if part == NULL_PARTITION else "'" + part.replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PUBLISHED} = {value})")
        written = len(changed)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION}' = '{snap.version}')")
    spark.catalog.refreshTable(name)
    return written


def read_published(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a published table, without the column of its partitions."""
    return spark.table(name).drop(PUBLISHED)


def join_published(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """A join that uses the buckets of both sides, also where one side is small."""
    return left.hint("merge").join(right, on)


def _rows(store: TableStore, table: str, parts: frozenset[str] | None) -> DataFrame:
    only = None if parts is None else parts.__contains__
    part = store.snapshot(table).partition_by
    df = store.read(table, only, keep_partition=part is not None)
    return df if part is None else df.withColumn(PUBLISHED, F.col(part)).drop(part)


def _version(spark: SparkSession, name: str) -> int | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == VERSION).collect()
    return int(rows[0]["value"]) if rows else None
