"""File layout: day partitions, clustering, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mirrorspan.sources.pages import last_at_most

# Bits of each column's rank in a curve key: 255 bounds.
CURVE_BITS = 8
# Rows of a file in Z-order, on average at most.
ROWS_A_FILE = 500_000


def write_layout(
    df: DataFrame,
    path: str,
    day: Column,
    cluster_by: Sequence[str] = (),
    day_name: str = "date",
    max_rows_per_file: int = 5_000_000,
) -> None:
    """Snappy parquet under ``path/date=YYYY-MM-DD/``, sorted by the clustering
    columns so that row-group statistics can skip within a day.

    Rows are rebalanced by day: small days share a task, a very large day is
    split over several.
    """
    out = df.withColumn(day_name, day.cast("date")).hint("rebalance", day_name)
    if cluster_by:
        out = out.sortWithinPartitions(day_name, *cluster_by)
    (
        out.write.option("compression", "snappy")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(day_name)
        .parquet(path)
    )


def _number(f: T.StructField) -> Column:
    """A value as a number of the same order; of texts the first seven bytes."""
    value = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        head = F.rpad(F.substring(value.cast("binary"), 1, 7), 7, F.lit(bytes(1)))
        return F.conv(F.hex(head), 16, 10).cast("double")
    if isinstance(f.dataType, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(f.dataType, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(f.dataType, T.TimestampType):
        return F.unix_micros(value).cast("double")
    return value.cast("double")


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """Z-order key: the bits of the columns' ranks in turn, so that rows near each other
    in all columns lie near each other.

    Ranks come from quantiles of each column (one pass; ``2**bits - 1`` numbers a column come
    to the driver), so crowded values don't use up the key. NULL ranks lowest.
    """
    return _curve(df, columns, bits)[0]


def _curve(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> tuple[Column, int]:
    """:func:`curve_key`, and the number of rows, from the same pass."""
    if bits * len(columns) > 62:
        raise ValueError("the key has 62 bits at most")
    shares = F.lit([k / 2**bits for k in range(1, 2**bits)])
    numbers = [_number(df.schema[c]) for c in columns]
    bounds = df.agg(F.count(F.lit(1)).alias("rows"), *(
        F.percentile_approx(n, shares, F.lit(10 * 2**bits)).alias(f"b{i}") for i, n in enumerate(numbers)
    )).first()
    key = F.lit(0).cast("bigint")
    for i, n in enumerate(numbers):
        known = sorted(set(bounds[f"b{i}"] or []))
        if not known:
            continue
        rank = last_at_most(F.lit(known), n, len(known)) + 1
        rank = F.when(n.isNotNull(), rank).otherwise(0).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return key, bounds["rows"]


def write_curve(
    df: DataFrame, path: str, columns: Sequence[str], files: int, row_group_bytes: int | None = None
) -> None:
    """Snappy parquet in Z-order: files are ranges of the curve, sorted along it.

    ``files`` is how many there are at least; large tables get more, of ``ROWS_A_FILE`` rows."""
    key, rows = _curve(df, columns)
    files = max(files, -(-rows // ROWS_A_FILE))
    ranged = df.withColumn("_curve", key).repartitionByRange(files, "_curve")
    writer = ranged.sortWithinPartitions("_curve").drop("_curve").write.option("compression", "snappy")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def archive_path(root: str, database: str, table: str) -> str:
    return f"{root.rstrip('/')}/{database}/{table}"


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def retained(df: DataFrame, day_name: str, as_of: dt.date, keep_days: int = 90) -> DataFrame:
    """Rows of the last ``keep_days`` days: a partition filter on such a layout."""
    return df.filter(F.col(day_name) >= F.lit(as_of - dt.timedelta(days=keep_days)))
