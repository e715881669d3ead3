"""Column quality from sketches that are kept for each partition and merged.

For each partition and column: rows, NULLs, least and greatest value, an HLL sketch of
the distinct values, and a KLL sketch of numbers for quantiles. All of these merge, so the
quality of any set of partitions is a merge of a few rows. When a table is refreshed, only
the partitions that it replaced are looked at again.

Distinct counts are off by some 1.6 % (HLL with 2^12 registers); a quantile's rank by
1.65 % (KLL with k = 200).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from mirrorspan.sources.store import TableStore

PART = "sketch_part"
QUANTILES = (0.25, 0.5, 0.75)
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def partition_sketches(df: DataFrame, part: str) -> DataFrame:
    """One row for each value of ``part`` and each other column that sketches can hold."""
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    none = F.lit(None)
    for i, f in enumerate(df.schema.fields):
        if f.name == part or isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            continue
        value = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, _NUMBERS)
        # Decimals and binary fractions are told apart by their text.
        hashed = value if isinstance(f.dataType, (T.IntegerType, T.LongType, T.StringType)) else value.cast("string")
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.hll_sketch_agg(hashed).alias(f"h{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
        ]
        if number:
            aggs.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"k{i}"))
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), "rows", (F.col("rows") - F.col(f"n{i}")).alias("null_rows"),
            (F.col(f"lo{i}").cast("double") if number else none.cast("double")).alias("low_number"),
            (F.col(f"hi{i}").cast("double") if number else none.cast("double")).alias("high_number"),
            (none.cast("string") if number else F.col(f"lo{i}").cast("string")).alias("low_text"),
            (none.cast("string") if number else F.col(f"hi{i}").cast("string")).alias("high_text"),
            F.col(f"h{i}").alias("distinct_sketch"),
            (F.col(f"k{i}") if number else none.cast("binary")).alias("quantile_sketch"),
        ))
    return df.groupBy(part).agg(*aggs).select(F.col(part).alias(PART), F.inline(F.array(*rows)))


def merged_quality(sketches: DataFrame) -> DataFrame:
    """Quality of all the partitions in ``sketches`` together, a row a column."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_rows").alias("null_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.min("low_number").alias("low_number"), F.max("high_number").alias("high_number"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"),
    )
    # A sketch without values has no quantiles.
    held = F.kll_sketch_get_n_double("_quantiles") > 0
    quantiles = [
        F.when(held, F.kll_sketch_get_quantile_double("_quantiles", F.lit(q))).alias(f"q{int(100 * q)}")
        for q in QUANTILES
    ]
    return merged.select(
        "column_name", "rows", "null_rows", "distinct_values", "low_number", "high_number", "low_text",
        "high_text", *quantiles,
    )


def follow_quality(store: TableStore, table: str, name: str) -> int:
    """Brings the sketches of a partitioned table, kept as table ``name``, up to its version.

    Returns the partitions that were read, those alone which changed since.
    """
    snap = store.snapshot(table)
    if snap.partition_by is None:
        raise ValueError(f"{table} has no partitions")
    mark = f"version of {table}"
    seen = store.snapshot(name).batches.get(mark) if store.exists(name) else None
    if seen == snap.version:
        return 0
    changed = None
    if seen is not None:
        try:
            changed = store.changes(table, seen).partitions
        except FileNotFoundError:  # that version is gone: all anew
            changed = None
    only: Callable[[str], bool] | None = None if changed is None else changed.__contains__
    rows = store.read(table, only, keep_partition=True)
    made = partition_sketches(rows, snap.partition_by).withColumn("_folder", F.col(PART))
    if changed is None:
        store.overwrite(name, made, "_folder", batch={mark: snap.version})
        return len(snap.partitions)
    store.replace(name, [made], only, batch={mark: snap.version})
    return len(changed)


def read_quality(store: TableStore, name: str, parts: Sequence[str] | None = None) -> DataFrame:
    """Quality over some partitions of the table (all by default), from its sketches."""
    only = None if parts is None else set(parts).__contains__
    return merged_quality(store.read(name, only))
