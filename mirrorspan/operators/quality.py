"""Counts, run ledger, parity, drift, freshness and column quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from mirrorspan.functions.clean import interval_micros
from mirrorspan.functions.dates import ntz
from mirrorspan.sources.catalog import union_all
from mirrorspan.sources.scan import chunk_rows_column

# Columns of the ledgers.
LEDGER_SCHEMA = "run_id string, table_name string, rows bigint, status string"
WATERMARK_SCHEMA = (
    "database_name string, table_name string, watermark_column string, "
    "last_value timestamp_ntz, updated_at timestamp_ntz, status string"
)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    )


def query_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def page_counts(counts: DataFrame) -> DataFrame:
    """Pages per table, by the chunk rows of its size class."""
    sized = counts.withColumn("chunk_rows", chunk_rows_column(F.col("rows")).cast("bigint"))
    return sized.withColumn("pages", F.ceil(F.col("rows") / F.col("chunk_rows")).cast("bigint"))


def logical_bytes(df: DataFrame) -> Column:
    """Size of a row's values: text and binary by length, fixed types by width."""
    # Bytes of fixed-width types; others count as 8.
    widths = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
              T.FloatType: 4, T.DateType: 4}
    parts = ["0L"]
    for f in df.schema.fields:
        value = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = f"octet_length({value})"
        elif isinstance(f.dataType, T.ArrayType):
            size = f"size({value}) * {widths.get(type(f.dataType.elementType), 8)}"
        else:
            size = str(widths.get(type(f.dataType), 8))
        parts.append(f"CAST(if({value} IS NULL, 0, {size}) AS bigint)")
    return F.expr(" + ".join(parts))


def table_size(df: DataFrame, measure: str = "files") -> DataFrame:
    """Rows and bytes of a table as one row.

    ``files`` adds up the sizes of the files behind ``df`` without reading a
    column; ``values`` measures the values themselves, for any source.
    """
    if measure == "values":
        total = F.coalesce(F.sum(logical_bytes(df)), F.lit(0)).alias("bytes")
        return df.agg(F.count(F.lit(1)).alias("rows"), total)
    files = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    )
    per_file = files.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    none = F.lit(0)
    return per_file.agg(
        F.coalesce(F.sum("n"), none).alias("rows"), F.coalesce(F.sum("size"), none).alias("bytes")
    )


def largest_tables(tables: Mapping[str, DataFrame], n: int = 20, measure: str = "files") -> DataFrame:
    """Tables by row count, largest first (a top-n report)."""
    sizes = union_all(
        table_size(df, measure).select(F.lit(name).alias("table_name"), "rows", "bytes")
        for name, df in tables.items()
    )
    return sizes.orderBy(F.col("rows").desc(), F.col("table_name")).limit(n)


# -- ledger ---------------------------------------------------------------


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Per run: rows, tables, tables that loaded rows, and the run's status."""
    loaded = F.count_if((F.col("status") == "SUCCESS") & (F.col("rows") > 0))
    return ledger.groupBy("run_id").agg(
        F.sum("rows").alias("total_rows"),
        F.count(F.lit(1)).alias("tables"),
        loaded.alias("successful_tables"),
        F.count_if(F.col("status") == "FAILED").alias("failed_tables"),
        F.when(F.sum("rows") > 0, "success").otherwise("warning").alias("run_status"),
    )


def merge_ledgers(first: DataFrame, later: DataFrame) -> DataFrame:
    """Rows of both; where a run has a table in both, the later ledger counts."""
    keys = ["run_id", "table_name"]
    return first.join(later.select(*keys), keys, "left_anti").unionByName(later)


def below_threshold(ledger: DataFrame, min_rows: int) -> DataFrame:
    """Loads that did not get past ``min_rows``."""
    return ledger.filter(F.col("rows") <= min_rows)


def ledger_failures(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == "FAILED")


def row_count_anomaly(previous: DataFrame, current: DataFrame, max_change: float = 0.5) -> DataFrame:
    """Tables whose row count moved by more than the given share between runs.

    A table that the current run lacks counts as empty there.
    """
    p = previous.select("table_name", F.col("rows").alias("previous_rows"))
    c = current.select("table_name", F.col("rows").alias("current_rows"), F.lit(True).alias("ran"))
    moved = F.abs(F.col("current_rows") - F.col("previous_rows"))
    change = F.when(F.col("previous_rows") > 0, moved / F.col("previous_rows"))
    appeared = (F.col("previous_rows") == 0) & (F.col("current_rows") > 0)
    return (
        p.join(c, "table_name", "left")
        .fillna(0, ["current_rows"])
        .withColumn("change", F.round(change, 4))
        .filter((change > max_change) | appeared | F.col("ran").isNull())
        .drop("ran")
    )


def _middle(values: Column) -> Column:
    """Median of an array, that of an even number being the mean of the two in the middle."""
    ordered, n = F.array_sort(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / F.lit(2.0)


def seasonal_anomaly(
    runs: DataFrame, past: int = 8, least_past: int = 3, deviations: float = 4.0, floor: float = 0.05
) -> DataFrame:
    """Runs whose row count lies far from what the same weekday had before.

    ``runs`` has table_name, run_date and rows. A run is compared with the median of at
    most ``past`` earlier runs of its table on the same weekday, if there are ``least_past``.
    It is anomalous if it is off by more than ``deviations`` times the deviation to be
    expected: 1.4826 times the median of the absolute deviations, or a share ``floor`` of
    the median if that is more, so that a table that never changes may do so a little.
    Medians are not moved by earlier anomalies, as means are.
    """
    frame = (
        Window.partitionBy("table_name", F.weekday("run_date"))
        .orderBy("run_date").rowsBetween(-past, -1)
    )
    # A frame holds ``past`` counts at most.
    before = runs.withColumn("_past", F.collect_list(F.col("rows").cast("double")).over(frame))
    centre = _middle(F.col("_past"))
    measured = before.filter(F.size("_past") >= least_past).withColumn("expected_rows", centre)
    off = F.transform("_past", lambda x: F.abs(x - F.col("expected_rows")))
    spread = F.greatest(_middle(off) * 1.4826, F.col("expected_rows") * floor)
    score = F.when(spread > 0, F.abs(F.col("rows") - F.col("expected_rows")) / spread).when(
        F.col("rows") == F.col("expected_rows"), 0.0
    ).otherwise(float("inf"))
    return (
        measured.withColumn("score", score)
        .select(
            "table_name", "run_date", "rows", "expected_rows", F.round("score", 4).alias("score"),
            (F.col("score") > deviations).alias("anomalous"),
        )
    )


# -- source against copy ----------------------------------------------------


def count_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides per table; a table only one side has counts 0 there."""
    s = source.select("table_name", F.col("rows").alias("source_rows"))
    t = target.select("table_name", F.col("rows").alias("target_rows"))
    both = s.join(t, "table_name", "full_outer").fillna(0, ["source_rows", "target_rows"])
    diff = F.col("target_rows") - F.col("source_rows")
    return both.withColumn("difference", diff).withColumn("equal", diff == 0)


def sync_drift(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key and kind of every difference between a source and its copy, as bags.

    missing (source only), ghost (copy only), duplicate (copy holds the key
    more often), fewer (less often), changed (as often, with other values). Both
    sides go through one grouping by key. Instead of the columns it sums two 31-bit
    hashes of them, added for the source and taken away for the copy: they cancel
    out exactly if every row is on both sides equally often.
    """
    values = [c for c in source.columns if c not in key]

    def side(df: DataFrame, sign: int) -> DataFrame:
        cols = [F.col(f"`{c}`") for c in values]
        # The NULL flags keep (NULL, x) and (x, NULL) apart; hashes skip NULLs.
        flags = [c.isNull() for c in cols]
        limit = F.lit(2**31 - 1)
        return df.select(
            *key,
            (F.pmod(F.xxhash64(F.lit(1), *cols, *flags), limit) * sign).alias("h1"),
            (F.pmod(F.xxhash64(F.lit(2), *reversed(cols), *flags), limit) * sign).alias("h2"),
            F.lit(sign).alias("side"),
        )

    grouped = (
        side(source, 1)
        .unionByName(side(target, -1))
        .groupBy(*key)
        .agg(
            F.count_if(F.col("side") == 1).alias("source_copies"),
            F.count_if(F.col("side") == -1).alias("target_copies"),
            F.sum("h1").alias("left1"),
            F.sum("h2").alias("left2"),
        )
    )
    drift = (
        F.when(F.col("target_copies") == 0, "missing")
        .when(F.col("source_copies") == 0, "ghost")
        .when(F.col("target_copies") > F.col("source_copies"), "duplicate")
        .when(F.col("target_copies") < F.col("source_copies"), "fewer")
        .when((F.col("left1") != 0) | (F.col("left2") != 0), "changed")
    )
    return grouped.select(*key, drift.alias("drift")).filter(F.col("drift").isNotNull())


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of_ts, max_hours: int = 13) -> DataFrame:
    """Age of the newest row of each (table, timestamp column)."""
    as_of = ntz(as_of_ts)
    newest = union_all(
        df.agg(F.max(F.col(c)).cast("timestamp_ntz").alias("newest")).select(
            F.lit(name).alias("table_name"), "newest"
        )
        for name, (df, c) in tables.items()
    )
    # A difference of zone-less timestamps does not depend on the session's zone.
    age = interval_micros(as_of - F.col("newest"))
    hour = 3_600_000_000
    return newest.withColumn("age_hours", F.floor(age / hour).cast("bigint")).withColumn(
        "stale", age > max_hours * hour
    )


def watermark_ledger(
    tables: Mapping[tuple[str, str], tuple[DataFrame, str]], updated_at
) -> DataFrame:
    """Highest watermark per (database, table) and column."""
    return union_all(
        df.agg(F.max(F.col(c)).cast("timestamp_ntz").alias("last_value")).select(
            F.lit(db).alias("database_name"),
            F.lit(name).alias("table_name"),
            F.lit(c).alias("watermark_column"),
            "last_value",
            ntz(updated_at).alias("updated_at"),
            F.when(F.col("last_value").isNull(), "EMPTY").otherwise("SUCCESS").alias("status"),
        )
        for (db, name), (df, c) in tables.items()
    )


def column_quality(df: DataFrame, table: str, exact_distinct: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values, least and greatest value (as text) per column.

    One pass with a sketch for the distinct counts. ``exact_distinct`` instead
    counts (column, value) pairs: a hot value is combined before the shuffle,
    and texts travel as digests.
    """
    fields = df.schema.fields
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(fields):
        value = F.col(f"`{f.name}`")
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
        ]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(value).alias(f"d{i}"))
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("null_rows"),
                (F.lit(None).cast("bigint") if exact_distinct else F.col(f"d{i}")).alias("distinct_values"),
                F.col(f"lo{i}").cast("string").alias("min_value"),
                F.col(f"hi{i}").cast("string").alias("max_value"),
            )
        )
    out = df.agg(*aggs).select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))
    if not exact_distinct:
        return out
    pairs = F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), _compact(F.col(f"`{f.name}`"), f.dataType).alias("value"))
            for f in fields
        ]
    )
    distinct = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("exact"))
    )
    return (
        out.join(F.broadcast(distinct), "column_name", "left")  # one row per column
        .withColumn("distinct_values", F.coalesce("exact", F.lit(0).cast("bigint")))
        .select("table_name", "column_name", "rows", "null_rows", "distinct_values", "min_value", "max_value")
    )


def _compact(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.sha2(value, 256)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(kind)  # -0.0 and 0.0 are one value
    return value.cast("string")
