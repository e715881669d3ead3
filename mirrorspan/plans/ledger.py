"""The run ledger and the watermark ledger as stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from mirrorspan.functions.dates import ntz
from mirrorspan.operators.quality import row_count_anomaly
from mirrorspan.sources.store import TableStore

RUNS = "run_ledger"
WATERMARKS = "watermark_ledger"


def record_run(store: TableStore, ledger: DataFrame, finished_at: dt.datetime | None = None) -> int:
    """Append the rows of a run, with one time for all of them if it is given."""
    if finished_at is None:
        last = ledger.agg(F.max("finished_at")).first()[0]
        finished_at = last or dt.datetime.now()
    return store.append(RUNS, ledger.withColumn("finished_at", ntz(finished_at)))


def record_watermarks(store: TableStore, watermarks: DataFrame) -> int:
    return store.append(WATERMARKS, watermarks)


def last_two_runs(store: TableStore) -> tuple[DataFrame, DataFrame]:
    """(previous, current) rows per table: its two latest runs.

    Done with aggregates rather than a ranking, so no table's whole history
    has to be sorted in one task.
    """
    runs = store.read(RUNS)
    stamp = F.struct("finished_at", "run_id")
    latest = runs.groupBy("table_name").agg(F.max(stamp).alias("last"))
    tagged = runs.withColumn("stamp", stamp).join(latest, "table_name")
    current = tagged.filter(F.col("stamp") == F.col("last"))
    older = tagged.filter(F.col("stamp") < F.col("last"))
    before = older.groupBy("table_name").agg(F.max("stamp").alias("before"))
    previous = older.join(before, "table_name").filter(F.col("stamp") == F.col("before"))
    return previous.select(*runs.columns), current.select(*runs.columns)


def latest_anomalies(store: TableStore, max_change: float = 0.5) -> DataFrame:
    return row_count_anomaly(*last_two_runs(store), max_change)
