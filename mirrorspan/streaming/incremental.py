"""The incremental load as a file stream.

New files of the source are taken in micro-batches and appended, or used to
replace the window they cover, in a versioned table. A replayed batch is
recognised by its id and the id of the query, which its checkpoint keeps; so
restarts neither lose nor repeat rows, and a stream that starts over with a new
checkpoint counts anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from mirrorspan.model import RunContext, Strategy
from mirrorspan.plans.runner import Replicator
from mirrorspan.sources.store import TableStore


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    name_filter: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Process everything that is there, then stop."""
    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_batches(
    store: TableStore, database: str, table: str, stream: str
) -> Callable[[DataFrame, int], None]:
    """Append each batch once to the copy of ``database.table``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = batch_mark(batch, stream)
        run = _batch_run(store, database, Strategy(table), batch, {mark: batch_id})
        if store.applied_batch(run.target(table), mark) < batch_id:
            run.load(table, "append")

    return write


def replace_window_batches(
    store: TableStore, database: str, strategy: Strategy, ctx: RunContext, stream: str
) -> Callable[[DataFrame, int], None]:
    """Delete the window of the copy with the first batch of a run, and insert the
    window's rows of every batch.

    A run is what one ``ctx`` covers: the next day's ``ctx`` deletes its window
    again, whether or not the checkpoint is the same. Without a copy all rows of
    the run are loaded, not only the window.
    """
    if strategy.parent:
        raise ValueError(
            f"{strategy.table}: the window of a child needs its parent; see streaming.children"
        )
    table = strategy.table

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = batch_mark(batch, stream)
        this_run = f"{mark}|{ctx.as_of}|{ctx.lookback_days}"
        whole = f"{this_run}|whole"
        target = _batch_run(store, database, strategy, batch, {}).target(table)
        if store.applied_batch(target, mark) >= batch_id:
            return
        marks = {mark: batch_id, this_run: batch_id}
        loads_all = not store.exists(target) or store.applied_batch(target, whole) >= 0
        if loads_all:
            marks[whole] = batch_id
        run = _batch_run(store, database, strategy, batch, marks)
        if loads_all:
            run.load(table, "append" if store.exists(target) else "overwrite")
        elif store.applied_batch(target, this_run) < 0:
            run.run_table(table, ctx)
        else:
            run.append_window(table, ctx)

    return write


def batch_mark(batch: DataFrame, stream: str) -> str:
    """Names the query that a batch belongs to; without a query, the stream alone."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}@{query}" if query else stream


def _batch_run(store, database, strategy, batch, marks: dict[str, int]) -> Replicator:
    """A replicator whose source is the batch."""
    return Replicator(
        batch.sparkSession, database, lambda _: batch, [strategy.table], store, [strategy],
        batch=marks,
    )


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


__all__ = ["append_batches", "replace_window_batches", "run_to_end", "start", "stream_files"]
