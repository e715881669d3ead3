"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Settings every job here relies on; a cluster's own values win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "mirrorspan", cores: str | int = "*", **extra) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
        .config("spark.sql.shuffle.partitions", extra.pop("shuffle_partitions", "8"))
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_made: list[str] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``.

    Where that is unset, on a local master alone, it lies in the warehouse. Such
    folders are removed when the process ends; :func:`drop_scratch` removes all
    that this process has asked for.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        base = _warehouse_scratch(spark.conf.get("spark.sql.warehouse.dir"))
    _made.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def materialized(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read from there: its lineage is
    cut, it survives the loss of executors, and it is computed once."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the scratch folders of this process; frames read from them are void."""
    dropped = 0
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        dropped += bool(fs.delete(path, True))
    return dropped


@functools.cache
def _warehouse_scratch(warehouse: str) -> str:
    folder = f"{warehouse.removeprefix('file:').rstrip('/')}/scratch-{uuid.uuid4().hex[:12]}"
    folder = os.path.abspath("/" + folder.lstrip("/") if folder.startswith("//") else folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def local_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small driver-side list (settings, names, ledger rows) as a DataFrame.

    Built from Arrow it is a local relation: the optimizer knows its size and
    broadcasts it, which it would not do for an RDD of Python rows.
    """
    schema = StructType.fromDDL(ddl)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)
