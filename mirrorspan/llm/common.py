"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirrorspan.session import scratch_dir

# White space by code point, not by what a regex library calls a space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialized(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read from there.

    It cuts the lineage, survives the loss of executors, and pins whatever is
    not repeatable (row numbers, samples).
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of ``text``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(
    df: DataFrame, order: list[Column], sums: dict[str, Column], label: str
) -> DataFrame:
    """Adds, per name in ``sums``, the sum over all rows before this one in ``order``.

    Rows are range partitioned and summed within their partition; only one row
    per partition meets in a single task. ``order`` must be total, or rows that
    tie must be interchangeable.
    """
    values = {f"_value_{name}": value for name, value in sums.items()}
    parted = materialized(
        df.withColumns(values)
        .repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id()),
        label,
    )
    parts = parted.groupBy("_part").agg(*(F.sum(c).alias(c) for c in values))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_part",
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before{c}") for c in values),
    )
    before = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = {
        f"_local{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in values
    }
    return (
        parted.withColumns(local)
        .join(F.broadcast(parts), "_part")  # one row per partition
        .select(
            *df.columns,
            *(
                (F.col(f"_local_value_{name}") + F.col(f"_before_value_{name}")).alias(name)
                for name in sums
            ),
        )
    )
