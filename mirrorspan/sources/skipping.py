"""Skipping index: which folders of a table can hold a key.

Every staged write leaves, beside its folders, a small table with, for each folder,
the least and greatest value of the first key column and a Bloom filter of whole keys.
The filter is split into blocks of ``BITS`` bits; a key sets ``HASHES`` bits of one
block, and a folder has as many blocks (a power of two) as its keys ask for. Building
and asking are grouping and joining with built-in expressions.

A folder that isn't named can't hold any of the keys; one that is named holds one but
for a false positive, some 2 % of the keys with the bits spent here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mirrorspan.functions.dates import ntz
from mirrorspan.operators.joins import KeySet
from mirrorspan.session import materialized

FOLDER = "_skipping"
PART = "_part"
# Bits of a block: the size of Spark's bitmaps.
BITS = 32_768
HASHES = 4
BITS_A_KEY = 10
# Sets of more keys hit nearly every filter: then only the range skips.
MOST_KEYS = 2_000_000


def _hash(columns: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """The key as 64 bits. Whole numbers of any width hash alike."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    values = [
        F.col(f"`{c}`").cast("long") if isinstance(t, whole) else F.col(f"`{c}`").cast(t)
        for c, t in zip(columns, types)
    ]
    return F.xxhash64(*values)


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BITS)) for k in range(HASHES)]


def build(keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(part, low, high, blocks, block, bitmap) of the folders of ``keys``.

    ``keys`` has the folder's value as ``PART``; rows with a NULL in the key match nothing.
    """
    types = [keys.schema[c].dataType for c in columns]
    known = keys.dropna(subset=list(columns)).select(
        PART, F.col(f"`{columns[0]}`").alias("first"), _hash(columns, types).alias("key")
    )
    sizes = known.groupBy(PART).agg(
        F.min("first").alias("low"), F.max("first").alias("high"),
        F.approx_count_distinct("key").alias("n"),
    )
    wanted = F.greatest(F.lit(1.0), F.col("n") * BITS_A_KEY / BITS)
    sizes = sizes.withColumn("blocks", F.pow(2.0, F.ceil(F.log2(wanted))).cast("long")).drop("n")
    # Joined twice: the keys are read once for them.
    sizes = materialized(sizes, "skipping-sizes")
    placed = (
        # One row for each folder; the manifest lists them on the driver as well.
        known.join(
            F.broadcast(sizes.select(F.col(PART).alias("_own"), "blocks")),
            F.col(PART).eqNullSafe(F.col("_own")),
        )
        .select("_own", F.pmod("key", "blocks").alias("block"), "key")
        # A block's keys meet before they are sorted, in parts of one size, whatever the
        # files'; else every task would sort its file's keys and send a bitmap of each block.
        .hint("rebalance", "_own", "block")
    )
    bits = [F.bitmap_construct_agg(b).alias(f"bits{k}") for k, b in enumerate(_bits(F.col("key")))]
    filters = (
        placed.groupBy("_own", "block").agg(*bits)
        .select("_own", "block", F.explode(F.array(*(f"bits{k}" for k in range(HASHES)))).alias("bits"))
        .groupBy("_own", "block").agg(F.bitmap_or_agg("bits").alias("bitmap"))
    )
    return (
        filters.join(sizes, F.col(PART).eqNullSafe(F.col("_own")))
        .select(PART, "low", "high", "blocks", "block", "bitmap")
    )


def parts(index: DataFrame, keys: KeySet, types: Sequence[T.DataType]) -> set[str | None]:
    """Folders that may hold one of the measured ``keys``; the key's columns have ``types``."""
    if keys.low is None:
        return set()
    first = index.schema["low"].dataType
    literal = ntz if isinstance(first, T.TimestampNTZType) else F.lit
    near = index.filter(
        (F.col("low") <= literal(keys.high)) & (F.col("high") >= literal(keys.low))
    )
    if keys.rows is not None and keys.rows <= MOST_KEYS:
        # Powers of two: a few dozen at most.
        blocks = [r[0] for r in near.select("blocks").distinct().collect()]
        if not blocks:
            return set()
        asked = keys.df.select(
            F.col(f"`{keys.columns[0]}`").cast(first).alias("first"),
            _hash(keys.columns, types).alias("key"),
        ).distinct()
        asked = asked.select(
            "first", "key", F.explode(F.array(*map(F.lit, blocks))).alias("blocks")
        ).withColumn("block", F.pmod("key", "blocks"))
        near = near.join(asked, ["blocks", "block"]).filter(
            F.col("first").between(F.col("low"), F.col("high"))
        )
        for bit in _bits(F.col("key")):
            octet = F.substring(F.col("bitmap"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
            octet = F.conv(F.hex(octet), 16, 10).cast("long")
            near = near.filter(F.getbit(octet, F.pmod(bit, F.lit(8)).cast("int")) == 1)
    return {r[0] for r in near.select(PART).distinct().collect()}
