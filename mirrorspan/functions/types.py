"""Source column types to Spark types, as a driver function and as a Column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Source base type -> class of the stored column.
TYPE_CLASSES = {
    "integer": ("tinyint", "smallint", "mediumint", "int", "integer", "bigint", "year"),
    "float": ("float", "double"),
    "decimal": ("decimal", "numeric"),
    "string": ("char", "varchar", "text", "tinytext", "mediumtext", "longtext", "enum", "set", "json"),
    "date": ("date",),
    "time": ("time",),
    "datetime": ("datetime",),
    "timestamp": ("timestamp",),
    "binary": ("binary", "varbinary", "blob", "tinyblob", "mediumblob", "longblob"),
    "boolean": ("bit", "boolean", "bool"),
}

# Spark type name stored for each class; times are kept as HH:mm:ss text and
# a datetime has no zone.
SPARK_TYPES = {
    "integer": "bigint",
    "float": "double",
    "decimal": "decimal(38,9)",
    "string": "string",
    "date": "date",
    "time": "string",
    "datetime": "timestamp_ntz",
    "timestamp": "timestamp",
    "binary": "binary",
    "boolean": "boolean",
}

# Class of a column in the type histogram.
HISTOGRAM_CLASSES = {
    "integer": "integers",
    "float": "floats",
    "decimal": "floats",
    "string": "strings",
    "date": "dates",
    "time": "dates",
    "datetime": "dates",
    "timestamp": "dates",
    "binary": "others",
    "boolean": "booleans",
}

_BASE_TO_SPARK = {
    base: SPARK_TYPES[cls] for cls, names in TYPE_CLASSES.items() for base in names
}
_DECIMAL = re.compile(r"^(?:decimal|numeric)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


def base_type(source_type: str) -> str:
    """Lower-case type word without width, precision or ``unsigned``."""
    head = source_type.strip().lower().split("(", 1)[0].split()
    return head[0] if head else ""


def map_type(source_type: str) -> str:
    """Spark type name that stores ``source_type``; unknown types become text."""
    full = source_type.strip().lower()
    if "tinyint(1)" in full:
        return "boolean"
    sized = _DECIMAL.match(full)
    if sized:
        precision, scale = int(sized[1]), int(sized[2] or 0)
        if precision <= 38:
            return f"decimal({precision},{scale})"
    return _BASE_TO_SPARK.get(base_type(full), "string")


def base_type_column(source_type: Column) -> Column:
    head = F.trim(F.substring_index(F.lower(F.trim(source_type)), "(", 1))
    return F.substring_index(head, " ", 1)


def map_type_column(source_type: Column) -> Column:
    """:func:`map_type` evaluated by Spark over a column of type texts."""
    full = F.lower(F.trim(source_type))
    known = F.create_map(*[F.lit(x) for pair in _BASE_TO_SPARK.items() for x in pair])
    size = r"^(?:decimal|numeric)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)"
    precision, scale = F.regexp_extract(full, size, 1), F.regexp_extract(full, size, 2)
    sized = F.concat(
        F.lit("decimal("),
        precision,
        F.lit(","),
        F.when(scale == "", F.lit("0")).otherwise(scale),
        F.lit(")"),
    )
    return (
        F.when(full.contains("tinyint(1)"), "boolean")
        .when((precision != "") & (precision.try_cast("int") <= 38), sized)
        .otherwise(F.coalesce(F.try_element_at(known, base_type_column(source_type)), F.lit("string")))
    )


def histogram_class(type_text: Column) -> Column:
    """strings / integers / floats / dates / booleans / others, for a source
    type or a Spark type. Unknown source types are stored as text."""
    words = {
        base: HISTOGRAM_CLASSES[cls] for cls, names in TYPE_CLASSES.items() for base in names
    } | {"timestamp_ntz": "dates"}
    known = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return (
        F.when(F.lower(type_text).contains("tinyint(1)"), "booleans")
        .when(type_text.contains("<"), "others")
        .otherwise(F.coalesce(F.try_element_at(known, base_type_column(type_text)), F.lit("strings")))
    )


def target_schema(columns: Sequence[tuple[str, str]]) -> T.StructType:
    """All-nullable schema for (name, source type) pairs; the comment keeps the source type."""
    return T.StructType(
        [
            T.StructField(
                name, T.DataType.fromDDL(map_type(source)), True, {"comment": f"source: {source}"}
            )
            for name, source in columns
        ]
    )


def all_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def cast_to_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Project ``df`` by name onto ``schema``; columns it lacks become NULL.

    ``strict`` fails the job on the first value that does not fit; otherwise
    such values become NULL (count them first with :func:`cast_rejects`).
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        name = have.get(field.name.lower())
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[name].dataType == field.dataType:
            value = F.col(f"`{name}`")
        elif strict:
            value = _strict_cast(df, F.col(f"`{name}`"), field)
        else:
            value = F.col(f"`{name}`").try_cast(field.dataType)
        out.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def _strict_cast(df: DataFrame, value: Column, field: T.StructField) -> Column:
    """The cast value; a value that does not fit, or would lose something, fails the job."""
    old = df.schema[[c for c in df.columns if c.lower() == field.name.lower()][0]].dataType
    message = F.concat(F.lit(f"CAST_INVALID_INPUT {field.name}: "), value.cast("string"))
    fails = cast_fails(value, old, field.dataType)
    return F.when(~fails, value.try_cast(field.dataType)).otherwise(F.raise_error(message))


# Largest value of the integer types.
_INT_MAX = {T.ByteType: 2**7 - 1, T.ShortType: 2**15 - 1, T.IntegerType: 2**31 - 1, T.LongType: 2**63 - 1}


_NUMBERS = (*_INT_MAX, T.FloatType, T.DoubleType, T.DecimalType)
_INSTANTS = (T.TimestampType, T.TimestampNTZType)


def cast_fails(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """True where a present value of type ``old`` cannot be cast to ``new``, or not
    without loss: numbers and instants must come back the same. Never null.

    Between integer types this is a range test: a failing ``try_cast`` costs
    an exception per row.
    """
    if type(old) in _INT_MAX and type(new) in _INT_MAX:
        high = _INT_MAX[type(new)]
        if _INT_MAX[type(old)] <= high:
            return F.lit(False)
        return value.isNotNull() & ~value.between(F.lit(-high - 1), F.lit(high))
    cast = value.try_cast(new)
    fails = value.isNotNull() & cast.isNull()
    numbers = isinstance(old, _NUMBERS) and isinstance(new, _NUMBERS)
    if numbers or (isinstance(old, _INSTANTS) and isinstance(new, T.DateType)):
        fails = fails | ~value.eqNullSafe(cast.try_cast(old))
    return fails


def cast_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column: values present in ``df`` that the schema cannot hold."""
    have = {c.lower(): c for c in df.columns}
    fields = [f for f in schema.fields if f.name.lower() in have]
    counts = []
    for i, field in enumerate(fields):
        value = F.col(f"`{have[field.name.lower()]}`")
        old = df.schema[have[field.name.lower()]].dataType
        counts.append(F.count_if(cast_fails(value, old, field.dataType)).alias(f"r{i}"))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("target_type"),
            F.col(f"r{i}").alias("rejected"),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))
