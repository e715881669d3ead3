"""Schema evolution: additive, existing types win, copy-only columns stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from mirrorspan.functions.types import all_nullable, cast_fails, cast_to_schema, map_type_column

# Conflict policies.
USE_EXISTING = "use_existing"
MOST_PERMISSIVE = "use_most_permissive"
FAIL = "fail"

# Decimal digits of the integer types, narrow to wide.
_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaConflict(ValueError):
    pass


def reconcile(existing: T.StructType | None, new: T.StructType, policy: str = USE_EXISTING) -> T.StructType:
    """Schema to write when rows of ``new`` meet a table of ``existing``.

    Order: the columns of ``new``, then the columns only the table has. A
    shared column stays required only if the table requires it; a column the
    table lacks is nullable. Names match without regard to case and keep the
    table's spelling.
    """
    if existing is None:
        return all_nullable(new)
    known = {f.name.lower(): f for f in existing.fields}
    fields = []
    for f in new.fields:
        old = known.pop(f.name.lower(), None)
        if old is None:
            fields.append(T.StructField(f.name, f.dataType, True, f.metadata))
            continue
        same_mode = old.nullable == f.nullable
        kind = old.dataType if old.dataType == f.dataType else _resolve(old, f, policy)
        fields.append(T.StructField(old.name, kind, old.nullable, old.metadata if same_mode else f.metadata))
    return T.StructType(fields + list(known.values()))


def _resolve(old: T.StructField, new: T.StructField, policy: str) -> T.DataType:
    if policy == USE_EXISTING:
        return old.dataType
    if policy == FAIL:
        raise SchemaConflict(
            f"{old.name}: {old.dataType.simpleString()} in the table, {new.dataType.simpleString()} in the source"
        )
    if policy == MOST_PERMISSIVE:
        return widest(old.dataType, new.dataType)
    raise ValueError(f"unknown policy {policy!r}")


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both; text when nothing narrower does."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= {*_INTEGERS, T.FloatType, T.DoubleType}:
        # A float holds 24 bits of a whole number, a double 53.
        if T.DoubleType in kinds or T.FloatType in kinds:
            if T.LongType in kinds:
                return T.StringType()
            small = kinds <= {T.ByteType, T.ShortType, T.FloatType}
            return T.FloatType() if small else T.DoubleType()
        return max((a, b), key=lambda t: _INTEGERS[type(t)])
    if kinds <= {*_INTEGERS, T.DecimalType}:
        whole, scale = zip(*((t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType)
                             else (_INTEGERS[type(t)], 0) for t in (a, b)))
        if max(whole) + max(scale) <= 38:
            return T.DecimalType(max(whole) + max(scale), max(scale))
    dates = (T.DateType, T.TimestampNTZType)
    if isinstance(a, dates) and isinstance(b, dates):
        return T.TimestampNTZType()
    return T.StringType()


def evolve_union(existing: DataFrame, new: DataFrame, strict: bool = True,
                 policy: str = USE_EXISTING) -> DataFrame:
    """Rows of both under the reconciled schema, missing columns NULL."""
    schema = reconcile(existing.schema, new.schema, policy)
    return cast_to_schema(existing, schema, strict).unionByName(cast_to_schema(new, schema, strict))


# -- the same decisions over two column catalogs -----------------------------
# A catalog has column_name, full_type and nullable (measured or declared).


def reconcile_catalogs(existing: DataFrame, new: DataFrame, policy: str = USE_EXISTING) -> DataFrame:
    """One row per column of either side with the resulting type and mode."""
    return _reconciled(existing, new, policy).drop("source_nullable")


def _reconciled(existing: DataFrame, new: DataFrame, policy: str) -> DataFrame:
    old = existing.select(
        "column_name",
        F.col("full_type").alias("existing_type"),
        F.col("nullable").alias("existing_nullable"),
    )
    source = new.select(
        "column_name",
        F.col("full_type").alias("new_type"),
        F.col("nullable").alias("source_nullable"),
    )
    conflict = F.col("existing_type") != F.col("new_type")  # NULL unless in both
    kept = F.coalesce("existing_type", "new_type")
    result = kept
    if policy == MOST_PERMISSIVE:
        result = F.when(conflict, wider_type(F.col("existing_type"), F.col("new_type"))).otherwise(kept)
    elif policy == FAIL:
        result = F.when(conflict, F.lit(None).cast("string")).otherwise(kept)
    status = (
        F.when(F.col("existing_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "kept")
        .when(conflict, "conflict")
        .otherwise("same")
    )
    return old.join(source, "column_name", "full_outer").select(
        "column_name",
        "existing_type",
        "new_type",
        result.alias("result_type"),
        F.coalesce("existing_nullable", F.lit(True)).alias("result_nullable"),
        status.alias("status"),
        "source_nullable",
    )


def wider_type(a, b):
    """:func:`widest` for the columns of a catalog: looked up, but for decimals."""
    plain = [t() for t in (*_INTEGERS, T.FloatType, T.DoubleType, T.DateType, T.TimestampNTZType)]
    known = F.create_map(*(
        F.lit(x)
        for one in plain
        for other in plain
        for x in (f"{one.simpleString()}|{other.simpleString()}", widest(one, other).simpleString())
    ))
    digits = F.create_map(*(F.lit(x) for t, n in _INTEGERS.items() for x in (t().simpleString(), n)))
    size = r"^decimal\((\d+),(\d+)\)$"

    def part(kind, group):
        return F.regexp_extract(kind, size, group).try_cast("int")

    def whole(kind):
        return F.coalesce(part(kind, 1) - part(kind, 2), F.try_element_at(digits, kind))

    scale = F.greatest(part(a, 2), part(b, 2))  # null unless one is a decimal
    total = F.when(whole(a).isNotNull() & whole(b).isNotNull(), F.greatest(whole(a), whole(b)) + scale)
    sized = F.when(total <= 38, F.format_string("decimal(%d,%d)", total, scale))
    return F.coalesce(
        F.when(a == b, a), sized, F.try_element_at(known, F.concat_ws("|", a, b)), F.lit("string")
    )


def added_columns(existing: DataFrame, new: DataFrame) -> DataFrame:
    return new.join(existing.select("column_name"), "column_name", "left_anti")


def add_columns_to_table(spark: SparkSession, table: str, new: T.StructType) -> bool:
    """Add the columns a catalog table lacks; True if there were any.

    Rows already there read NULL. Types of existing columns are left alone.
    """
    have = {c.lower() for c in spark.table(table).columns}
    missing = [f for f in new.fields if f.name.lower() not in have]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return bool(missing)


def mode_changes(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Columns whose mode in the source differs from the reconciled one."""
    return (
        _reconciled(existing, new, USE_EXISTING)
        .filter(F.col("source_nullable") != F.col("result_nullable"))
        .select("column_name", "source_nullable", "result_nullable")
    )


def required_null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """NULLs in columns that must always have a value (files do not enforce it)."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(required)]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col("rows"), F.col(f"n{i}").alias("null_rows"))
        for i, c in enumerate(required)
    ]
    return df.agg(F.count(F.lit(1)).alias("rows"), *counts).select(F.inline(F.array(*rows)))


def precision_loss_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Values that change (or do not fit at all) when stored under ``schema``."""
    have = {f.name.lower(): f for f in df.schema.fields}
    fields = [f for f in schema.fields if f.name.lower() in have]
    counts, rows = [], []
    for i, f in enumerate(fields):
        old = have[f.name.lower()]
        value = F.col(f"`{old.name}`")
        if type(old.dataType) in _INTEGERS and type(f.dataType) in _INTEGERS:
            changed = cast_fails(value, old.dataType, f.dataType)
        else:
            changed = ~value.eqNullSafe(value.try_cast(f.dataType).try_cast(old.dataType))
        counts.append(F.count_if(changed).alias(f"n{i}"))
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(old.dataType.simpleString()).alias("from_type"),
                F.lit(f.dataType.simpleString()).alias("to_type"),
                F.col(f"n{i}").alias("changed_rows"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def schema_comparison(declared: DataFrame, catalog: DataFrame) -> DataFrame:
    """Source type, mapped type and nullability side by side.

    ``declared`` has column_name and source_type.
    """
    return declared.join(
        catalog.select("column_name", "nullable", "non_null_rows"), "column_name"
    ).select(
        "column_name",
        "source_type",
        map_type_column(F.col("source_type")).alias("target_type"),
        "nullable",
        "non_null_rows",
    )
