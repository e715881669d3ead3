"""Tables, columns and foreign keys as DataFrames.

``declared_columns`` costs nothing (it only looks at schemas).
``measured_columns`` reads the data once, in one aggregation per table, to
learn what a file cannot declare: whether a column really holds NULLs, and how
long its texts get.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from mirrorspan.functions.types import histogram_class
from mirrorspan.model import Relationship
from mirrorspan.session import local_frame

COLUMNS_SCHEMA = (
    "table_name string, column_name string, ordinal_position int, data_type string, "
    "full_type string, column_default string, comment string, "
    "numeric_precision int, numeric_scale int"
)


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def _precision(t: T.DataType) -> tuple[int | None, int | None]:
    # Decimal digits of the integer types.
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if isinstance(t, T.DecimalType):
        return t.precision, t.scale
    return (digits[type(t)], 0) if type(t) in digits else (None, None)


def _declared_rows(table: str, schema: T.StructType) -> list[tuple]:
    return [
        (
            table,
            f.name,
            i,
            f.dataType.typeName(),
            f.dataType.simpleString(),
            (f.metadata or {}).get("CURRENT_DEFAULT"),
            (f.metadata or {}).get("comment"),
            *_precision(f.dataType),
        )
        for i, f in enumerate(schema.fields, start=1)
    ]


def declared_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of the given tables, from their schemas alone."""
    rows = [r for name, df in tables.items() for r in _declared_rows(name, df.schema)]
    return local_frame(spark, rows, COLUMNS_SCHEMA)


def measured_columns(
    df: DataFrame, table: str, lengths: bool = False, columns: Iterable[str] | None = None
) -> DataFrame:
    """The column catalog of one table with measured nullability and length.

    Only the given ``columns`` are read (all by default; names the table lacks
    are skipped), and their texts only for ``lengths``.
    """
    wanted = None if columns is None else {c.lower() for c in columns}
    names, kinds = zip(*(c.split() for c in COLUMNS_SCHEMA.split(", ")))
    counts, out = ["count(1) AS rows"], []
    for i, (row, f) in enumerate(zip(_declared_rows(table, df.schema), df.schema.fields)):
        if wanted is not None and f.name.lower() not in wanted:
            continue
        value = "`" + f.name.replace("`", "``") + "`"
        counts.append(f"count({value}) AS n{i}")
        length = "CAST(NULL AS int)"
        if lengths and isinstance(f.dataType, T.StringType):
            counts.append(f"max(length({value})) AS l{i}")
            length = f"l{i}"
        declared = ", ".join(f"CAST({_literal(v)} AS {k}) AS {n}" for v, n, k in zip(row, names, kinds))
        out.append(
            f"struct({declared}, n{i} < rows AS nullable, {length} AS max_length, "
            f"rows AS table_rows, n{i} AS non_null_rows)"
        )
    if not out:
        return measured_columns(df.limit(0), table).limit(0)
    # SQL text instead of column calls: wide tables would need thousands of them.
    return df.selectExpr(*counts).selectExpr(f"inline(array({', '.join(out)}))")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def column_catalog(
    tables: Mapping[str, DataFrame],
    lengths: bool = False,
    columns: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Measured catalogs of several tables; ``columns`` limits what is read of each."""
    if columns is None:
        return union_all(measured_columns(df, name, lengths) for name, df in tables.items())
    return union_all(measured_columns(tables[name], name, lengths, cols) for name, cols in columns.items())


def columns_like(df: DataFrame, patterns: Sequence[str]) -> list[str]:
    """Names in the schema of ``df`` that match a LIKE pattern of ``%`` wildcards."""
    regexes = [re.compile(".*".join(map(re.escape, p.split("%"))), re.DOTALL) for p in patterns]
    return [c for c in df.columns if any(r.fullmatch(c) for r in regexes)]


def table_list(tables: Mapping[str, DataFrame], database: str) -> DataFrame:
    """Tables with their row counts (parquet footers answer a bare count)."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(database).alias("database_name"), F.lit(name).alias("table_name"), "rows"
        )
        for name, df in tables.items()
    )


def list_catalog_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a catalog database; empty when the database does not exist."""
    names = []
    if spark.catalog.databaseExists(database):
        names = [(database, t.name) for t in spark.catalog.listTables(database)]
    return local_frame(spark, names, "database_name string, table_name string")


def table_info(
    df: DataFrame, table: str, sample_by: Sequence[str] = (), sample: int = 5
) -> DataFrame:
    """Column count, row count and schema text of one table.

    With ``sample_by`` also its first ``sample`` rows in that order, as JSON texts.
    """
    if sample_by:
        first = df.orderBy(*sample_by).limit(sample)
        place = F.struct(*sample_by)
        rows = first.select(place.alias("place"), F.to_json(F.struct("*")).alias("row"))
        texts = rows.agg(F.sort_array(F.collect_list(F.struct("place", "row"))).alias("rows")).select(
            F.lit(table).alias("table_name"), F.transform("rows", lambda r: r.row).alias("sample")
        )
        return table_info(df, table).join(texts, "table_name")
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.lit(schema).alias("schema_text"),
        "rows",
    )


def fk_catalog(spark: SparkSession, relationships: Sequence[Relationship]) -> DataFrame:
    """One row per foreign-key column, by table, constraint and position."""
    rows = [
        (r.name, r.kind, r.table, c, i, r.ref_table, rc)
        for r in sorted(relationships, key=lambda r: (r.table, r.name))
        for i, (c, rc) in enumerate(zip(r.columns, r.ref_columns), start=1)
    ]
    return local_frame(
        spark,
        rows,
        "constraint_name string, kind string, table_name string, column_name string, "
        "key_position int, referenced_table string, referenced_column string",
    )


def name_like(column: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (column.like(p) for p in patterns))


def key_columns(
    catalog: DataFrame,
    tables: Sequence[str],
    primary_keys: Mapping[str, Sequence[str]],
    patterns: Sequence[str],
) -> DataFrame:
    """Columns of ``tables`` that are primary keys or are named like keys."""
    pri = [
        (F.col("table_name") == t) & F.col("column_name").isin(*cols)
        for t, cols in primary_keys.items()
        if t in tables
    ]
    is_primary = reduce(lambda a, b: a | b, pri) if pri else F.lit(False)
    return (
        catalog.filter(F.col("table_name").isin(*tables))
        .withColumn("column_key", F.when(is_primary, "PRI").otherwise(""))
        .filter(name_like(F.col("column_name"), patterns) | (F.col("column_key") == "PRI"))
        .orderBy("table_name", "column_name")
    )


def required_columns(catalog: DataFrame) -> DataFrame:
    return catalog.filter(~F.col("nullable")).orderBy("table_name", "column_name")


def numbered(df: DataFrame) -> DataFrame:
    """The rows of a small, ordered frame with their ``position`` (from 1) in that order."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_at")).cast("bigint")
    return placed.withColumn("position", position).drop("_at")


def type_histogram(catalog: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Columns per type class for each table; with ``counts`` also its rows."""
    cls = histogram_class(F.col("full_type"))
    classes = [
        F.count_if(F.col("cls") == c).alias(c)
        for c in ("strings", "integers", "floats", "dates", "booleans", "others")
    ]
    histogram = (
        catalog.withColumn("cls", cls)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("columns"), *classes)
    )
    return histogram if counts is None else histogram.join(counts.select("table_name", "rows"), "table_name")


def list_folder_tables(spark: SparkSession, folder: str, suffix: str = ".parquet") -> list[str]:
    """Names of the tables of a folder that holds one file or folder per table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n.removesuffix(suffix) for n in names if n.endswith(suffix))
