"""Discovery of inclusion dependencies: columns whose values all stand in another column.

Names don't tell; the data do.

1. One pass over each table makes, for each column, a bottom-k sketch of its distinct
   values (a theta sketch keeps the least k hashes), its number of rows with a value, and
   its least and greatest value.
2. Pairs are pruned by these: types that compare, a referenced column that can be a key
   (as many distinct values as rows, but for the sketch's error), a range within the other's
   range, and no hash left when the other's sketch is taken off. A sketch holds every hash below
   its bound, so what is included leaves none, however few hashes lie below both bounds.
3. What survives is verified exactly: the distinct values of all surviving columns are
   grouped by value, each with the set of columns that it stands in. A column is included
   in another if each of its values stands in the other; a column is a key if it has as
   many distinct values as rows. One shuffle of distinct values serves all pairs, and a
   hot value is one row before it.

Only what describes columns (a row for each) comes to the driver, never values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mirrorspan.session import local_frame
from mirrorspan.sources.catalog import union_all

# Hashes a sketch keeps (as a power of two); the standard error of its count is 1 / sqrt(4,096).
SKETCH_BITS = 12
# Standard errors by which a key's distinct count may fall short of its rows.
KEY_ERRORS = 8
# Pairs verified by one grouping.
PAIRS_AT_ONCE = 200

# Types whose values compare as one.
_CLASSES = {
    **dict.fromkeys((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "integer"),
    T.StringType: "string", T.DateType: "date", T.TimestampNTZType: "timestamp",
    T.TimestampType: "instant", T.DecimalType: "decimal",
}


@dataclass(frozen=True)
class ColumnId:
    table: str
    column: str


def _class_of(f: T.StructField) -> str | None:
    return next((name for kind, name in _CLASSES.items() if isinstance(f.dataType, kind)), None)


def _comparable(df: DataFrame, name: str) -> Column:
    """The value of a column as one of its class: whole numbers as long, all else as text."""
    f = df.schema[name]
    value = F.col(f"`{name}`")
    return value.cast("long") if _class_of(f) == "integer" else value.cast("string")


def profiles(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row for each column: kind, rows, values, distinct (estimate), low, high, sketch.

    ``columns`` may name the columns to look at; those of other types than whole numbers,
    texts, dates, instants and decimals are left out. Low and high are texts that order as
    the values of whole numbers do.
    """
    out = []
    for table, df in tables.items():
        wanted = df.columns if columns is None else columns.get(table, [])
        fields = [f for f in df.schema.fields if f.name in wanted and _class_of(f)]
        if not fields:
            continue
        aggs, rows = [F.count(F.lit(1)).alias("rows")], []
        for i, f in enumerate(fields):
            value = _comparable(df, f.name)
            aggs += [
                F.count(value).alias(f"n{i}"),
                F.theta_sketch_agg(value, F.lit(SKETCH_BITS)).alias(f"s{i}"),
                F.min(value).alias(f"lo{i}"),
                F.max(value).alias(f"hi{i}"),
            ]
            rows.append(F.struct(
                F.lit(f.name).alias("column_name"), F.lit(_class_of(f)).alias("kind"), "rows",
                F.col(f"n{i}").alias("values"),
                F.theta_sketch_estimate(f"s{i}").alias("distinct"),
                F.col(f"lo{i}").cast("string").alias("low"),
                F.col(f"hi{i}").cast("string").alias("high"),
                F.col(f"s{i}").alias("sketch"),
            ))
        out.append(df.agg(*aggs).select(F.lit(table).alias("table_name"), F.inline(F.array(*rows))))
    return union_all(out)


def candidate_pairs(profile: DataFrame) -> DataFrame:
    """(table_name, column_name, ref_table, ref_column) of the pairs that may be
    inclusions into a key, by the profiles alone. One row a column, so the pairs are few."""
    a = profile.select(*(F.col(c).alias(f"a_{c}") for c in profile.columns))
    b = profile.select(*(F.col(c).alias(f"b_{c}") for c in profile.columns))
    slack = KEY_ERRORS / 2 ** (SKETCH_BITS / 2)
    whole = F.col("a_kind") == "integer"

    def value(c: str) -> Column:
        return F.col(c).try_cast("long")

    inside = F.when(
        whole, (value("a_low") >= value("b_low")) & (value("a_high") <= value("b_high"))
    ).otherwise((F.col("a_low") >= F.col("b_low")) & (F.col("a_high") <= F.col("b_high")))
    key_like = (F.col("b_values") == F.col("b_rows")) & (
        F.col("b_distinct") >= F.col("b_rows") * (1 - slack)
    )
    pairs = a.join(
        b,
        (F.col("a_kind") == F.col("b_kind"))
        & ((F.col("a_table_name") != F.col("b_table_name"))
           | (F.col("a_column_name") != F.col("b_column_name")))
        & key_like & inside & (F.col("a_values") > 0),
    )
    left = F.theta_sketch_estimate(F.theta_difference("a_sketch", "b_sketch"))
    return pairs.filter(left == 0).select(
        F.col("a_table_name").alias("table_name"), F.col("a_column_name").alias("column_name"),
        F.col("b_table_name").alias("ref_table"), F.col("b_column_name").alias("ref_column"),
    )


def _column_sets(tables: Mapping[str, DataFrame], ids: Sequence[ColumnId]) -> DataFrame:
    """(columns, n, values): by set of columns (as numbers), how many distinct values stand in
    exactly these."""
    by_table: dict[str, list[tuple[int, str]]] = {}
    for k, c in enumerate(ids):
        by_table.setdefault(c.table, []).append((k, c.column))
    parts = []
    for table, own in by_table.items():
        df = tables[table]
        entries = [
            F.struct(
                F.lit(k).alias("id"),
                F.lit(_class_of(df.schema[name])).alias("kind"),
                _comparable(df, name).cast("string").alias("value"),
            )
            for k, name in own
        ]
        parts.append(df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull()))
    # Repeated values are combined before the shuffle; a value's columns are a short set.
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("kind", "value").agg(F.sort_array(F.collect_set("id")).alias("columns"))
        .groupBy("columns").agg(F.count(F.lit(1)).alias("n"))
    )


def inclusions(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Verified inclusions into key columns: table_name, column_name, ref_table, ref_column,
    distinct_values (of the including column's values), key_values."""
    schema = (
        "table_name string, column_name string, ref_table string, ref_column string, "
        "distinct_values long, key_values long"
    )
    profile = profiles(tables, columns)
    spark = profile.sparkSession
    # A row for each column and for each surviving pair of columns.
    sized = {(r[0], r[1]): r[2] for r in profile.select("table_name", "column_name", "rows").collect()}
    pairs = [
        (ColumnId(r[0], r[1]), ColumnId(r[2], r[3]))
        for r in candidate_pairs(profile)
        .select("table_name", "column_name", "ref_table", "ref_column")
        .orderBy("table_name", "column_name", "ref_table", "ref_column").collect()
    ]
    found = []
    for low in range(0, len(pairs), PAIRS_AT_ONCE):
        some = pairs[low : low + PAIRS_AT_ONCE]
        ids = list(dict.fromkeys(c for pair in some for c in pair))
        number = {c: k for k, c in enumerate(ids)}
        sets = _column_sets(tables, ids)
        counted = sets.agg(
            *(
                F.coalesce(F.sum(F.when(F.array_contains("columns", k), F.col("n"))), F.lit(0)).alias(f"d{k}")
                for k in range(len(ids))
            ),
            *(
                F.coalesce(F.sum(F.when(
                    F.array_contains("columns", number[a]) & F.array_contains("columns", number[b]),
                    F.col("n"))), F.lit(0)).alias(f"c{k}")
                for k, (a, b) in enumerate(some)
            ),
        ).first()
        for k, (a, b) in enumerate(some):
            own, key = counted[f"d{number[a]}"], counted[f"d{number[b]}"]
            if counted[f"c{k}"] == own and key == sized[b.table, b.column]:
                found.append((a.table, a.column, b.table, b.column, own, key))
    return local_frame(spark, found, schema)
