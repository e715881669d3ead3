"""Discovery of relations: shared column names, foreign-key statistics, advice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from mirrorspan.model import Relationship, SourceReader
from mirrorspan.operators.joins import fk_orphans, labelled_join_test
from mirrorspan.sources.catalog import column_catalog, columns_like, name_like, union_all

# Name patterns of likely keys.
SHARED_NAME_PATTERNS = ("%ID%", "%id%", "%numero%", "%comprobante%")
KEY_NAME_PATTERNS = ("%ID%", "%numero%", "%comprobante%")


def common_columns(catalog: DataFrame, patterns: Sequence[str] = SHARED_NAME_PATTERNS) -> DataFrame:
    """Pairs of tables that share a key-like column name, in order of both."""
    named = catalog.filter(name_like(F.col("column_name"), patterns)).select(
        "table_name", "column_name", "full_type", "non_null_rows"
    )
    a, b = named.alias("a"), named.alias("b")
    return a.join(
        b,
        (F.col("a.column_name") == F.col("b.column_name"))
        & (F.col("a.table_name") != F.col("b.table_name")),
    ).select(
        F.col("a.table_name").alias("table1"),
        F.col("a.column_name").alias("column1"),
        F.col("b.table_name").alias("table2"),
        F.col("b.column_name").alias("column2"),
        F.col("a.full_type").alias("data_type1"),
        F.col("b.full_type").alias("data_type2"),
        F.col("a.non_null_rows").alias("values1"),
        F.col("b.non_null_rows").alias("values2"),
    ).orderBy("table1", "column1", "table2")


def shared_columns(tables: Mapping[str, DataFrame], patterns: Sequence[str] = SHARED_NAME_PATTERNS) -> DataFrame:
    """:func:`common_columns` of the tables, reading only columns named like keys."""
    named = {name: columns_like(df, patterns) for name, df in tables.items()}
    return common_columns(column_catalog(tables, columns=named), patterns)


def join_tests(read: SourceReader, relationships: Sequence[Relationship]) -> DataFrame:
    return union_all(labelled_join_test(read, r) for r in relationships)


def all_fk_orphans(read: SourceReader, relationships: Sequence[Relationship]) -> DataFrame:
    return union_all(fk_orphans(read, r) for r in relationships)


def join_recommendations(tests: DataFrame) -> DataFrame:
    """Join text for every tested pair that really matches rows."""
    sides = F.split("join_column", "=")
    on = F.array_join(
        F.zip_with(
            F.split(sides[0], ","),
            F.split(sides[1], ","),
            lambda p, c: F.concat(F.col("table2"), F.lit("."), c, F.lit(" = "), F.col("table1"), F.lit("."), p),
        ),
        " AND ",
    )
    return tests.filter("join_works").select(
        F.lit("confirmed_join").alias("type"),
        F.concat(
            F.lit("Use "), "join_column", F.lit(" to join "), "table1", F.lit(" and "), "table2"
        ).alias("message"),
        F.concat(F.lit("INNER JOIN "), "table1", F.lit(" ON "), on).alias("join_text"),
        "total_joined_rows",
    )


def fk_statistics(fks: DataFrame) -> DataFrame:
    """Totals over a foreign-key catalog (one row per key column); with measured
    child_rows and orphan_rows their sums as well."""
    heads = fks.filter("key_position = 1")
    measured = [F.sum(c).alias(c) for c in ("child_rows", "orphan_rows") if c in fks.columns]
    return heads.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kind") == "single_column").alias("single_column"),
        F.count_if(F.col("kind") == "composite").alias("composite"),
        F.count_distinct("referenced_table").alias("tables_with_incoming"),
        F.count_distinct("table_name").alias("tables_with_outgoing"),
        *measured,
    )


def fk_by_table(fks: DataFrame) -> DataFrame:
    """Outgoing and incoming foreign keys of each table, as sorted text lists."""
    heads = fks.filter("key_position = 1")
    ends = heads.select(
        F.col("table_name").alias("table"), F.col("constraint_name").alias("outgoing"),
        F.lit(None).cast("string").alias("incoming"),
    ).unionByName(
        heads.select(
            F.col("referenced_table").alias("table"), F.lit(None).cast("string").alias("outgoing"),
            F.col("constraint_name").alias("incoming"),
        )
    )

    def listed(c):
        return F.array_join(F.array_sort(F.collect_list(c)), ",")

    return ends.groupBy(F.col("table").alias("table_name")).agg(
        F.count("outgoing").alias("outgoing_count"),
        F.count("incoming").alias("incoming_count"),
        listed("outgoing").alias("outgoing"),
        listed("incoming").alias("incoming"),
    )


def referenced_by(fks: DataFrame) -> DataFrame:
    """Who refers to ``table.column``: one row per referenced column."""
    return fks.groupBy(
        F.concat("referenced_table", F.lit("."), "referenced_column").alias("referenced")
    ).agg(
        F.count(F.lit(1)).alias("references"),
        F.array_join(
            F.array_sort(F.collect_list(F.concat("table_name", F.lit("."), "column_name"))), ","
        ).alias("referring"),
    )


def relationship_report(
    read: SourceReader, fks: DataFrame, catalog: DataFrame, keys: DataFrame,
    relationships: Sequence[Relationship],
) -> DataFrame:
    """Foreign keys, shared columns, key columns, join tests and advice in one
    frame of (section, subject, detail)."""
    tests = join_tests(read, relationships)

    def section(name, df, subject, detail):
        return df.select(F.lit(name).alias("section"), subject.alias("subject"), detail.alias("detail"))

    dot = F.lit(".")
    return union_all(
        [
            section("foreign_key", fks, F.concat("table_name", dot, "column_name"),
                    F.concat("referenced_table", dot, "referenced_column")),
            section("common_column", common_columns(catalog), F.concat("table1", dot, "column1"),
                    F.concat("table2", dot, "column2")),
            section("key_column", keys, F.concat("table_name", dot, "column_name"), F.col("full_type")),
            section("join_test", tests, F.concat("table1", F.lit("-"), "table2"),
                    F.col("total_joined_rows").cast("string")),
            section("recommendation", join_recommendations(tests), F.col("message"), F.col("join_text")),
        ]
    )
