"""Analytical views over headers, lines, branches, products and stock.

Column roles are passed in by name through small mappings, so the views fit
any schema. Joins are left to Catalyst: a dimension is broadcast only while
its scan is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def create_view(spark: SparkSession, name: str, sql: str, persistent: bool = False) -> DataFrame:
    """A view of the session, or, if ``persistent``, of the catalog: it replaces one of
    that name, outlives the session, and can read catalog tables and views only."""
    if persistent:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    else:
        spark.sql(sql).createOrReplaceTempView(name)
    return spark.table(name)


# Digits after the point at which binary fractions are summed.
FRACTION_DIGITS = 9
# Lines that a task sums per header.
ROWS_A_PART = 500_000


def exact_sum(df: DataFrame, column: str) -> Column:
    """The sum of a column, the same in any order of the rows.

    Decimals are summed with the column's own scale. Binary fractions become
    decimals of ``FRACTION_DIGITS`` digits first, since their sums depend on the
    order of the rows.
    """
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value.cast(T.DecimalType(28, FRACTION_DIGITS))
    return F.sum(value)


def invoices_consolidated(
    headers: DataFrame, lines: DataFrame, branches: DataFrame, products: DataFrame, keys: Mapping[str, str]
) -> DataFrame:
    """Every line with its header, branch and product."""
    return (
        lines.join(headers, F.col(keys["line_header"]) == F.col(keys["header"]))
        .join(branches, F.col(keys["line_branch"]) == F.col(keys["branch"]))
        .join(products, F.col(keys["line_product"]) == F.col(keys["product"]))
    )


def daily_sums(
    headers: DataFrame, lines: DataFrame, keys: Mapping[str, str], rows: int | None = None
) -> DataFrame:
    """Lines, invoices and exact amount per day and branch.

    Lines are summed per (header, branch) before they meet the headers. With the number
    of ``rows`` of the lines, they are dealt by header first, so that a task's sums stay
    of one size however many lines there are; headers have few lines, summing them where
    they are read would save little.
    """
    amount = exact_sum(lines, keys["line_amount"]).alias("amount")
    if rows is not None:
        parts = max(lines.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_PART))
        columns = (keys[c] for c in ("line_header", "line_branch", "line_amount"))
        lines = lines.select(*dict.fromkeys(columns)).repartition(parts, keys["line_header"])
    per_invoice = lines.groupBy(
        F.col(keys["line_header"]).alias("header_key"), F.col(keys["line_branch"]).alias("branch_key")
    ).agg(F.count(F.lit(1)).alias("n"), amount)
    dated = headers.select(
        F.col(keys["header"]).alias("header_key"), F.to_date(keys["header_date"]).alias("day")
    )
    return (
        per_invoice.join(dated, "header_key")
        .groupBy("day", "branch_key")
        .agg(
            F.sum("n").alias("lines"),
            F.count(F.lit(1)).alias("invoices"),
            F.sum("amount").alias("amount"),
        )
    )


def named_sales(sums: DataFrame, branches: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """:func:`daily_sums` with the name of each branch, and the amount as a number."""
    names = branches.select(
        F.col(keys["branch"]).alias("branch_key"), F.col(keys["branch_name"]).alias("branch_name")
    )
    return sums.withColumn("amount", F.col("amount").cast("double")).join(names, "branch_key")


def daily_sales(
    headers: DataFrame, lines: DataFrame, branches: DataFrame, keys: Mapping[str, str],
    rows: int | None = None,
) -> DataFrame:
    """Lines, invoices and amount per day and branch; its name is added after the grouping."""
    return named_sales(daily_sums(headers, lines, keys, rows), branches, keys)


def stock_sums(first: DataFrame, second: DataFrame) -> DataFrame:
    """Exact quantity and entries per branch and product over both databases."""
    both = first.unionByName(second)
    return both.groupBy("branch_key", "product_key").agg(
        exact_sum(both, "quantity").alias("quantity"), F.count(F.lit(1)).alias("entries")
    )


def stock_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Quantity per branch and product over both databases.

    Inputs have branch_key, product_key and quantity.
    """
    return stock_sums(first, second).withColumn("quantity", F.col("quantity").cast("double"))


def product_master(first: DataFrame, second: DataFrame) -> DataFrame:
    """Products of both databases; columns one side lacks are NULL."""
    return first.unionByName(second, allowMissingColumns=True)


def order_tracking(headers: DataFrame, lines: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Per header: lines, first and last line date, and whether lines are open.

    closed: no open line; open: no closed one; partial: some of both;
    empty: no lines at all.
    """
    is_open = F.col(keys["line_status"]) == keys["open_value"]
    per_header = lines.groupBy(F.col(keys["line_header"]).alias(keys["header"])).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(is_open).alias("open_lines"),
        F.min(keys["line_date"]).alias("first_date"),
        F.max(keys["line_date"]).alias("last_date"),
    )
    count = F.coalesce("lines", F.lit(0).cast("bigint"))
    open_count = F.coalesce("open_lines", F.lit(0).cast("bigint"))
    return headers.select(keys["header"]).join(per_header, keys["header"], "left").select(
        keys["header"],
        count.alias("lines"),
        open_count.alias("open_lines"),
        "first_date",
        "last_date",
        F.when(count == 0, "empty").when(open_count == 0, "closed")
        .when(open_count == count, "open").otherwise("partial").alias("tracking_status"),
    )
