"""Reading tables: whole, by query, by key page, by sample, from files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mirrorspan.model import RunContext, SourceReader
from mirrorspan.sources.pages import CountCells, cells_sql, equal_depth, page_predicates


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_query(
    spark: SparkSession,
    sql: str,
    tables: Mapping[str, DataFrame],
    ctx: RunContext | None = None,
    **args,
) -> DataFrame:
    """Run user SQL; ``{name}`` stands for a table, ``:cutoff`` for the window start.

    The text becomes part of the plan, so filters and column lists reach the
    scans underneath.
    """
    if ctx is not None:
        args = {"cutoff": ctx.cutoff, "lookback_days": ctx.lookback_days, **args}
    used = {name: df for name, df in tables.items() if "{" + name + "}" in sql}
    return spark.sql(sql, args=args or None, **used)


def jdbc_options(
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    page_rows: int = 100_000,
    rows: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read split into key ranges.

    Pages are key ranges, not row offsets, so no row is read twice or missed
    and the source need not re-read what it already skipped. How many of them read
    at once is for the cluster to say (its cores, or a scheduler pool).
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    if key and bounds:
        low, high = bounds
        wanted = page_count(rows if rows is not None else high - low + 1, page_rows)
        options.update(
            partitionColumn=key,
            lowerBound=str(low),
            upperBound=str(high + 1),
            numPartitions=str(max(1, wanted)),
        )
    return options


def hash_page_predicates(hash_sql: str, pages: int) -> list[str]:
    """JDBC predicates for a key without an order of its own (text keys).

    ``hash_sql`` is the source's expression for a non-negative hash of the
    key; NULL keys go with page 0, so the pages cover the table exactly once.
    """
    first = f"(({hash_sql}) % {pages} = 0 OR ({hash_sql}) IS NULL)"
    return [first] + [f"(({hash_sql}) % {pages} = {i})" for i in range(1, pages)]


def scan_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    predicates: Sequence[str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A JDBC table or ``(query) alias``; Spark pushes filters and columns to the source."""
    if predicates:
        return spark.read.jdbc(
            options["url"],
            options["dbtable"],
            predicates=list(predicates),
            properties={**{k: v for k, v in options.items() if k == "fetchsize"}, **(properties or {})},
        )
    return spark.read.format("jdbc").options(**options).options(**(properties or {})).load()


def parquet_reader(spark: SparkSession, folder: str) -> SourceReader:
    """Tables of a folder with one parquet file or folder per table."""
    return lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def catalog_reader(spark: SparkSession, database: str) -> SourceReader:
    """Tables of a catalog database."""
    return lambda table: spark.table(f"`{database}`.`{table}`")


class JdbcReader:
    """Tables of a JDBC database, each read in pages.

    ``keys`` names the integer key per table, whose ranges are the pages;
    ``hash_keys`` gives, for tables without one, the source's SQL for a
    non-negative hash of a key, whose remainders are. A table in neither is one
    page. ``chunk_rows`` are the rows of a page per table; others go by size.
    Count and key range come from one aggregate query per table and window, asked
    once in the life of the reader: use a new one for each run. With ``balanced`` the pages
    of a key are of equal depth (see ``sources.pages``), at the price of a few counting
    queries.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        keys: Mapping[str, str],
        chunk_rows: Mapping[str, int | None] | None = None,
        properties: Mapping[str, str] | None = None,
        hash_keys: Mapping[str, str] | None = None,
        balanced: bool = False,
    ):
        self.spark = spark
        self.url = url
        self.keys = dict(keys)
        self.hash_keys = dict(hash_keys or {})
        self.chunk_rows = {t: n for t, n in (chunk_rows or {}).items() if n}
        self.properties = properties
        self.balanced = balanced
        self._facts: dict[tuple[str, str | None], tuple[int, int | None, int | None]] = {}

    def __call__(self, table: str) -> DataFrame:
        return self.window(table, None)

    def window(self, table: str, where: str | None) -> DataFrame:
        """The rows for which the source's SQL ``where`` holds; pages cover these only."""
        options, predicates = self.pages(table, where, *self.facts(table, where))
        return scan_jdbc(self.spark, options, predicates, self.properties)

    def facts(self, table: str, where: str | None) -> tuple[int, int | None, int | None]:
        """(rows, least key, greatest key), the keys null for tables without one."""
        if (table, where) not in self._facts:
            key = self.keys.get(table)
            span = f"min({key}) AS lo, max({key}) AS hi, " if key else ""
            query = f"(SELECT {span}count(*) AS n FROM {table}{_where(where)}) b"
            row = scan_jdbc(
                self.spark, jdbc_options(self.url, query), properties=self.properties
            ).first()
            known = (row["lo"], row["hi"]) if key else (None, None)
            self._facts[table, where] = (row["n"], *(None if v is None else int(v) for v in known))
        return self._facts[table, where]

    def pages(
        self, table: str, where: str | None, rows: int, low: int | None, high: int | None
    ) -> tuple[dict[str, str], list[str] | None]:
        """Options and predicates of the read."""
        source = f"(SELECT * FROM {table}{_where(where)}) w" if where else table
        each = self.chunk_rows.get(table) or chunk_rows_for(rows)
        if low is not None and high is not None:
            key = self.keys[table]
            if self.balanced and rows > each:
                found = equal_depth(self._counter(table, key, where), low, high, rows, each)
                return jdbc_options(self.url, source), page_predicates(key, found)
            return jdbc_options(self.url, source, key, (low, high), each, rows), None
        pages = page_count(rows, each)
        if table in self.hash_keys and pages > 1:
            return jdbc_options(self.url, source), hash_page_predicates(self.hash_keys[table], pages)
        return jdbc_options(self.url, source), None


    def _counter(self, table: str, key: str, where: str | None) -> CountCells:
        def count(ranges: Sequence[tuple[int, int]], width: int) -> dict[int, int]:
            found: dict[int, int] = {}
            for at in range(0, len(ranges), 100):  # statements of bounded length
                sql = cells_sql(table, key, ranges[at : at + 100], width, where)
                options = jdbc_options(self.url, f"({sql}) c")
                rows = scan_jdbc(self.spark, options, properties=self.properties).collect()
                found.update((int(r["cell"]), r["n"]) for r in rows)
            return found

        return count


def _where(condition: str | None) -> str:
    return f" WHERE {condition}" if condition else ""


def page_count(rows: int, page_rows: int) -> int:
    return -(-rows // page_rows)


def chunk_rows_for(rows: int | None) -> int:
    """Rows per page by size class, for tables that set none."""
    # Over 10M rows 50,000; from 1M rows 100,000; below 200,000.
    if rows is None:
        return 100_000
    return 50_000 if rows > 10_000_000 else 100_000 if rows >= 1_000_000 else 200_000


def chunk_rows_column(rows: Column) -> Column:
    return (
        F.when(rows.isNull(), 100_000).when(rows > 10_000_000, 50_000)
        .when(rows >= 1_000_000, 100_000).otherwise(200_000)
    )


def key_page(key: Column, width: int, low: int = 0) -> Column:
    """Number of the key-range page a row belongs to (a projection, no shuffle).

    Whole numbers throughout: a quotient in floating point would be off for large keys.
    """
    offset = key.cast("bigint") - F.lit(low)
    return F.call_function("div", offset - F.pmod(offset, F.lit(width)), F.lit(width))


def key_pages(df: DataFrame, key: str, width: int) -> DataFrame:
    """Rows and key range of each page; rows without a key form a page of their own."""
    return (
        df.groupBy(key_page(F.col(key), width).alias("page"))
        .agg(
            F.min(key).alias("first_key"),
            F.max(key).alias("last_key"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def scan_pages(df: DataFrame, key: str, width: int) -> DataFrame:
    """The whole table with its page number.

    All pages together are this one scan: Spark's partitions bound the memory,
    so nothing is cut up and put together again.
    """
    return df.withColumn("page", key_page(F.col(key), width))


def sample_rows(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in key order (a top-n per partition, then of those)."""
    return df.select(*columns).orderBy(*order_by).limit(n)


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def read_external(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Files under ``path`` as a table; without a schema Spark infers one."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        return reader.schema(schema).load(path)
    return reader.option("inferSchema", "true").load(path)


def create_external_table(
    spark: SparkSession, name: str, path: str, fmt: str = "csv", schema: T.StructType | None = None, **options
) -> DataFrame:
    """A catalog table over files that stay where they are."""
    return spark.catalog.createTable(name, path=path, source=fmt, schema=schema, **options)


def register_external(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv", **options
) -> list[str]:
    """One temporary view per (name, path); returns the names."""
    for name, path in paths.items():
        read_external(spark, path, fmt, **options).createOrReplaceTempView(name)
    return sorted(paths)
