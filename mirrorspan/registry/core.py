"""Registered queries: a Spark callable and the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mirrorspan.model import Relationship, RunContext
from mirrorspan.registry.derived import AS_OF_MIDNIGHT, DERIVED

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One clock for all queries: the newest order date, and the end of the events.
AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.datetime(2024, 1, 31)
N3 = RunContext(AS_OF, 3)
N30 = RunContext(AS_OF, 30)
EVENTS_N3 = RunContext(EVENTS_AS_OF, 3)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RELATIONSHIPS = (
    Relationship("fk_line_order", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    Relationship("fk_line_part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
    Relationship("fk_line_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    Relationship("fk_order_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),
    Relationship("fk_customer_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    Relationship("fk_supplier_nation", "supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    Relationship("fk_nation_region", "nation", ("n_regionkey",), "region", ("r_regionkey",)),
    Relationship("fk_return_line", "returns", ("r_orderkey", "r_partkey"),
                 "lineitem", ("l_orderkey", "l_partkey")),
)


_SCHEMAS: dict[str, StructType] = {}


class Inputs:
    """The driver's tables and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        if name not in DERIVED:
            path = f"{self.folder}/{name}.parquet"
            if path not in _SCHEMAS:  # inferring it again would be a job per read
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            return self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        sql = DERIVED[name].replace("{as_of_midnight}", AS_OF_MIDNIGHT["spark"])
        used = {t: self(t) for t in (*TABLES, *DERIVED) if "{" + t + "}" in sql}
        return self.spark.sql(sql, **used)

    def all(self) -> dict[str, DataFrame]:
        return {t: self(t) for t in TABLES}


def query(name: str, oracle: str | None = None, needs: tuple[str, ...] = ()):
    """Register ``fn(inputs)`` under ``name``; ``needs`` are derived inputs of the SQL."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if oracle is not None:
            ORACLES[name] = with_derived(oracle, needs)
        return fn

    return register


def with_derived(body: str, needs: tuple[str, ...]) -> str:
    """``body`` with each derived input it needs as a common table expression."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in DERIVED:
            if other != name and "{" + other + "}" in DERIVED[name]:
                visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    names = {t: t for t in (*TABLES, *DERIVED)} | {"as_of_midnight": AS_OF_MIDNIGHT["duckdb"]}
    ctes = ",\n".join(f"{n} AS ({DERIVED[n].format(**names)})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
