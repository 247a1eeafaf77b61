"""Registry of the queries the driver runs (``__spark_entry__.queries``).

Each query is a function ``(spark, sf_dir) -> DataFrame`` that reads the
given tables (or tables Spark derives from them) and applies one operator.
``oracle`` is the equivalent DuckDB SQL over the same parquet tables, or
``None`` when the operator is not SQL-expressible (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
