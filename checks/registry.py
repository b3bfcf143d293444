"""Name -> query and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from staveline.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
SCHEMAS: dict[str, StructType] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; the decorated function takes (spark, sf_dir)."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    # With the schema given, no job has to look for it in the file again.
    return spark.read.schema(SCHEMAS[path]).parquet(path)
