"""Named queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function(t) under its name; t(name) reads a table."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
            t.spark, t.dir = spark, sf_dir
            return f(t)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


from tessera.plans import hierarchy_queries, item_queries, label_queries, ledger_queries, rank_queries, source_queries, taxonomy_queries, text_queries  # noqa: E402, F401
