"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) -> DataFrame under its own name, with its SQL if it has one."""

    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Short rows that grow long or dear further on, dealt over all cores; a small file may be one split, whatever its rows become."""
    return rows.repartition(3 * rows.sparkSession.sparkContext.defaultParallelism, key)
