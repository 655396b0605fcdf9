"""Seed URL lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.functions.text import strip


def clean_seed_column(first_column: DataFrame) -> DataFrame:
    """First CSV column trimmed (byte-order mark removed), without empty cells and 'url' headings."""
    url = strip(F.regexp_replace(F.col(first_column.columns[0]), "^﻿", ""))
    return first_column.select(url.alias("url")).where((F.col("url") != "") & (F.lower("url") != "url"))


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Any path Spark can read; the scheme decides the file system."""
    if path.startswith("s3://") and not path[5:].partition("/")[2]:
        raise ValueError(f"no object key in {path}")
    return clean_seed_column(spark.read.option("header", "false").csv(path).select("_c0"))


def seed_urls(
    spark: SparkSession,
    urls: list[str] | str | None = None,
    csv_path: str | None = None,
    default_csv_path: str | None = None,
) -> DataFrame:
    """Explicit URLs (list or comma text), else a CSV file, else the configured default file.

    Unlike `read_seed_csv` the cells are taken as they are: no trimming, no heading test.
    """
    if urls:
        if isinstance(urls, str):
            row = spark.range(1).select(F.lit(urls).alias("text"))
            return row.select(F.explode(F.split("text", ",")).alias("url"))
        return spark.createDataFrame([(u,) for u in urls], "url string")
    path = csv_path or default_csv_path
    if not path:
        return spark.createDataFrame([], "url string")
    return spark.read.option("header", "false").csv(path).select(F.col("_c0").alias("url")).where("url IS NOT NULL")
