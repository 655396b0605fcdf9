"""Environments and the blank-field exception list."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.functions.jsons import parse_whole
from shelfscope.functions.text import strip
from shelfscope.functions.urls import gate_site


@dataclass(frozen=True)
class Environment:
    """Where the tables of one environment live. `root` is a path or an object-store URI."""

    name: str
    root: str

    def __post_init__(self) -> None:
        if self.name not in ("dev", "prod"):
            raise ValueError(f"environment must be dev or prod, not {self.name!r}")

    @property
    def bronze(self) -> str:
        return f"{self.root.rstrip('/')}/bronze/{self.name}/"

    @property
    def key_prefix(self) -> str:
        """The bronze path below the bucket, e.g. 'bronze/dev/'."""
        if "://" in self.bronze:
            return self.bronze.split("/", 3)[3]
        return f"bronze/{self.name}/"

    def path(self, table: str) -> str:
        return self.bronze + table


def exception_rows(
    spark: SparkSession, exceptions_json: str | None = None, exceptions_file: str | None = None
) -> DataFrame:
    """(site, field) pairs exempt from the blank check; site '*' means every site.

    Given inline or as a file, never both. A configuration document: small by nature.
    """
    if exceptions_json and exceptions_file:
        raise ValueError("give the exceptions inline or as a file, not both")
    if exceptions_file:
        text = spark.read.text(exceptions_file, wholetext=True)
    elif exceptions_json:
        text = spark.range(1).select(F.lit(exceptions_json).alias("value"))
    else:
        return spark.createDataFrame([], "site string, field string")
    return exceptions_from_text(text)


def exceptions_from_text(text: DataFrame) -> DataFrame:
    """JSON {site or *: [fields]} in column `value` -> distinct (site, field). Bad input fails the job."""
    listed = F.try_variant_get(parse_whole(F.col("value")), "$", "map<string,array<string>>")
    all_lists = F.forall(F.map_values(listed), lambda fields: fields.isNotNull())
    checked = F.when(listed.isNotNull() & all_lists, listed).otherwise(
        F.raise_error(F.lit("exceptions must be an object of field lists")).cast("map<string,array<string>>")
    )
    pairs = text.select(F.explode(checked).alias("raw_site", "fields"))
    site = F.when(strip(F.col("raw_site")) == "*", "*").otherwise(gate_site(F.col("raw_site")))
    return (
        pairs.select(site.alias("site"), F.explode("fields").alias("field"))
        .select("site", strip(F.col("field")).alias("field"))
        .where("field <> ''")
        .distinct()
    )


def exceptions_from_dict(spark: SparkSession, exceptions: dict[str, list[str]] | None) -> DataFrame:
    return exception_rows(spark, exceptions_json=json.dumps(exceptions) if exceptions else None)
