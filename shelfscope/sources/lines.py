"""JSON-lines files: line numbers, strict and tolerant reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfscope.functions import jsons
from shelfscope.functions.rows import compute_once
from shelfscope.functions.text import is_blank_text, strip
from shelfscope.session import allow_duplicate_json_keys


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): raw lines of plain or .gz files, unordered."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, value) with 1-based line numbers, blank lines counted.

    A big file is read as many splits, so numbering it with one window would put the whole file
    into one task. Instead each split is counted, the counts are summed over the (few) splits of
    a file, and every line adds the offset of its split to its own position inside the split.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    before = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        raw.groupBy("file", "split_start")
        .agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("file", "split_start", "first_row", "offset")
    )
    return raw.join(splits, ["file", "split_start"]).select(
        "file", (F.col("offset") + F.col("row_id") - F.col("first_row") + 1).alias("line_no"), "value"
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds `problem` (NULL, empty_line, invalid_json, invalid_shape) and `fields` map<string,variant>.

    Every line stays a row; nothing is dropped here.
    """
    allow_duplicate_json_keys(lines.sparkSession)
    value = F.col("value")
    keep = [c for c in lines.columns if c != "value"]
    # Padding other than plain spaces is rare, so the trimming pattern runs only where a line needs it.
    bare = F.when(value.startswith("{") & value.endswith("}"), value).otherwise(strip(value))
    parsed = compute_once(lines.select(*keep, "value"), {"parsed": F.when(~is_blank_text(value), jsons.parse_whole(bare))})
    found = compute_once(parsed, {"fields": jsons.as_object(F.col("parsed"))})
    problem = (
        F.when(F.col("fields").isNotNull(), F.lit(None))
        .when(F.col("parsed").isNotNull(), "invalid_shape")
        .when(is_blank_text(value), "empty_line")
        .otherwise("invalid_json")
    )
    return found.select(*keep, problem.alias("problem"), "fields")


def strict_records(lines: DataFrame) -> DataFrame:
    """Parsed objects only; blank lines are skipped and the first bad line fails the job."""
    parsed = parse_lines(lines).where(~F.col("problem").eqNullSafe("empty_line"))
    where = [F.concat(F.lit(f" {c}="), F.col(c).cast("string")) for c in ("file", "line_no") if c in lines.columns]
    message = F.concat(F.lit("expected one JSON object per line: "), F.col("problem"), *where)
    # A filter, so that the check runs whatever columns are read later.
    good = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return parsed.where(good).drop("problem")
