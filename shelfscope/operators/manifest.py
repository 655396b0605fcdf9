"""Run manifests: statistics, artifacts, the manifest document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import text, urls
from shelfscope.operators.keyed import first_rows


def status_code_counts(stats: Column) -> Column:
    """Entries with the response-status prefix, prefix removed."""
    prefix = fv.STATUS_COUNT_PREFIX
    kept = F.map_filter(stats, lambda k, v: k.startswith(prefix))
    return F.transform_keys(kept, lambda k, v: F.substr(k, F.lit(len(prefix) + 1)))


def manifest_stats(stats: Column, items: Column) -> Column:
    """Counter map of a run -> the manifest's stats block."""

    def counter(key: str) -> Column:
        return F.coalesce(F.try_element_at(stats, F.lit(key)), F.lit(0)).cast("bigint")

    return F.struct(
        items.cast("bigint").alias("items_scraped"),
        counter(fv.REQUEST_COUNT_KEY).alias("requests_made"),
        counter(fv.ERROR_COUNT_KEY).alias("errors_count"),
        status_code_counts(stats).alias("status_code_counts"),
    )


def count_requests(requests: DataFrame, by: list[str], status: str = "status", ts: str = "ts") -> DataFrame:
    """Request log -> one row per run: first and last time, number of requests, counts per status.

    Two aggregates: first per (run, status), which shrinks any run to a handful of rows, then per run.
    """
    per_status = requests.groupBy(*by, F.col(status).cast("string").alias("code")).agg(
        F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    return per_status.groupBy(*by).agg(
        F.min("first").alias("start_time"),
        F.max("last").alias("finish_time"),
        F.sum("n").cast("bigint").alias("requests_made"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias("status_code_counts"),
    )


def seconds_between(start: Column, finish: Column) -> Column:
    """Fractional seconds, NULL without a start."""
    return (F.unix_micros(finish.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1_000_000)


def duration(stats: DataFrame) -> DataFrame:
    return stats.withColumn("duration_seconds", seconds_between(F.col("start_time"), F.col("finish_time")))


def artifact_block(path: Column, rows: Column, length: Column, md5: Column, sha256: Column) -> Column:
    """rows, path, size, md5 + sha256, format, compressed flag of one file."""
    gz = path.endswith(".gz")
    return F.struct(
        rows.cast("bigint").alias("rows"),
        path.alias("file_path"),
        length.cast("bigint").alias("file_size_bytes"),
        F.struct(md5.alias("md5"), sha256.alias("sha256")).alias("hashes"),
        F.when(gz, "jsonl.gz").otherwise("jsonl").alias("file_format"),
        gz.alias("compressed"),
    )


def artifact_blocks(files: DataFrame, row_counts: DataFrame) -> DataFrame:
    """(path, length, content) + (path, rows) -> (path, artifacts). Contents are hashed before the join and stay where they are."""
    hashed = files.select("path", "length", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))
    return hashed.join(row_counts, "path", "left").select(
        "path", artifact_block(F.col("path"), F.coalesce("rows", F.lit(0)), F.col("length"), F.col("md5"), F.col("sha256")).alias("artifacts")
    )


def run_artifacts(files: DataFrame, folder: str) -> DataFrame:
    """`file_facts` of one run's data files -> one row (artifacts).

    A single file is described as it is. Several are summed up under the folder: rows and bytes in all, the digest of
    their digests in order of name, and the block of each file in `files`. The list has an entry per file of a run.
    """
    blocks = files.select(
        artifact_block(F.col("path"), F.col("lines"), F.col("bytes"), F.col("md5"), F.col("sha256")).alias("a")
    )
    parts = F.array_sort(F.collect_list("a"), lambda x, y: F.when(x["file_path"] < y["file_path"], -1).otherwise(1))
    one = F.struct(*[F.get("parts", F.lit(0))[c].alias(c) for c in ARTIFACT_FIELDS], F.lit(None).cast(parts_type(blocks)).alias("files"))

    def joined(kind: str) -> Column:
        return F.array_join(F.transform("parts", lambda p: p["hashes"][kind]), "")

    several = F.struct(
        F.col("rows"), F.lit(folder).alias("file_path"), F.col("bytes").alias("file_size_bytes"),
        F.struct(F.md5(joined("md5")).alias("md5"), F.sha2(joined("sha256"), 256).alias("sha256")).alias("hashes"),
        F.lit("jsonl.gz").alias("file_format"), F.lit(True).alias("compressed"), F.col("parts").alias("files"),
    )
    summed = blocks.agg(
        F.coalesce(F.sum("a.rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("a.file_size_bytes"), F.lit(0)).alias("bytes"), parts.alias("parts")
    )
    return summed.select(F.when(F.size("parts") == 1, one).otherwise(several).alias("artifacts"))


ARTIFACT_FIELDS = ["rows", "file_path", "file_size_bytes", "hashes", "file_format", "compressed"]


def parts_type(blocks: DataFrame) -> str:
    return f"array<{blocks.schema['a'].dataType.simpleString()}>"


def entry_points(arguments: Column) -> Column:
    """Only the arguments that name where a run starts."""
    return F.map_filter(arguments, lambda k, v: k.isin(fv.ENTRY_POINT_KEYS))


def build_manifest(runs: DataFrame) -> DataFrame:
    """Run facts -> (run_id, manifest struct).

    `runs`: run_id, crawler_name, exit_reason, arguments map, start_time, finish_time, stats
    struct, artifacts struct, gate struct<status,reason,violations_count,report_path> or NULL.
    """
    expected = F.struct(
        F.coalesce(F.col("artifacts.file_size_bytes"), F.lit(0)).alias("file_size_bytes"),
        F.coalesce(F.col("artifacts.hashes.sha256"), F.lit("")).alias("hashes"),
    )
    body = F.struct(
        "run_id", "crawler_name", "exit_reason",
        entry_points(F.col("arguments")).alias("entry_points"),
        _iso(F.col("start_time")).alias("start_time"),
        _iso(F.col("finish_time")).alias("finish_time"),
        seconds_between(F.col("start_time"), F.col("finish_time")).alias("duration_seconds"),
        "stats", "artifacts",
        F.col("gate").alias("quality_gate"),
        F.struct(expected.alias("expected")).alias("bronze_verification"),
    )
    return runs.select("run_id", body.alias("manifest"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def manifest_documents(manifests: DataFrame) -> DataFrame:
    """(run_id, raw): the manifest as JSON text; an absent gate leaves no key."""
    return manifests.select("run_id", F.to_json("manifest").alias("raw"))


def crawl_file_key(env: str, site: Column, date: Column, run_id: Column, relative: Column) -> Column:
    """Storage key of a run's output file: files below metadata/ go to the metadata branch."""
    meta = relative.startswith("metadata/")
    rest = F.regexp_replace(relative, "^metadata/", "")
    branch = F.when(meta, f"bronze/{env}/crawls/metadata/").otherwise(f"bronze/{env}/crawls/")
    return urls.run_key(branch, site, date, run_id, rest)


def sample_lines(lines: DataFrame, n: int = 3) -> DataFrame:
    """First n lines of every file."""
    return first_rows(lines, ["file"], ["line_no"], n).select("file", "line_no", "value")


def run_summary(status_counts: Column) -> Column:
    """Sorted 'code=n' text of a status map."""
    pairs = F.transform(F.map_entries(status_counts), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("n")))
    return text.count_summary(pairs)
