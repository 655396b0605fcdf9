"""Image jobs: building them from product lines, planning (normalise, identify, de-duplicate).

Two job readers exist because their input contracts differ: `build_jobs` explodes image lists
and reports why a line gave no job; `read_job_lines` takes one job per line and turns each bad
line into a skip row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import jsons, urls
from shelfscope.functions.arrays import missing_names
from shelfscope.functions.rows import compute_once
from shelfscope.functions.text import is_blank_text, none_if_empty, strip
from shelfscope.operators.keyed import first_wins
from shelfscope.sources.lines import parse_lines

POSITION = ["file", "line_no"]


def build_jobs(lines: DataFrame, site_override: str | None = None, dedupe: bool = True) -> DataFrame:
    """(file, line_no, value) -> one row per job or rejected line, with `outcome`.

    outcome: jobs_written, skipped_duplicate_job, skipped_empty_line, skipped_invalid_json,
    skipped_invalid_shape, skipped_missing_site / _primary_key / _image_url.
    The duplicate key is the raw (site, primary_key, image_url): site aliases stay apart.
    """
    parsed = parse_lines(lines)
    fields = F.col("fields")
    site = none_if_empty(strip(F.lit(site_override) if site_override else jsons.truthy_text(jsons.present(fields, "site"))))
    known = F.when(F.col("problem").isNull(), site)
    typed = compute_once(compute_once(parsed, {"site": known}), {
        "primary_key": none_if_empty(strip(jsons.primary_key_of(fields, F.col("site")))),
        "image_urls": jsons.image_urls_of(fields),
        "source_run_id": jsons.source_run_of(fields),
    })
    reason = (
        F.when(F.col("problem").isNotNull(), F.concat(F.lit("skipped_"), F.col("problem")))
        .when(F.col("site").isNull(), "skipped_missing_site")
        .when(F.col("primary_key").isNull(), "skipped_missing_primary_key")
        .when(F.size("image_urls") == 0, "skipped_missing_image_url")
    )
    # A rejected line keeps one row: it explodes to a single NULL url.
    jobs = typed.withColumn("reason", reason).select(
        *POSITION, "reason", "site", "primary_key", "source_run_id",
        F.posexplode_outer(F.when(F.col("reason").isNull(), F.col("image_urls"))).alias("url_no", "image_url"),
    ).withColumn("url_no", F.coalesce("url_no", F.lit(0)))
    if not dedupe:
        return jobs.select(
            *POSITION, "url_no", "site", "primary_key", "image_url", "source_run_id",
            F.coalesce("reason", F.lit("jobs_written")).alias("outcome"),
        )
    # Rejected lines have no URL, hence no place among the winners.
    judged = first_wins(jobs, ["site", "primary_key", "image_url"], [*POSITION, "url_no"])
    outcome = F.coalesce("reason", F.when(F.col("is_first"), "jobs_written").otherwise("skipped_duplicate_job"))
    return judged.select(*POSITION, "url_no", "site", "primary_key", "image_url", "source_run_id", outcome.alias("outcome"))


def jobs_of(built: DataFrame) -> DataFrame:
    """The accepted rows of `build_jobs` in the job schema."""
    return built.where("outcome = 'jobs_written'").select(
        "site", "primary_key", "image_url", "source_run_id",
        F.struct(F.col("file").alias("jsonl_path"), F.col("line_no").cast("bigint").alias("line_no")).alias("input_source"),
    )


def job_counters(built: DataFrame) -> DataFrame:
    """Counts per outcome plus rows_total (lines read), one pass."""
    totals = built.groupBy("outcome").agg(F.count("*").alias("n"))
    read = built.where("url_no = 0").agg(F.count("*").alias("n")).select(F.lit("rows_total").alias("outcome"), "n")
    return totals.unionByName(read)


def read_job_lines(lines: DataFrame, site_override: str | None = None) -> DataFrame:
    """One row per non-blank line: job columns, `status`/`reason` NULL for a job, `missing_fields` for a gap.

    Here an empty `image_url` falls through to `image_urls`, and the key is taken as it is. A list
    counts as present but is no URL: such a job has a NULL `image_url` and is refused by planning.
    """
    parsed = parse_lines(lines).where(~F.col("problem").eqNullSafe("empty_line"))
    fields = F.col("fields")
    site = F.lit(site_override) if site_override else jsons.truthy_text(jsons.present(fields, "site"))
    given = [jsons.present(fields, "image_url"), jsons.present(fields, "image_urls")]
    image = F.coalesce(*[jsons.bind(v, lambda x: F.when(jsons.truthy_text(x).isNotNull(), x)) for v in given])
    rows = compute_once(compute_once(parsed, {"site": site, "image": image}), {
        "primary_key": jsons.primary_key_of(fields, F.col("site")),
        "image_text": jsons.as_text(F.col("image")),
        "image_url": F.when(jsons.is_string(F.col("image")), jsons.as_text(F.col("image"))),
        "source_run_id": jsons.source_run_of(fields),
    })
    gaps = missing_names(
        {"site": F.col("site"), "primary_key": F.col("primary_key"), "image_url/image_urls": F.col("image_text")}
    )
    reason = F.when(F.col("problem").isNotNull(), F.lit("invalid_json")).when(F.size(gaps) > 0, "missing_required_fields")
    return rows.select(
        *POSITION, "site", "primary_key", "image_url", "source_run_id",
        F.when(reason.isNotNull(), fv.STATUS_SKIPPED_INVALID).alias("status"),
        reason.alias("reason"),
        F.when(reason == "missing_required_fields", gaps).alias("missing_fields"),
    )


def identify(jobs: DataFrame) -> DataFrame:
    """Adds canonical site, trimmed key, absolute URL and job id; `job_id` is NULL for unusable input."""
    site = urls.image_site(F.col("site"))
    url = F.when(~is_blank_text(F.col("image_url")), urls.normalize_image_url(F.col("image_url")))
    parts = compute_once(jobs, {"norm_site": site, "norm_key": strip(F.col("primary_key")), "norm_url": url})
    return compute_once(parts, {"job_id": urls.job_id(F.col("norm_site"), F.col("norm_key"), F.col("norm_url"))})


def plan_jobs(jobs: DataFrame, position: list[str]) -> DataFrame:
    """Adds `status`/`reason`: NULL for a job to run, else why it is skipped.

    First of equal job ids wins, in input order given by the unique `position`.
    """
    judged = first_wins(identify(jobs), ["job_id"], position)
    invalid, duplicate = F.col("job_id").isNull(), ~F.col("is_first")
    return judged.withColumns({
        "status": F.when(invalid, fv.STATUS_SKIPPED_INVALID).when(duplicate, fv.STATUS_SKIPPED_DUPLICATE),
        "reason": F.when(invalid, "invalid_job_input").when(duplicate, "duplicate_job"),
    }).drop("is_first")


def input_problem(site: Column, url: Column) -> Column:
    """Message for an unusable job."""
    return (
        F.when(is_blank_text(site), "site is required")
        .when(urls.image_site(site).isNull(), F.concat(F.lit("unsupported site "), site))
        .when(is_blank_text(url), "image_url is required")
    )
