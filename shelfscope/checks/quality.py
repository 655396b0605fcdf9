"""The blank-field gate over documents and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.checks.registry import query, table
from shelfscope.operators import blanks
from shelfscope.plans import models
from shelfscope.sources import config, lines

PARAMS = blanks.GateParams(blank_threshold=0.6, min_rows=8)
REPORT_TIME = "2024-02-01 10:20:30"
EXCEPTIONS = {"*": ["toxic"], " SRC1-en ": ["quality"], "src2-en": ["quality", " lang "]}

# Documents with their labels; a label key is absent, not null, where there is none.
ROWS_SQL = """
d AS (SELECT d.source || '-' || d.lang AS site, d.source, d.doc_id, d.text, d.lang, l.quality, l.toxic
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def _profile_sql(group: str) -> str:
    def one(field: str, blank: str) -> str:
        return (f"SELECT {group}, '{field}' AS field, count(*) AS row_count, "
                f"count(*) FILTER (WHERE {blank}) AS blank_count, count({field}) AS seen FROM d GROUP BY {group}")

    parts = [one("doc_id", "doc_id IS NULL"), one("quality", "quality IS NULL"), one("toxic", "toxic IS NULL")]
    parts += [one(f, f"{f} IS NULL OR NOT regexp_matches({f}, '[^\\s]')") for f in ("site", "text", "lang")]
    return "p AS (SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE seen > 0)"


PROFILE_SQL = f"WITH {ROWS_SQL}, {_profile_sql('site')}"
CHECKED_SQL = PROFILE_SQL + """,
c AS (SELECT site, field, row_count, blank_count, blank_count / row_count AS r FROM p
      WHERE row_count >= 8 AND field <> 'toxic' AND NOT (site = 'src1-en' AND field = 'quality')
        AND NOT (site = 'src2-en' AND field IN ('quality', 'lang')))
"""
VIOLATIONS_SQL = CHECKED_SQL + """
SELECT site, 'field_blankness_threshold' AS rule, field, blank_count, row_count,
       round_even(r, 4) AS blank_ratio, 0.6::DOUBLE AS threshold FROM c WHERE r >= 0.6
"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").withColumn("site", F.concat_ws("-", "source", "lang"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as JSON lines, parsed strictly."""
    rows = labelled_documents(spark, sf_dir)
    value = F.to_json(F.struct("site", "doc_id", "text", "lang", "quality", "toxic"))
    return lines.strict_records(rows.select(F.col("source").alias("run"), value.alias("value")))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    exceptions = config.exceptions_from_dict(spark, EXCEPTIONS)
    return blanks.site_reports(blanks.profile_records(records(spark, sf_dir)), exceptions, PARAMS)


@query(PROFILE_SQL + " SELECT site, field, row_count, blank_count FROM p")
def blank_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank counts per site and field from raw JSON lines."""
    return blanks.profile_records(records(spark, sf_dir))


@query(PROFILE_SQL + """ SELECT site, field, max(row_count) AS row_count, max(blank_count) AS blank_count FROM (
  SELECT site, field, row_count, blank_count FROM p
  UNION ALL SELECT site, f.field, count(*), count(*) FROM d, (VALUES ('quality'), ('toxic')) AS f(field)
            WHERE (f.field = 'quality' AND quality IS NULL) OR (f.field = 'toxic' AND toxic IS NULL) GROUP BY ALL
) WHERE field <> 'site' GROUP BY site, field""")
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a typed table, where every column exists for every site."""
    rows = labelled_documents(spark, sf_dir)
    return blanks.profile_columns(rows, F.col("site"), ["doc_id", "text", "lang", "quality", "toxic"])


@query(VIOLATIONS_SQL)
def blank_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    exceptions = config.exceptions_from_dict(spark, EXCEPTIONS)
    return blanks.violations(blanks.profile_records(records(spark, sf_dir)), exceptions, PARAMS)


@query(CHECKED_SQL + """,
t AS (SELECT site, count(*) AS row_count FROM d GROUP BY site),
k AS (SELECT site, count(*) AS checked_fields, count(*) FILTER (WHERE r >= 0.6) AS n_violations FROM c GROUP BY site)
SELECT t.site, t.row_count, t.row_count >= 8 AS blank_rule_checked,
  CASE WHEN t.row_count < 8 THEN 'row_count_below_min_rows_for_blank_check (' || t.row_count || ' < 8)' END AS blank_rule_skipped_reason,
  CASE t.site WHEN 'src1-en' THEN 'quality,toxic' WHEN 'src2-en' THEN 'lang,quality,toxic' ELSE 'toxic' END AS exceptions,
  coalesce(k.checked_fields, 0) AS checked_fields, coalesce(k.n_violations, 0) AS n_violations
FROM t LEFT JOIN k ON t.site = k.site
""")
def site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-site part of the report."""
    return reports(spark, sf_dir).select(
        "site", "row_count", "blank_rule_checked", "blank_rule_skipped_reason",
        F.array_join("exceptions", ",").alias("exceptions"), F.col("checked_fields").cast("bigint").alias("checked_fields"),
        F.size("violations").cast("bigint").alias("n_violations"),
    )


@query(CHECKED_SQL + """,
v AS (SELECT count(*) FILTER (WHERE r >= 0.6) AS n FROM c)
SELECT CASE WHEN n > 0 THEN 'fail_quality' ELSE 'pass' END AS status, 'default' AS rule_set,
  CASE WHEN n > 0 THEN 'blank_field_threshold_breach' ELSE 'all_rules_passed' END AS reason,
  (SELECT count(*) FROM d) AS total_rows, 0.6::DOUBLE AS blank_threshold, 8::BIGINT AS min_rows_for_blank_check,
  n AS violations_count, '2024-02-01T10:20:30Z' AS event_time_utc FROM v
""")
def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blanks.verdict(reports(spark, sf_dir), PARAMS, at=F.lit(REPORT_TIME).cast("timestamp_ntz"))


@query(f"""WITH {ROWS_SQL}, {_profile_sql('source, site')},
c AS (SELECT source AS run, count(*) FILTER (WHERE blank_count / row_count >= 0.6) AS n FROM p
      WHERE row_count >= 8 GROUP BY source)
SELECT t.run, CASE WHEN coalesce(n, 0) > 0 THEN 'fail_quality' ELSE 'pass' END AS status, t.total_rows, coalesce(n, 0) AS violations_count
FROM (SELECT source AS run, count(*) AS total_rows FROM d GROUP BY source) t LEFT JOIN c ON t.run = c.run
""")
def verdict_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many runs judged in one job, no exceptions."""
    none = config.exceptions_from_dict(spark, None)
    per_site = blanks.site_reports(blanks.profile_records(records(spark, sf_dir), ["run"]), none, PARAMS, ["run"])
    return blanks.verdict(per_site, PARAMS, ["run"]).select("run", "status", "total_rows", "violations_count")


@query(VIOLATIONS_SQL)
def report_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations read back from the nested report text."""
    report = blanks.quality_report(reports(spark, sf_dir), PARAMS)
    raw = report.select(F.lit("run").alias("run_id"), F.to_json(F.struct("*")).alias("raw_json"))
    return models.quality_violations(raw).select(
        F.col("report_site").alias("site"), "rule", "field", "blank_count", "row_count", "blank_ratio", "threshold"
    )


@query(CHECKED_SQL + """
SELECT 'run' AS run_id, CASE WHEN count(*) FILTER (WHERE r >= 0.6) > 0 THEN 'fail_quality' ELSE 'pass' END AS status,
  CASE WHEN count(*) FILTER (WHERE r >= 0.6) > 0 THEN 'blank_field_threshold_breach' ELSE 'all_rules_passed' END AS reason,
  (SELECT count(*) FROM d) AS total_rows, count(*) FILTER (WHERE r >= 0.6) AS violations_count, 0.6::DOUBLE AS blank_threshold,
  '2024-02-01T10:20:30Z' AS event_time_utc FROM c
""")
def silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary columns of the raw quality table."""
    report = blanks.quality_report(reports(spark, sf_dir), PARAMS, at=F.lit(REPORT_TIME).cast("timestamp_ntz"))
    raw = report.select(
        F.lit("run").alias("run_id"), F.to_json(F.struct("*")).alias("raw_json"), F.lit("s").alias("site"), F.lit("d").alias("dt")
    )
    return models.silver_quality(raw).select(
        "run_id", "status", "reason", "total_rows", "violations_count", "blank_threshold", "event_time_utc"
    )


@query("SELECT DISTINCT event_type, field FROM (SELECT event_type, unnest(json_keys(props)) AS field FROM events)")
def json_field_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys seen in the raw records of every group."""
    parsed = lines.parse_lines(table(spark, sf_dir, "events").select("event_type", F.col("props").alias("value")))
    return blanks.field_universe(parsed, ["event_type"])


@query("SELECT lower(r_name) AS site, n_name AS field FROM nation JOIN region ON n_regionkey = r_regionkey")
def exception_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exception document per region, read into pairs."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    document = F.to_json(F.create_map("r_name", F.array(F.concat(F.lit(" "), "n_name"), F.lit(" "))))
    return config.exceptions_from_text(nations.select(document.alias("value")))
