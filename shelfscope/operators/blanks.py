"""Blank-field quality gate.

Per site, every field whose share of blank values reaches the threshold is a violation. A field
is checked only if at least one row of the site has the key, and rows without the key count as
blank; therefore raw records are profiled from JSON objects, not from an inferred schema.

All functions take `by`, columns that name a run. One job can then judge many runs at once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import jsons
from shelfscope.functions.text import display_ratio, is_blank_text, utc_iso
from shelfscope.functions.urls import gate_site


@dataclass(frozen=True)
class GateParams:
    blank_threshold: float = 0.8
    min_rows: int = 20

    def __post_init__(self) -> None:
        if not 0 <= self.blank_threshold <= 1:
            raise ValueError("blank_threshold must be in [0, 1]")
        if self.min_rows < 1:
            raise ValueError("min_rows must be >= 1")


@dataclass(frozen=True)
class Rule:
    """A gate rule: its id, the measure it shows and the test that makes a profile row a violation, from the gate's parameters."""

    name: str
    ratio: Callable[[], Column]
    breach: Callable[[Column, GateParams], Column]
    threshold: Callable[[GateParams], float]


#: The gate's rules in the order of their violations. Each looks at one (site, field) row of the profile.
RULES = [
    Rule(
        fv.BLANK_RULE, lambda: F.col("blank_count") / F.col("row_count"), lambda ratio, params: ratio >= params.blank_threshold,
        lambda params: params.blank_threshold,
    ),
]


def profile_records(records: DataFrame, by: list[str] = []) -> DataFrame:
    """`fields` map<string,variant> rows -> (by, site, field, row_count, blank_count).

    One scan and one aggregate: each row yields its keys plus one NULL key that counts the row
    itself. Map-side combining leaves one partial row per (site, field) and task, so a site with
    most of the rows costs no more shuffle than a small one. Blank = rows - non-blank values.
    """
    site = gate_site(jsons.as_text(jsons.present(F.col("fields"), "site")))
    entries = F.transform(
        F.map_entries("fields"),
        lambda e: F.struct(e["key"].alias("field"), (~jsons.is_blank(e["value"])).cast("int").alias("filled")),
    )
    row_itself = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(0).alias("filled")))
    cells = records.select(*by, site.alias("site"), F.explode(F.concat(row_itself, entries)).alias("cell"))
    counts = cells.groupBy(*by, "site", F.col("cell.field").alias("field")).agg(
        F.count("*").alias("n"), F.sum("cell.filled").alias("filled")
    )
    return _with_row_counts(counts, by)


def field_universe(records: DataFrame, by: list[str]) -> DataFrame:
    """Distinct keys seen per group."""
    return records.select(*by, F.explode(F.map_keys("fields")).alias("field")).distinct()


def profile_columns(rows: DataFrame, site: Column, fields: list[str], by: list[str] = []) -> DataFrame:
    """The same profile for a typed table: one wide aggregate, no explode of the data rows."""
    blank = {f: _blank_typed(rows, f) for f in fields}
    wide = rows.groupBy(*by, gate_site(site).alias("site")).agg(
        F.count("*").alias("row_count"), *[F.count_if(b).alias(f"_{i}") for i, b in enumerate(blank.values())]
    )
    cells = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("blank_count")) for i, f in enumerate(fields)
    ])
    return wide.select(*by, "site", F.inline(cells), "row_count").select(*by, "site", "field", "row_count", "blank_count")


def _blank_typed(rows: DataFrame, field: str) -> Column:
    kind = rows.schema[field].dataType.typeName()
    c = F.col(field)
    if kind == "string":
        return is_blank_text(c)
    if kind in ("array", "map"):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def _with_row_counts(counts: DataFrame, by: list[str]) -> DataFrame:
    """Puts the NULL-key row of a site (its row count) next to every field of the site.

    A window over the aggregated counts, so the data is read once. A site without any key keeps
    one row with a NULL field.
    """
    per_site = Window.partitionBy(*by, "site")
    placed = counts.withColumns({
        "row_count": F.max(F.when(F.col("field").isNull(), F.col("n"))).over(per_site),
        "n_fields": F.count("field").over(per_site),
    })
    return placed.where("field IS NOT NULL OR n_fields = 0").select(
        *by, "site", "field", "row_count", (F.col("row_count") - F.col("filled")).alias("blank_count")
    )


def judge_fields(profile: DataFrame, exceptions: DataFrame, params: GateParams, rules: list[Rule] = RULES) -> DataFrame:
    """Adds `is_checked`, the first rule's unrounded `ratio`, and `breaches`: a struct for every rule that the row breaks.

    A field is exempt for its site or for all sites ('*'): two equi joins, not one with OR. All
    rows stay, so every later figure comes from this one table.
    """
    everywhere = exceptions.where("site = '*'").select("field", F.lit(True).alias("_all"))
    by_site = exceptions.where("site <> '*'").select("site", "field", F.lit(True).alias("_own"))
    joined = profile.join(everywhere, "field", "left").join(by_site, ["site", "field"], "left")
    checked = (
        (F.col("row_count") >= params.min_rows) & F.col("field").isNotNull() & F.col("_all").isNull() & F.col("_own").isNull()
    )
    found = [
        F.when(checked & rule.breach(rule.ratio(), params), F.struct(
            F.lit(rule.name).alias("rule"), F.col("blank_count"), F.col("row_count"), display_ratio(rule.ratio()).alias("blank_ratio"),
            F.lit(rule.threshold(params)).alias("threshold"),
        ))
        for rule in rules
    ]
    return joined.select(
        *profile.columns, checked.alias("is_checked"), rules[0].ratio().alias("ratio"), F.array_compact(F.array(*found)).alias("breaches")
    )


def checked_fields(profile: DataFrame, exceptions: DataFrame, params: GateParams) -> DataFrame:
    """Non-exempt fields of large enough sites."""
    return judge_fields(profile, exceptions, params).where("is_checked").drop("is_checked", "breaches")


def violations(profile: DataFrame, exceptions: DataFrame, params: GateParams, by: list[str] = []) -> DataFrame:
    return judge_fields(profile, exceptions, params).select(*by, "site", "field", F.inline("breaches"))


def site_reports(profile: DataFrame, exceptions: DataFrame, params: GateParams, by: list[str] = []) -> DataFrame:
    """One row per site: counts, skip reason, exempt fields, violations sorted by field.

    One aggregate over the judged profile; the lists hold at most the fields of a site.
    """
    own_field = F.transform("breaches", lambda x: F.struct(
        F.col("field"), x["rule"].alias("rule"), x["blank_count"].alias("blank_count"), x["row_count"].alias("row_count"),
        x["blank_ratio"].alias("blank_ratio"), x["threshold"].alias("threshold")))
    found = F.flatten(F.collect_list(own_field))
    per_site = judge_fields(profile, exceptions, params).groupBy(*by, "site").agg(
        F.max("row_count").alias("row_count"), F.count_if("is_checked").alias("checked_fields"),
        F.array_sort(found).alias("violations"),
    )
    for_all = exceptions.where("site = '*'").agg(F.collect_set("field")).scalar()
    own = exceptions.where("site <> '*'").groupBy("site").agg(F.collect_set("field").alias("for_site"))
    none = F.array().cast("array<string>")
    small = F.col("row_count") < params.min_rows
    return per_site.join(own, "site", "left").select(
        *by, "site", "row_count", (~small).alias("blank_rule_checked"),
        F.when(small, F.concat(
            F.lit("row_count_below_min_rows_for_blank_check ("), F.col("row_count").cast("string"),
            F.lit(f" < {params.min_rows})"),
        )).alias("blank_rule_skipped_reason"),
        F.sort_array(F.array_union(F.coalesce(for_all, none), F.coalesce("for_site", none))).alias("exceptions"),
        "checked_fields", "violations",
    )


def _verdict_columns(params: GateParams, at: Column | None) -> list[Column]:
    total = F.coalesce(F.sum("row_count"), F.lit(0))
    bad = F.coalesce(F.sum(F.size("violations")), F.lit(0))
    return [
        F.when((total == 0) | (bad > 0), fv.GATE_FAIL).otherwise(fv.GATE_PASS).alias("status"),
        F.lit(fv.GATE_RULE_SET).alias("rule_set"),
        utc_iso(at if at is not None else F.current_timestamp()).alias("event_time_utc"),
        F.when(total == 0, "empty_input").when(bad > 0, "blank_field_threshold_breach")
        .otherwise("all_rules_passed").alias("reason"),
        total.cast("bigint").alias("total_rows"),
        F.lit(params.blank_threshold).alias("blank_threshold"),
        F.lit(params.min_rows).cast("bigint").alias("min_rows_for_blank_check"),
        F.when(total == 0, F.lit(1)).otherwise(bad).cast("bigint").alias("violations_count"),
    ]


def verdict(reports: DataFrame, params: GateParams, by: list[str] = [], at: Column | None = None) -> DataFrame:
    """One row per run; with no `by`, one row even for empty input, which is a failure. `at`: the report's time."""
    return reports.groupBy(*by).agg(*_verdict_columns(params, at))


def quality_report(reports: DataFrame, params: GateParams, by: list[str] = [], at: Column | None = None) -> DataFrame:
    """`verdict` plus the nested `sites` map: the report document, one row per run."""
    detail = F.struct(*[c for c in reports.columns if c not in (*by, "site")])
    entries = F.array_sort(F.collect_list(F.struct(F.col("site"), detail.alias("report"))))
    return reports.groupBy(*by).agg(*_verdict_columns(params, at), F.map_from_entries(entries).alias("sites"))


def run_gate(
    records: DataFrame, exceptions: DataFrame, params: GateParams | None = None, by: list[str] = [], at: Column | None = None
) -> DataFrame:
    """records (`fields` maps) -> report rows. The per-site reports are small; only counting them sees the data."""
    params = params or GateParams()
    return quality_report(site_reports(profile_records(records, by), exceptions, params, by), params, by, at)


def error_report(message: str, input_path: str, at: str) -> dict:
    """What a gate that could not run reports."""
    return {
        "event_time_utc": at, "status": fv.GATE_ERROR, "rule_set": fv.GATE_RULE_SET, "reason": "quality_gate_execution_error",
        "message": message, "input_jsonl_path": input_path, "violations_count": None,
    }
