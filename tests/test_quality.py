"""The blank-field gate."""

import json
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfscope.operators import blanks
from shelfscope.plans import post_run
from shelfscope.sources import config, lines


def gate(spark, rows, params, exceptions=None):
    frame = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    return blanks.run_gate(lines.strict_records(frame), config.exceptions_from_dict(spark, exceptions), params).first()


def row(i, **more):
    return {"site": "farfetch", "primary_key": f"p{i}", "url": f"u{i}", **more}


def test_threshold_is_inclusive(spark):
    rows = [row(i, primary_label=None if i < 8 else "New") for i in range(10)]
    report = gate(spark, rows, blanks.GateParams(0.8, 5))
    assert (report["status"], report["reason"], report["violations_count"], report["total_rows"]) == (
        "fail_quality", "blank_field_threshold_breach", 1, 10)
    found = report["sites"]["farfetch"]["violations"]
    assert [(v["field"], v["blank_count"], v["blank_ratio"]) for v in found] == [("primary_label", 8, 0.8)]


def test_exception_exempts_the_field(spark):
    rows = [row(i, primary_label=None if i < 9 else "New") for i in range(10)]
    for exceptions in ({"farfetch": ["primary_label"]}, {" * ": [" primary_label "]}):
        report = gate(spark, rows, blanks.GateParams(0.8, 5), exceptions)
        assert report["status"] == "pass" and report["sites"]["farfetch"]["exceptions"] == ["primary_label"]
        assert report["sites"]["farfetch"]["checked_fields"] == 3


def test_small_site_is_skipped(spark):
    report = gate(spark, [row(i, primary_label=None) for i in range(3)], blanks.GateParams(0.8, 10))
    site = report["sites"]["farfetch"]
    assert report["status"] == "pass" and not site["blank_rule_checked"] and site["checked_fields"] == 0
    assert site["blank_rule_skipped_reason"] == "row_count_below_min_rows_for_blank_check (3 < 10)"


def test_missing_key_is_blank_and_alias_merges(spark):
    rows = [{"site": "level", "a": 1, **({"color": "red"} if i == 0 else {})} for i in range(10)]
    report = gate(spark, rows, blanks.GateParams(0.8, 5))
    assert list(report["sites"]) == ["level-shoes"]
    assert [(v["field"], v["blank_count"]) for v in report["sites"]["level-shoes"]["violations"]] == [("color", 9)]


def test_blank_forms(spark):
    values = [[], {}, "  ", [None], 0, False, "[]", None]
    rows = [{"site": "s", "v": v} for v in values]
    profile = blanks.profile_records(lines.strict_records(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")))
    assert profile.where("field = 'v'").first()["blank_count"] == 4


def test_empty_input_fails(spark):
    report = gate(spark, [], blanks.GateParams())
    assert (report["status"], report["reason"], report["violations_count"], report["sites"]) == ("fail_quality", "empty_input", 1, {})


def test_bad_parameters():
    for bad in ((1.5, 5), (-0.1, 5), (0.5, 0)):
        with pytest.raises(ValueError):
            blanks.GateParams(*bad)


def test_ratio_display_ties_to_even(spark):
    rows = [{"site": "s", "v": None if i < 1 else i} for i in range(32)]
    report = gate(spark, rows, blanks.GateParams(0.03, 5))
    assert report["sites"]["s"]["violations"][0]["blank_ratio"] == round(1 / 32, 4) == 0.0312


def brute_force(rows, threshold, min_rows):
    """Counts by plain loops, for small inputs."""
    by_site = defaultdict(list)
    for r in rows:
        by_site[r["site"]].append(r)
    found = set()
    for site, members in by_site.items():
        if len(members) < min_rows:
            continue
        for name in {k for m in members for k in m}:
            blank = sum(1 for m in members if m.get(name) in (None, "", [], {}) and m.get(name) is not False)
            if blank / len(members) >= threshold:
                found.add((site, name, blank))
    return found


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries({"site": st.sampled_from("ab")}, optional={k: st.sampled_from([None, "", [], {}, "x", 1]) for k in "pqr"}), min_size=1, max_size=30))
def test_gate_matches_brute_force(spark, rows):
    report = gate(spark, rows, blanks.GateParams(0.5, 3))
    got = {(s, v["field"], v["blank_count"]) for s, r in report["sites"].items() for v in r["violations"]}
    assert got == brute_force(rows, 0.5, 3)


def test_exception_sources(spark, tmp_path):
    path = tmp_path / "e.json"
    path.write_text('{"level": ["a", " "], "*": ["b"]}')
    got = {tuple(r) for r in config.exception_rows(spark, exceptions_file=str(path)).collect()}
    assert got == {("level-shoes", "a"), ("*", "b")}
    with pytest.raises(ValueError):
        config.exception_rows(spark, "{}", str(path))
    with pytest.raises(Exception):
        config.exception_rows(spark, '{"a": "not a list"}').collect()


def test_post_run_steps(spark, tmp_path):
    records = tmp_path / "records.jsonl"
    records.write_text("".join(json.dumps(row(i, name="é"), ensure_ascii=False) + "\n" for i in range(25)), encoding="utf-8")
    run = post_run.Run(
        "2024-03-04T05-06-07-089", "farfetch", start_time="2024-03-04 05:00:00", finish_time="2024-03-04 05:01:30.5",
        counters={"downloader/response_status_count/200": 20, "downloader/request_count": 30, "other": 1},
        arguments={"urls": "a", "secret": "b"})
    out = post_run.close_run(spark, run, str(records), str(tmp_path / "lake"))
    assert spark.read.text(out["sample"]).count() == 3
    report = json.loads(spark.read.text(out["report"]).first()["value"])
    assert report["status"] == "pass" and report["sites"]["farfetch"]["row_count"] == 25
    manifest = json.loads(spark.read.text(out["manifest"]).first()["value"])
    assert manifest["stats"] == {"items_scraped": 25, "requests_made": 30, "errors_count": 0, "status_code_counts": {"200": 20}}
    assert manifest["entry_points"] == {"urls": "a"} and manifest["duration_seconds"] == 90.5
    assert manifest["artifacts"]["rows"] == 25 and manifest["artifacts"]["compressed"] is True
    assert manifest["quality_gate"]["status"] == "pass"
    assert manifest["bronze_verification"]["expected"]["hashes"] == manifest["artifacts"]["hashes"]["sha256"]
    assert "é" in spark.read.text(out["data"]).first()["value"]


def test_gate_that_cannot_run_reports_an_error(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text("{oops\n")
    for path, exceptions in ((str(tmp_path / "bad.jsonl"), None), (str(tmp_path / "bad.jsonl"), str(tmp_path / "none.json")), (str(tmp_path / "absent"), None)):
        report = json.loads(post_run.gate_report(spark, path, blanks.GateParams(), exceptions).first()["raw"])
        assert (report["status"], report["reason"], report["violations_count"]) == ("error", "quality_gate_execution_error", None)
