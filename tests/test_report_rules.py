"""Rules over nested reports: one accepted report, and what each change to it breaks."""

import copy
import json

import pytest

from forest_evidence import plans, sources
from forest_evidence.operators import report_rules as V

GOOD = {
    "report_id": "x", "report_version": "aoi_report_v2", "generated_at_utc": "2024", "bundle_id": "b", "aoi_id": "a",
    "report_metadata": {"report_type": "test", "regulatory_context": "EUDR", "assessment_capability": "assessable"},
    "aoi_geometry_ref": {"kind": "wkt", "value": "POINT"}, "inputs": {"sources": [{"source_id": "s"}]},
    "metrics": {V.LOSS_METRIC: {"value": 1.0, "unit": "ha"}},
    "evidence_artifacts": [{"relpath": p, "sha256": "0" * 64, "size_bytes": 1} for p in ("m", "t", "c", "s", "p")],
    "evidence_registry": {"evidence_classes": [{"class_id": "c1", "mandatory": True, "status": "present"}]},
    "acceptance_criteria": [{"criteria_id": "k1", "description": "d", "evidence_classes": ["c1"], "decision_type": "threshold"}],
    "results": [{"result_id": "r1", "criteria_ids": ["k1"], "assumption_refs": ["a1"], "non_testable_due_to_assumptions": True}],
    "regulatory_traceability": [{"regulation": "EUDR", "evidence_class": "c1", "acceptance_criteria": "k1", "result_ref": "r1"}],
    "assumptions": [{"assumption_id": "a1", "testable": False, "affects_results": ["r1"]}],
    "policy_mapping_refs": ["p"], "parameters": {}, "datasets": [{"dataset_id": "d", "retrieved_at_utc": "2024", "license": "free"}],
    "policy_mapping": [{"article_ref": "9", "requirement": "r", "evidence_fields": ["f"], "artifact_relpaths": ["p"], "status": "pass"}],
    "results_summary": {"aoi_area": {"area_ha": 1.0, "method": "geodesic"}},
    "computed": {V.LOSS: {"area": "1"}}, "methodology": {V.LOSS: {"is_placeholder": False}},
    "computed_outputs": {V.LOSS: {"mask_geojson_ref": {"relpath": "m"}, "tiles_manifest_ref": {"relpath": "t"}}},
    "external_dependencies": [{"dependency_id": V.WANTED, "tile_source": "local", "tiles_used": [{"tile_id": "1", "source_url": "u"}], "tiles_manifest": {"relpath": "t"}}],
    "validation": {"forest_area_crosscheck": {"outcome": "pass", "csv_ref": {"relpath": "c"}, "summary_ref": {"relpath": "s"}}},
}

#: (path of the change, its value; None deletes) -> rule and detail
CASES = [
    (("regulatory_traceability", 0, "evidence_class"), "no", ("unknown_evidence_class", "no")),
    (("regulatory_traceability", 0, "evidence_class"), "", None),
    (("regulatory_traceability", 0, "acceptance_criteria"), "no", ("unknown_acceptance_criteria", "no")),
    (("regulatory_traceability", 0, "result_ref"), "no", ("unknown_result_ref", "no"), ("untraced_result", "r1")),
    (("assumptions", 0, "affects_results"), ["r1", "no"], ("unknown_result", "no")),
    (("results", 0, "assumption_refs"), ["no"], ("unknown_assumption", "no")),
    (("results", 0, "non_testable_due_to_assumptions"), None, ("unflagged_result", "r1")),
    (("assumptions", 0, "testable"), True, None),
    (("computed",), None, ("missing_block", f"computed.{V.LOSS}")),
    (("computed_outputs",), None, ("missing_block", f"computed_outputs.{V.LOSS}")),
    (("methodology",), None, ("missing_block", f"methodology.{V.LOSS}")),
    (("methodology", V.LOSS, "is_placeholder"), True, ("placeholder_methodology", "is_placeholder")),
    (("methodology", V.LOSS, "is_placeholder"), None, ("placeholder_methodology", "is_placeholder")),
    (("computed_outputs", V.LOSS, "mask_geojson_ref", "relpath"), "no", ("unlisted_path", "no")),
    (("external_dependencies", 0, "tiles_manifest", "relpath"), "no", ("unlisted_path", "no")),
    (("validation", "forest_area_crosscheck", "csv_ref", "relpath"), "no", ("unlisted_path", "no")),
    (("policy_mapping", 0, "artifact_relpaths"), ["p", "no"], ("unlisted_path", "no")),
    (("validation", "forest_area_crosscheck", "outcome"), None, ("missing_outcome", "validation.forest_area_crosscheck.outcome")),
    (("validation",), None, None),
    (("external_dependencies",), [], ("missing_dependency", "none")),
    (("external_dependencies", 0, "dependency_id"), "other", ("missing_dependency", V.WANTED)),
    (("external_dependencies", 0, "tiles_used", 0, "source_url"), " ", ("tile_without_source", "1")),
    (("external_dependencies", 0, "tile_source"), "url", None),
    (("evidence_registry", "evidence_classes", 0, "status"), "missing", ("assessable_with_missing_class", "")),
    (("evidence_artifacts", 0, "sha256"), "xyz", ("sha256", "evidence_artifacts[].sha256")),
    (("aoi_id",), None, ("required", "aoi_id")),
    (("report_version",), "v9", ("enum", "report_version")),
]


def changed(path, value):
    out = copy.deepcopy(GOOD)
    at = out
    for p in path[:-1]:
        at = at[p]
    if value is None:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return out


@pytest.fixture(scope="module")
def reports(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("reports") / "reports.json"
    rows = [GOOD] + [changed(p, v) | {"report_id": str(i)} for i, (p, v, *_) in enumerate(CASES)]
    quiet = {k: v for k, v in changed(("metrics",), {}).items() if k not in ("computed", "methodology", "computed_outputs", "external_dependencies")}
    path.write_text("\n".join(json.dumps(r) for r in [*rows, quiet | {"report_id": "quiet"}]) + '\n{"report_id": ')
    return sources.read_reports(spark, str(path), whole=False)


def test_each_change_breaks_its_own_rule(reports):
    got = {}
    for r in V.all_errors(reports[0]).collect():
        got.setdefault(r.report_id, []).append((r.rule, r.detail))
    want = {str(i): sorted(e for e in errors if e) for i, (_, _, *errors) in enumerate(CASES)}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert reports[1].count() == 1


def test_rules_read_reports_once(reports):
    plan = V.all_errors(reports[0])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_fields_that_the_schema_lacks(spark):
    bare = spark.createDataFrame([("x", [("r1",)]), ("y", None)], "report_id string, results array<struct<result_id:string>>")
    assert [tuple(r) for r in V.integrity_errors(bare).collect()] == [("x", "untraced_result", "r1")]
    assert V.all_errors(bare.where("report_id = 'none'")).count() == 0
    assert V.integrity_errors(spark.createDataFrame([("x",)], "report_id string")).count() == 0


def test_values_have_pointers(reports):
    got = {(r.pointer, r.value) for r in V.report_values(reports[0].where("report_id = 'x'")).collect()}

    def walk(at, pointer):
        for k, v in at.items() if isinstance(at, dict) else enumerate(at):
            if isinstance(v, (dict, list)):
                yield from walk(v, f"{pointer}/{k}")
            else:
                yield f"{pointer}/{k}", str(v).lower() if isinstance(v, bool) else str(v)

    assert got == {(p, v) for p, v in walk(GOOD, "") if p != "/report_id"}


def test_reports_are_parsed_once(spark, tmp_path, monkeypatch):
    """One from_json for the filter and the fields, one evaluation of the rules; wanted fields alone are walked."""
    (tmp_path / "r.json").write_text('{"report_id": "a", "metrics": {"m": {"value": 1.0}}, "results": [{"result_id": "r"}]}\n{"report_id": \n')
    rows, broken = sources.read_reports(spark, str(tmp_path), whole=False)
    plan = V.integrity_errors(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("unknown_result_ref") == 1
    assert broken.count() == 1
    assert [tuple(r) for r in V.report_values(rows, ["metrics"]).collect()] == [("a", "/metrics/m/value", "1.0")]
    assert {r.pointer for r in V.report_values(rows).collect()} == {"/metrics/m/value", "/results/0/result_id"}


@pytest.mark.parametrize("name", ["v2_to_v10_nested_reports", "s8_report_values"])
def test_staged_reports_are_small(spark, tmp_path, monkeypatch, name):
    """Reports spell the names of their fields over and over, so what is staged is a small part of the JSON, in files of a few reports."""
    monkeypatch.setattr(sources, "REPORTS_PER_FILE", 1000, raising=False)
    monkeypatch.setattr(sources, "scratch", lambda _: f"{tmp_path}/staged")
    lines = spark.range(20_000).selectExpr("id % 5000 AS l_orderkey", "id * 7919 % 2003 AS l_partkey", "id * 31 % 101 AS l_suppkey", "cast(id % 7 AS int) + 1 AS l_linenumber", "substr('RAN', cast(id % 3 AS int) + 1, 1) AS l_returnflag", "cast(id % 50 AS double) AS l_quantity")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert plans.queries()[name](spark, str(tmp_path)).select("report_id").distinct().count() > 1000
    files, text = [*(tmp_path / "staged").glob("part-*")], spark.read.text(f"{tmp_path}/staged")
    assert text.count() == 5000
    assert sum(f.stat().st_size for f in files) * 8 < text.selectExpr("sum(length(value))").first()[0]
    assert all(spark.read.text(str(f)).count() <= 1000 for f in files)
