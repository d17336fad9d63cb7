"""Integrity rules over nested reports: all of a report's references and what they name lie in its own row, so
the rules are set operations on arrays of the row and the reports are read once, without a join or a shuffle.

Reports have the contract's fields (``sources.REPORT_SCHEMA``) and a report_id. A field that their schema lacks
counts as absent in all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions import columns as C
from . import evidence as E

# The loss metric, the class that speaks of loss and the block that goes by its name, the wanted data
# set, and where reports refer to paths.
LOSS_METRIC = "pixel_forest_loss_post_2020_ha"
LOSS = "forest_loss_post_2020"
WANTED = "hansen_gfc_2024_v1_12"
LOSS_PATHS = [
    f"computed_outputs.{LOSS}.mask_geojson_ref.relpath", f"computed_outputs.{LOSS}.tiles_manifest_ref.relpath", "external_dependencies[].tiles_manifest.relpath",
    "validation.forest_area_crosscheck.csv_ref.relpath", "validation.forest_area_crosscheck.summary_ref.relpath",
]
POLICY_PATHS = ["policy_mapping[].artifact_relpaths[]"]
RESULTS, CLASSES, CRITERIA = "results[].result_id", "evidence_registry.evidence_classes[].class_id", "acceptance_criteria[].criteria_id"


def _steps(path: str) -> list[str]:
    return path.replace("[]", ".[]").split(".")


def _under(value: Column, kind: DataType, names: list[str]) -> Column | None:
    """An array of the values at a path below ``value``; None where the schema lacks it."""
    if not names:
        return F.array(value)
    name, rest = names[0], names[1:]
    if name == "[]":
        if not isinstance(kind, ArrayType) or _under(value, kind.elementType, rest) is None:
            return None
        return F.flatten(F.transform(value, lambda x: F.coalesce(_under(x, kind.elementType, rest), F.array())))
    if isinstance(kind, MapType):
        return _under(F.try_element_at(value, F.lit(name)), kind.valueType, rest)
    field = next((f for f in getattr(kind, "fields", []) if f.name == name), None)
    return None if field is None else _under(value[name], field.dataType, rest)


def values_at(schema: StructType, path: str, kind: str = "string") -> Column:
    """The values at a path of a row as an array without nulls; [] enters a list, other names fields or keys."""
    first, *names = _steps(path)
    field = next((f for f in schema.fields if f.name == first), None)
    found = None if field is None else _under(F.col(first), field.dataType, names)
    none = F.array().cast(f"array<{kind}>")
    return none if found is None else F.coalesce(F.array_compact(found).cast(f"array<{kind}>"), none)


def present(schema: StructType, path: str) -> Column:
    """Whether a row has a value (of any type) at a path."""
    first, *names = _steps(path)
    field = next((f for f in schema.fields if f.name == first), None)
    found = None if field is None else _under(F.col(first), field.dataType, names)
    return F.lit(False) if found is None else F.coalesce(F.exists(found, lambda v: v.isNotNull()), F.lit(False))


def entries_at(schema: StructType, path: str) -> tuple[Column, StructType] | None:
    """A list's entries and their type; None where the schema lacks the list."""
    first, *names = _steps(path)
    kind = E._type_at(schema, path)
    if kind is None:
        return None
    value = F.col(first)
    for n in names:
        value = value[n]
    return F.coalesce(F.array_compact(value), F.array().cast(kind.simpleString())), kind.elementType


def report_values(reports: DataFrame, below: list[str] | None = None) -> DataFrame:
    """report_id, pointer, value: every leaf of a report with its JSON pointer, in one pass; nulls have no row.

    ``below``: the fields whose leaves are wanted; the others aren't walked, nor taken out of the reports' JSON."""

    def walk(value: Column, kind: DataType, pointer: Column) -> Column:
        at = lambda name: F.concat(pointer, F.lit("/"), F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))
        if isinstance(kind, StructType):
            parts = [walk(value[f.name], f.dataType, at(F.lit(f.name))) for f in kind.fields]
            return F.concat(*parts) if parts else none
        if isinstance(kind, ArrayType):
            return F.coalesce(F.flatten(F.transform(value, lambda x, i: walk(x, kind.elementType, F.concat(pointer, F.lit("/"), i.cast("string"))))), none)
        if isinstance(kind, MapType):
            each = F.transform(F.map_entries(value), lambda e: walk(e["value"], kind.valueType, at(e["key"].cast("string"))))
            return F.coalesce(F.flatten(each), none)
        leaf = F.struct(pointer.alias("pointer"), value.cast("string").alias("value"))
        return F.when(value.isNotNull(), F.array(leaf)).otherwise(none)

    none = F.array().cast("array<struct<pointer:string,value:string>>")
    fields = [f for f in reports.schema.fields if f.name != "report_id" and (below is None or f.name in below)]
    all_ = F.concat(none, *[walk(F.col(f.name), f.dataType, F.lit(f"/{f.name}")) for f in fields])
    return reports.select("report_id", F.explode(all_).alias("v")).select("report_id", "v.*")


def _rows(rule: str, details: Column) -> Column:
    return F.transform(details, lambda d: F.struct(F.lit(rule).alias("rule"), d.alias("detail")))


def _one(rule: str, detail: str, bad: Column) -> Column:
    row = F.struct(F.lit(rule).alias("rule"), F.lit(detail).alias("detail"))
    return F.when(bad, F.array(row)).otherwise(F.array().cast("array<struct<rule:string,detail:string>>"))


def has_loss(schema: StructType) -> Column:
    """Whether a report speaks of loss after the cutoff: by a metric or by a result's evidence."""
    kind = E._type_at(schema, "metrics")
    named = F.coalesce(F.map_contains_key("metrics", LOSS_METRIC), F.lit(False)) if isinstance(kind, MapType) else present(schema, f"metrics.{LOSS_METRIC}")
    return named | F.array_contains(values_at(schema, "results[].evidence_classes[]"), LOSS)


def _unflagged(schema: StructType) -> Column:
    """Ids of results that a non-testable assumption touches and that don't carry the flag."""
    assumptions, results = entries_at(schema, "assumptions"), entries_at(schema, "results")
    if assumptions is None or results is None or not {"testable", "affects_results"} <= set(assumptions[1].names):
        return F.array().cast("array<string>")
    shaky = F.flatten(F.transform(F.filter(assumptions[0], lambda a: ~a["testable"]), lambda a: F.coalesce(a["affects_results"], F.array().cast("array<string>"))))
    flag = "non_testable_due_to_assumptions"
    bare = F.filter(results[0], lambda r: ~F.coalesce(r[flag], F.lit(False))) if flag in results[1].names else results[0]
    return F.array_intersect(F.transform(bare, lambda r: r["result_id"]), F.array_compact(shaky))


def _sourceless(schema: StructType) -> Column:
    """Ids of the tiles of local dependencies that name no source."""
    deps = entries_at(schema, "external_dependencies")
    kind = E._type_at(schema, "external_dependencies[].tiles_used[]")
    if deps is None or kind is None or "tile_source" not in deps[1].names:
        return F.array().cast("array<string>")
    tiles = F.flatten(F.transform(F.filter(deps[0], lambda d: d["tile_source"] == "local"), lambda d: F.coalesce(d["tiles_used"], F.array().cast(f"array<{kind.simpleString()}>"))))
    source = (lambda t: C.filled(t["source_url"])) if "source_url" in kind.names else (lambda t: F.lit(None))
    name = (lambda t: F.coalesce(t["tile_id"], F.lit(""))) if "tile_id" in kind.names else (lambda t: F.lit(""))
    return F.array_distinct(F.transform(F.filter(F.array_compact(tiles), lambda t: source(t).isNull()), name))


def _assessable(schema: StructType) -> Column:
    classes = entries_at(schema, "evidence_registry.evidence_classes")
    if classes is None or not {"mandatory", "status"} <= set(classes[1].names):
        return F.lit(False)
    lacking = F.exists(classes[0], lambda c: F.coalesce(c["mandatory"] & (c["status"] == "missing"), F.lit(False)))
    return lacking & F.array_contains(values_at(schema, "report_metadata.assessment_capability"), "assessable")


def integrity_column(schema: StructType) -> Column:
    """An array of (rule, detail) of a report: V2 to V10, each broken reference once."""
    at = lambda *paths: F.array_distinct(F.concat(*[values_at(schema, p) for p in paths]))
    filled = lambda values: F.filter(values, lambda v: v != "")
    trace = "regulatory_traceability[]"
    results, listed = at(RESULTS), at("evidence_artifacts[].relpath")
    loss = has_loss(schema)
    only_loss = lambda found: F.when(loss, found).otherwise(F.array().cast("array<struct<rule:string,detail:string>>"))
    blocks = [f"{b}.{LOSS}" for b in ("computed", "methodology", "computed_outputs")]
    placeholder = values_at(schema, f"methodology.{LOSS}.is_placeholder", "boolean")
    checked = "validation.forest_area_crosscheck"
    named = values_at(schema, "external_dependencies[].dependency_id")
    deps = entries_at(schema, "external_dependencies")
    no_deps = F.lit(True) if deps is None else F.size(deps[0]) == 0
    return F.concat(
        _rows("unknown_evidence_class", F.array_except(filled(at(f"{trace}.evidence_class")), at(CLASSES))),
        _rows("unknown_acceptance_criteria", F.array_except(filled(at(f"{trace}.acceptance_criteria")), at(CRITERIA))),
        _rows("unknown_result_ref", F.array_except(filled(at(f"{trace}.result_ref")), results)),
        _rows("untraced_result", F.array_except(results, at(f"{trace}.result_ref"))),
        _rows("unknown_result", F.array_except(at("assumptions[].affects_results[]"), results)),
        _rows("unknown_assumption", F.array_except(at("results[].assumption_refs[]"), at("assumptions[].assumption_id"))),
        _rows("unflagged_result", _unflagged(schema)),
        *[only_loss(_one("missing_block", b, ~present(schema, b))) for b in blocks],
        only_loss(_one("placeholder_methodology", "is_placeholder", present(schema, blocks[1]) & ~F.array_contains(placeholder, False))),
        only_loss(_rows("unlisted_path", F.array_except(at(*LOSS_PATHS), listed))),
        _rows("unlisted_path", F.array_except(F.when(loss, F.array_except(at(*POLICY_PATHS), at(*LOSS_PATHS))).otherwise(at(*POLICY_PATHS)), listed)),
        only_loss(_one("missing_dependency", "none", no_deps)),
        only_loss(_one("missing_dependency", WANTED, ~no_deps & ~F.array_contains(named, WANTED))),
        only_loss(_rows("tile_without_source", _sourceless(schema))),
        only_loss(_one("missing_outcome", f"{checked}.outcome", present(schema, checked) & (F.size(filled(at(f"{checked}.outcome"))) == 0))),
        _one("assessable_with_missing_class", "", _assessable(schema)),
    )


def _exploded(reports: DataFrame, rows: Column) -> DataFrame:
    """report_id and each of the rows; they are a column first, where Spark computes once what several rules share.
    A plain explode would have the column computed once more, to leave out empty ones."""
    each = reports.select("report_id", rows.alias("rows")).select("report_id", F.explode_outer("rows").alias("e"))
    return each.where("e is not null").select("report_id", "e.*")


def integrity_errors(reports: DataFrame) -> DataFrame:
    """report_id, rule, detail of V2 to V10."""
    return _exploded(reports, integrity_column(reports.schema))


def all_errors(reports: DataFrame) -> DataFrame:
    """report_id, rule, detail of the contract (V1) and of V2 to V10, in one pass over the reports."""
    both = F.concat(E.contract_column(reports.schema), integrity_column(reports.schema))
    return _exploded(reports, both)
