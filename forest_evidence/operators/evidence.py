"""Evidence tables: manifests, diffs, runs, metrics, links, catalogues, integrity rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C

# What inventories leave out, and the roles of a report's artifacts, in order.
EXCLUDED_PARTS = [".git", "audit", "outputs", ".venv", "__pycache__"]
EXCLUDED_NAMES = ["keys.yml"]
EXCLUDED_SUFFIXES = [".pyc"]
HISTORY_KEY = ["dependency_id", "url", "discovered_by", "discovery_method"]
ORDERS = {"metrics": ["variable"], "tiles": ["tile_id", "layer", "local_path"], "artifacts": ["relpath"], "history": [*HISTORY_KEY, "status"], "bundles": ["bundle_date", "bundle_id", "relpath"], "index": ["bundle_date", "site_id", "run_name"]}
#: suffix -> role, in order
ROLES = {
    "/metrics.csv": "metrics_csv",
    "forest_loss_post_2020_mask.geojson": "forest_loss_mask",
    "forest_current_tree_cover_mask.geojson": "forest_current_mask",
    "forest_2000_tree_cover_mask.geojson": "forest_2000_mask",
    "forest_end_year_tree_cover_mask.geojson": "forest_end_year_mask",
    "forest_loss_post_2020_tiles.json": "hansen_tiles_manifest",
    "forest_loss_post_2020_summary.json": "forest_loss_summary",
    "forest_mask_debug.json": "forest_mask_debug",
    "map/map_config.json": "report_map_config",
    "maaamet_forest_area_crosscheck.csv": "maaamet_crosscheck_csv",
    "maaamet_forest_area_crosscheck_summary.json": "maaamet_crosscheck_summary",
    "maaamet_top10_parcels.geojson": "maaamet_top10_geojson",
    "maaamet_top10_parcels.csv": "maaamet_top10_csv",
    "maaamet_fields_inventory.json": "maaamet_fields_inventory",
    "maaamet_parcels_metadata.json": "maaamet_parcels_metadata",
}


def diff_artifacts(published: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """added, removed, changed (both hashes known), same; keys and sha256 on both sides."""
    a = published.select(*keys, F.col("sha256").alias("published_sha"), F.lit(1).alias("p"))
    b = local.select(*keys, F.col("sha256").alias("local_sha"), F.lit(1).alias("l"))
    both = a.join(b, keys, "full_outer")
    state = F.when(F.col("p").isNull(), "added").when(F.col("l").isNull(), "removed").when(F.col("published_sha") != F.col("local_sha"), "changed").otherwise("same")
    return both.select(*keys, state.alias("state"))


def diff_signatures(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Entries that differ; those without path or hash don't count."""
    known = lambda df: reduce(lambda d, c: d.where(F.col(c).isNotNull()), [*keys, "sha256"], df)
    return diff_artifacts(known(a), known(b), keys).where("state <> 'same'")


def folder_signatures(files: DataFrame, keys: list[str], top: bool = False) -> DataFrame:
    """keys, folder, n_files, size_bytes, signature of every folder (the top one is ''), with all that lies below it.

    A signature adds up the hashes of (path below the folder, content hash) in four parts of 60 bits, so files are
    combined before the shuffle in any order, a file counts in each folder above it without rounds over levels, and
    equal subtrees have equal signatures wherever they lie. ``files``: keys, relpath, sha256, where known size_bytes;
    a missing hash counts as an empty text. ``top``: the top folder alone."""
    parts = F.split("relpath", "/")
    depths = F.array(F.lit(0)) if top else F.sequence(F.lit(0), F.size(parts) - 1)
    size = F.col("size_bytes").cast("bigint") if "size_bytes" in files.columns else F.lit(None).cast("bigint")
    above = files.select(*keys, parts.alias("parts"), "sha256", size.alias("size_bytes"), F.explode(depths).alias("depth"))
    folder = F.array_join(F.slice("parts", 1, F.col("depth")), "/")
    below = F.array_join(F.slice("parts", F.col("depth") + 1, F.size("parts")), "/")
    own = F.sha2(F.concat(below, F.lit("\0"), F.coalesce(F.col("sha256"), F.lit(""))), 256)
    each = above.select(*keys, folder.alias("folder"), "size_bytes", *[F.conv(F.substring(own, 15 * i + 1, 15), 16, 10).cast("decimal(19,0)").alias(f"h{i}") for i in range(4)])
    sums = [F.sum(f"h{i}").cast("string") for i in range(4)]
    return each.groupBy(*keys, "folder").agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("size_bytes"), F.concat_ws("-", *sums).alias("signature"))


def diff_by_folders(published: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """What ``diff_signatures`` gives by keys and relpath, but files of folders that are equal on both sides leave
    before the two sides are joined. Paths are distinct within the keys of a side."""
    known = lambda df: reduce(lambda d, c: d.where(F.col(c).isNotNull()), [*keys, "relpath", "sha256"], df)
    a, b = known(published), known(local)
    inside = lambda df: df.withColumn("folder", F.when(F.contains("relpath", F.lit("/")), F.regexp_replace("relpath", "/[^/]*$", "")).otherwise(""))
    direct = lambda df: folder_signatures(inside(df).select(*keys, "folder", F.element_at(F.split("relpath", "/"), -1).alias("relpath"), "sha256").withColumnRenamed("folder", "direct"), [*keys, "direct"])
    equal = direct(a).join(direct(b), [*keys, "direct", "signature", "n_files"]).select(*keys, F.col("direct").alias("folder"))
    left = lambda df: inside(df).join(equal, [*keys, "folder"], "left_anti").drop("folder")
    return diff_signatures(left(a), left(b), [*keys, "relpath"])


def exclude_paths(df: DataFrame) -> DataFrame:
    """Rows whose path no rule of inventories leaves out."""
    parts = F.split("relpath", "/")
    name = F.element_at(parts, -1)
    bad = F.arrays_overlap(parts, F.array(*map(F.lit, EXCLUDED_PARTS))) | (name == ".env") | name.startswith(".env.") | name.isin(EXCLUDED_NAMES)
    return df.where(~reduce(lambda x, s: x | F.lower(name).endswith(s), EXCLUDED_SUFFIXES, bad))


def artifact_role(path: Column, aoi_id: Column, geometry: Column) -> Column:
    """Role of a report's artifact: its geometry, its own JSON and page, then by suffix; null if none."""
    out = F.when(path == geometry, "aoi_geometry").when(F.endswith(path, F.concat(F.lit("/"), aoi_id, F.lit(".json"))), "report_json")
    out = out.when(F.endswith(path, F.concat(F.lit("/"), aoi_id, F.lit(".html"))), "report_html")
    for suffix, role in ROLES.items():
        out = out.when(path.endswith(suffix), role)
    return out


def relative_path(path: Column, base: Column) -> Column:
    """Path of an artifact seen from a page in the folder ``base``: up to what both share, and down."""
    parts = lambda c: F.filter(F.split(c, "/"), lambda x: x != "")
    to, at = parts(path), parts(base)
    pairs = F.zip_with(to, at, lambda a, b: F.coalesce(a == b, F.lit(False)))
    shared = F.coalesce(F.nullif(F.array_position(pairs, False), F.lit(0)) - 1, F.size(pairs)).cast("int")
    shared = F.least(shared, F.size(to) - 1)  # a folder of the artifact's own name isn't the artifact
    up = F.array_repeat(F.lit(".."), F.size(at) - shared)
    return F.array_join(F.concat(up, F.slice(to, shared + 1, F.size(to))), "/")


def row_hash(*columns: str) -> Column:
    """SHA-256 of a row's JSON with sorted keys."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def latest_runs(runs: DataFrame, keep: int = 2, by: str = "site_id") -> DataFrame:
    if keep < 1:
        raise ValueError("keep at least one run")
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.desc("bundle_date"), F.desc("run_name")))
    return runs.withColumn("rank", rank).where(F.col("rank") <= keep)


def ordered(df: DataFrame, kind: str) -> DataFrame:
    return df.orderBy(*[c for c in ORDERS[kind] if c in df.columns])


def metric_rows(lines: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Typed metric rows, and the lines that aren't metrics."""
    parts = C.metric_parts(F.col(raw))
    all_ = lines.select("*", *[v.alias(k) for k, v in parts.items()])
    return all_.where("ok").drop("ok"), all_.where("not ok").select(*lines.columns)


def metrics_last(metrics: DataFrame, seq: str) -> DataFrame:
    """variable -> its last value, unit and notes."""
    return metrics.groupBy("variable").agg(*[F.max_by(c, seq).alias(c) for c in ("value", "unit", "notes")])


def metrics_map(metrics: DataFrame, seq: str) -> DataFrame:
    """One map of all variables; their number is bounded by the report contract."""
    one = metrics_last(metrics, seq)
    return one.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("variable", F.struct("value", "unit", "notes"))))).alias("metrics"))


def policy_refs(inline: DataFrame, lines: DataFrame) -> DataFrame:
    clean = lambda df: df.select(F.trim("ref").alias("ref")).where("ref <> ''")
    return clean(inline).union(clean(lines).where("ref not like '#%'")).distinct().orderBy("ref")


def declared_paths(declared: DataFrame, by: str, path: str, pos: str) -> DataFrame:
    """First-seen order without repeats."""
    return declared.groupBy(by, path).agg(F.min(pos).alias(pos))


# --- catalogue and links -------------------------------------------------------------------------


def join_families(catalogue: DataFrame, families: DataFrame) -> DataFrame:
    if "dataset_id" not in catalogue.columns or "dataset_id" not in families.columns:
        return catalogue
    return catalogue.join(families, "dataset_id", "left")


def normalised_links(df: DataFrame, contains: str | None = None) -> DataFrame:
    out = df.withColumn("dependency_id", F.trim("dependency_id")).withColumn("url", F.trim("url")).where("dependency_id <> '' and url <> ''")
    return out if contains is None else out.where(F.contains("dependency_id", F.lit(contains)))


def scored_links(links: DataFrame) -> DataFrame:
    return links.withColumn("score", C.link_score(F.col("http_status"), F.col("content_type"), F.col("expected_content_type"))).withColumn("family", C.link_family(F.col("dependency_id")))


def best_candidate(scored: DataFrame, by: str, current: Column) -> DataFrame:
    """The first of the best candidates that score above the current one."""
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.desc("score"), "probe"))
    return scored.where(F.col("score") > current).withColumn("rank", rank).where("rank = 1").drop("rank")


def link_summary(scored: DataFrame) -> DataFrame:
    ok = F.coalesce(F.col("http_status").between(200, 399), F.lit(False))
    return scored.agg(F.count("*").alias("checked"), F.count_if(~ok).alias("broken"))


def append_history(history: DataFrame, new: DataFrame, key: list[str] = HISTORY_KEY) -> DataFrame:
    """History with the new entries it lacks; doing it twice changes nothing."""
    fresh = new.dropDuplicates(key).join(history, key, "left_anti")
    return history.unionByName(fresh, allowMissingColumns=True)


def promote(registry: DataFrame, best: DataFrame, verified: Column | None = None) -> DataFrame:
    """The registry with better urls; fails on an id it doesn't have."""
    lone = best.join(registry, "dependency_id", "left_anti")
    if not lone.isEmpty():
        raise ValueError("a promoted dependency isn't in the registry")
    out = registry.join(best.select("dependency_id", F.col("url").alias("better")), "dependency_id", "left")
    out = out.withColumn("url", F.coalesce("better", "url"))
    return (out if verified is None else out.withColumn("verified_at", F.when(F.col("better").isNotNull(), verified).otherwise(F.col("verified_at")))).drop("better")


def page_artifacts(pages: DataFrame) -> DataFrame:
    """page_id, href, pos: links of each page, trimmed, first-seen order, distinct."""
    links = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))
    each = pages.select("page_id", F.posexplode(links).alias("pos", "href")).withColumn("href", F.trim("href")).where("href <> ''")
    return each.groupBy("page_id", "href").agg(F.min("pos").alias("pos"))


def generated_utc(html: Column) -> Column:
    """The time that follows ``Generated (UTC)`` in a code element, else in a table cell; null without either."""
    found = [F.regexp_extract(html, rf"(?is)Generated \(UTC\).*?<{tag}>([^<]+)</{tag}>", 1) for tag in ("code", "td")]
    return F.coalesce(*[F.when(v != "", F.regexp_replace(v, r"^\s+|\s+$", "")) for v in found])


def declared_artifacts(pages: DataFrame) -> DataFrame:
    """page_id, generated_utc, href, pos: links of each page's artifact lists, first-seen order, distinct.

    A list begins after a heading ``Artifacts`` or one with ``Declared evidence artifacts``, without inner
    tags, and goes on to the list's end. Pages without such a list have no row.
    """
    section = r"(?is)<h2\b[^>]*>(?:[^<]*declared evidence artifacts[^<]*|\s*artifacts\s*)</h2>(.*?)</ul>"
    lists = F.array_join(F.regexp_extract_all("html", F.lit(section), F.lit(1)), "\n")
    links = F.regexp_extract_all(lists, F.lit(r"""(?i)<a\s(?:[^>]*?\s)??href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""), F.lit(1))
    each = pages.select("page_id", generated_utc(F.col("html")).alias("generated_utc"), F.posexplode(links).alias("pos", "href"))
    each = each.withColumn("href", F.regexp_replace("href", r"""^["'\s]+|["'\s]+$""", "")).where("href <> ''")
    return each.groupBy("page_id", "generated_utc", "href").agg(F.min("pos").alias("pos"))


# --- integrity rules: rows (report_id, rule, detail) ----------------------------------------------


def dangling(references: DataFrame, known: DataFrame, keys: list[str], rule: str, detail: str) -> DataFrame:
    """References that name nothing known."""
    lone = references.join(known, keys, "left_anti")
    return lone.select("report_id", F.lit(rule).alias("rule"), F.col(detail).cast("string").alias("detail")).distinct()


def traceability_unknown(trace: DataFrame, known: dict[str, DataFrame]) -> DataFrame:
    parts = [dangling(trace.where(F.col(k).isNotNull()), v, ["report_id", k], f"unknown_{k}", k) for k, v in known.items()]
    return reduce(DataFrame.union, parts)


def untraced_results(results: DataFrame, trace: DataFrame) -> DataFrame:
    return dangling(results, trace, ["report_id", "result_id"], "untraced_result", "result_id")


def unflagged_results(results: DataFrame, assumptions: DataFrame) -> DataFrame:
    """Results that a non-testable assumption touches and that don't carry the flag."""
    touched = results.join(assumptions.where("not testable"), ["report_id", "result_id"], "left_semi")
    return touched.where("not flagged").select("report_id", F.lit("unflagged_result").alias("rule"), F.col("result_id").cast("string").alias("detail"))


def missing_blocks(reports: DataFrame, blocks: list[str], placeholder: Column | None = None) -> DataFrame:
    """Blocks that a report with loss (by its metrics or its results' evidence) must have; where ``placeholder`` is
    given, it must be false."""
    rows = reports.where("has_loss")
    if placeholder is not None:
        mock = rows.where(F.coalesce(placeholder, F.lit(True))).select("report_id", F.lit("placeholder_methodology").alias("rule"), F.lit("is_placeholder").alias("detail"))
        return missing_blocks(reports, blocks).union(mock)
    each = F.array_compact(F.array(*[F.when(F.col(b).isNull() | (F.trim(F.col(b).cast("string")) == ""), b) for b in blocks]))
    return rows.select("report_id", F.lit("missing_block").alias("rule"), F.explode(each).alias("detail"))


def assessable_but_missing(reports: DataFrame) -> DataFrame:
    bad = F.exists("classes", lambda c: c["mandatory"] & (c["status"] == "missing"))
    return reports.where(F.col("assessable") & bad).select("report_id", F.lit("assessable_with_missing_class").alias("rule"), F.lit("").alias("detail"))


def tiles_without_source(tiles: DataFrame) -> DataFrame:
    bad = F.col("local_path").isNotNull() & C.filled(F.col("source_url")).isNull()
    return tiles.where(bad).select("report_id", F.lit("tile_without_source").alias("rule"), F.col("tile_id").alias("detail"))


def reports_without_dependency(reports: DataFrame, dependencies: DataFrame, wanted: str = "hansen_gfc_2024_v1_12") -> DataFrame:
    """Reports with loss that name no raster data set: none at all, or not the wanted one."""
    named = dependencies.groupBy("report_id").agg(F.max((F.col("dependency_id") == wanted).cast("int")).alias("has"))
    got = reports.where("has_loss").join(named, "report_id", "left").where("coalesce(has, 0) = 0")
    return got.select("report_id", F.lit("missing_dependency").alias("rule"), F.when(F.col("has").isNull(), "none").otherwise(F.lit(wanted)).alias("detail"))


def class_status(classes: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Evidence class status from the artifacts there are."""
    n = artifacts.groupBy("report_id", "class_id").agg(F.count("*").alias("n"))
    got = classes.join(n, ["report_id", "class_id"], "left")
    return got.select("report_id", "class_id", F.when(F.col("n") > 0, "present").otherwise("missing").alias("status"))


#: Files that each published run must have.
RUN_FILES = ["report.html", "aoi_report.json"]


def publishable(runs: DataFrame, files: DataFrame, links: DataFrame, expected: int = 2, by: str = "site_id") -> DataFrame:
    """For each site its runs, how many lack a file of RUN_FILES (``files``: site, run_name, file) or a link from the
    index (``links``: site, href), and whether it can be published: just the expected runs, all whole."""
    keys = [by, "run_name"]
    has = files.where(F.col("file").isin(RUN_FILES)).groupBy(*keys).agg(F.countDistinct("file").alias("n_files"))
    linked = links.select(by, F.regexp_extract("href", r"(?:^|/)runs/([^/]+)/report\.html$", 1).alias("run_name")).distinct().withColumn("linked", F.lit(1))
    got = runs.select(*keys).distinct().join(has, keys, "left").join(linked, keys, "left")
    bad = F.coalesce(F.col("n_files"), F.lit(0)) < len(RUN_FILES)
    out = got.groupBy(by).agg(F.count("*").alias("n_runs"), F.count_if(bad).alias("n_without"), F.count_if(F.col("linked").isNull()).alias("n_unlinked"))
    return out.withColumn("ok", (F.col("n_runs") == expected) & (F.col("n_without") == 0) & (F.col("n_unlinked") == 0))


# The report contract's keys, enumerations, lengths and bounds, by path; [] enters a list's entries.
REPORT_KEYS = [
    "report_version", "generated_at_utc", "bundle_id", "report_metadata", "aoi_id", "aoi_geometry_ref", "inputs", "metrics", "evidence_artifacts", "evidence_registry",
    "acceptance_criteria", "regulatory_traceability", "assumptions", "policy_mapping_refs", "parameters", "datasets", "policy_mapping", "results_summary",
]
REPORT_REQUIRED = [
    "report_metadata.report_type", "report_metadata.regulatory_context", "report_metadata.assessment_capability", "aoi_geometry_ref.kind", "aoi_geometry_ref.value", "inputs.sources",
    "inputs.sources[].source_id", "evidence_artifacts[].relpath", "evidence_artifacts[].sha256", "evidence_registry.evidence_classes", "evidence_registry.evidence_classes[].class_id",
    "evidence_registry.evidence_classes[].mandatory", "evidence_registry.evidence_classes[].status", "acceptance_criteria[].criteria_id", "acceptance_criteria[].description",
    "acceptance_criteria[].evidence_classes", "acceptance_criteria[].decision_type", "results[].result_id", "results[].criteria_ids", "assumptions[].assumption_id", "assumptions[].testable",
    "regulatory_traceability[].regulation", "datasets[].dataset_id", "datasets[].retrieved_at_utc", "datasets[].license", "policy_mapping[].article_ref", "policy_mapping[].requirement",
    "policy_mapping[].evidence_fields", "policy_mapping[].artifact_relpaths", "policy_mapping[].status", "results_summary.aoi_area.area_ha", "results_summary.aoi_area.method",
]
REPORT_ENUMS = {
    "report_version": ["aoi_report_v2"], "report_metadata.report_type": ["example", "production", "test"], "report_metadata.assessment_capability": ["inspectable_only", "assessable"],
    "aoi_geometry_ref.kind": ["uri", "wkt", "geojson", "dataset_feature"], "evidence_registry.evidence_classes[].status": ["missing", "partial", "present"], "policy_mapping[].status": ["pass", "fail", "na"],
    "results_summary.deforestation_free_post_2020.status": ["pass", "fail", "na"],
}
REPORT_SHA = ["aoi_geometry_ref.sha256", "inputs.sources[].sha256", "evidence_artifacts[].sha256"]
REPORT_FILLED = ["bundle_id", "aoi_id", "aoi_geometry_ref.value", "inputs.sources[].source_id", "evidence_artifacts[].relpath", "datasets[].dataset_id", "datasets[].license", "policy_mapping[].article_ref", "policy_mapping[].requirement"]
REPORT_ITEMS = ["inputs.sources", "evidence_registry.evidence_classes", "acceptance_criteria", "acceptance_criteria[].evidence_classes", "results[].criteria_ids", "datasets", "policy_mapping", "policy_mapping[].evidence_fields", "policy_mapping[].artifact_relpaths"]
REPORT_MINIMUMS = {"evidence_artifacts[].size_bytes": 0, "map_assets.latest_year": 2000}


def _type_at(kind, path: str):
    """The type at a path of a schema; None if it isn't there."""
    for name in path.replace("[]", ".[]").split("."):
        if kind is None:
            return None
        if name == "[]":
            kind = kind.elementType if hasattr(kind, "elementType") else None
        else:
            kind = next((f.dataType for f in getattr(kind, "fields", []) if f.name == name), None)
    return kind


def _any_at(value: Column, names: list[str], bad) -> Column:
    """Whether ``bad`` holds of a value at a path: of any entry of the lists on the way."""
    for i, name in enumerate(names):
        if name == "[]":
            return F.coalesce(F.exists(value, lambda x: _any_at(x, names[i + 1 :], bad)), F.lit(False))
        value = value[name]
    return F.coalesce(bad(value), F.lit(False))


def _contract_found(schema, required: list[str], enums: dict[str, list[str]], sha: list[str], minimums: dict[str, float], filled: list[str] = (), items: list[str] = ()) -> Column:
    """An array of (rule, detail) of a row; see ``contract_errors``."""
    found = []

    def add(rule: str, path: str, bad) -> None:
        first, *names = path.replace("[]", ".[]").split(".")
        detail = F.struct(F.lit(rule).alias("rule"), F.lit(path).alias("detail"))
        if _type_at(schema, path) is None:
            if rule == "required" and "." not in path and "[]" not in path:
                found.append(detail)
            return
        found.append(F.when(_any_at(F.col(first), names, bad), detail))

    for p in required:
        add("required", p, lambda v: v.isNull())
    for p, values in enums.items():
        add("enum", p, lambda v, values=values: ~v.isin(values))
    for p in sha:
        add("sha256", p, lambda v: ~v.rlike("^[0-9a-f]{64}$"))
    for p, least in minimums.items():
        add("minimum", p, lambda v, least=least: v < least)
    for p in filled:
        add("min_length", p, lambda v: v == "")
    for p in items:
        add("min_items", p, lambda v: F.size(v) == 0)
    return F.array_compact(F.array(*found))


def contract_errors(reports: DataFrame, required: list[str], enums: dict[str, list[str]], sha: list[str], minimums: dict[str, float], filled: list[str] = (), items: list[str] = ()) -> DataFrame:
    """report_id, rule, detail: missing values, values outside enumerations, hashes that aren't SHA-256 hex, numbers
    under a minimum, empty texts and empty lists, by path. A field that the schema of ``reports`` lacks is missing
    in all of them if required, and right otherwise; what hangs on an absent optional block isn't missing."""
    found = _contract_found(reports.schema, required, enums, sha, minimums, filled, items)
    return reports.select("report_id", F.explode(found).alias("e")).select("report_id", "e.*")


def contract_column(schema) -> Column:
    """An array of (rule, detail): what a report of this schema breaks of the report contract."""
    return _contract_found(schema, [*REPORT_KEYS, *REPORT_REQUIRED], REPORT_ENUMS, REPORT_SHA, REPORT_MINIMUMS, REPORT_FILLED, REPORT_ITEMS)


def report_errors(reports: DataFrame) -> DataFrame:
    """``contract_errors`` of the report contract; reports as ``read_reports`` gives them, with a report_id."""
    return reports.select("report_id", F.explode(contract_column(reports.schema)).alias("e")).select("report_id", "e.*")
