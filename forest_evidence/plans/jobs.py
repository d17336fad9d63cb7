"""Jobs that chain operators over many areas, parcels, runs or links at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import parcels as P
from ..operators import report_rules as V
from ..operators import spatial as S
from ..operators import zonal as Z


def aoi_evidence(zones: DataFrame, pixels: DataFrame, tiles: DataFrame, areas: DataFrame, threshold: int, cutoff: int, end_year: int, area_m2: Column, rule: str = "center") -> DataFrame:
    """Forest metrics, cover summary and pixel diagnostics of each zone with its area (zone_id, aoi_ha), the tiles it
    reaches and its loss status; zones without a valid pixel have zeros."""
    zoned = S.zone_pixels(zones, pixels, tiles, rule)
    metrics = Z.forest_metrics(zoned, threshold, cutoff, end_year, area_m2).drop("loss_pct")
    counts = Z.pixel_diagnostics(zoned, threshold, area_m2).select("zone_id", "n_reference", "n_loss", "n_never_lost", "n_tree_missing", "n_loss_missing")
    reached = S.tile_spans(zones, tiles, rule).groupBy("zone_id").agg(F.array_join(F.array_sort(F.collect_set("tile_id")), "|").alias("tile_ids"))
    out = areas.join(metrics, "zone_id", "left").join(counts, "zone_id", "left").join(reached, "zone_id", "left")
    out = out.fillna(0.0, [c for c in metrics.columns if c != "zone_id"]).fillna(0, [c for c in counts.columns if c != "zone_id"])
    return P.loss_status(out, F.col("aoi_ha"), F.col("loss_after_ha")).withColumnRenamed("loss_pct", "loss_pct_of_aoi")


def parcels(features: DataFrame, label: Column, stats: DataFrame, n: int = 10) -> DataFrame:
    """Parcels with land and forest area, the designation, raster statistics where there are any (parcel_id,
    raster_land_ha, raster_forest_ha, raster_loss_ha), and whether they are among an area's top n, by raster first."""
    own = P.attach_stats(P.with_forest_area(features).withColumn("designation", label), stats, ["parcel_id"])
    top = P.top_parcels(own, n, prefer_raster=True).select("aoi_id", "parcel_id", F.lit(True).alias("top"))
    return own.join(top, ["aoi_id", "parcel_id"], "left").fillna(False, ["top"])


def parcel_summary(parcels: DataFrame, by: str = "aoi_id") -> DataFrame:
    """For each area the parcels' count, designations, fields used, and land totals of raster and register."""
    totals = P.land_area_totals(parcels, F.col("raster_land_ha"), F.col("land_ha"), by)
    return P.parcel_metadata(parcels, F.col("designation"), by).join(P.fields_used(parcels, by), by, "left").join(totals, by, "left")


def crosscheck(parcels: DataFrame, computed: DataFrame, tolerance_percent: float = 5.0) -> DataFrame:
    """Each parcel and each area's total against the area's computed forest (aoi_id, computed_ha), with
    the one source and method of the reference areas or ``mixed``."""
    both = parcels.join(computed, "aoi_id")
    total = P.crosscheck_total(both, F.max("computed_ha"), tolerance_percent)
    total = total.select("aoi_id", F.col("diff_pct").alias("total_diff_pct"), F.col("outcome").alias("total_outcome"), F.col("reason").alias("total_reason"))
    one = [P.single_or_mixed(F.col(c)).alias(f"total_{c}") for c in ("reference_source", "method")]
    return P.crosscheck_rows(both, F.col("computed_ha")).join(total, "aoi_id").join(parcels.groupBy("aoi_id").agg(*one), "aoi_id")


#: The criterion of reports where no others are given: outcome by the row's own status.
NO_LOSS = ("no_loss_after_cutoff", "no loss of forest after the cutoff", "loss_after_ha")


def _listed(rows: DataFrame | None, name: str, kind: str) -> Callable[[DataFrame], DataFrame]:
    """Adds a short list that all reports share as an array (one row, broadcast); empty without ``rows``."""
    if rows is None:
        return lambda df: df.withColumn(name, F.array().cast(f"array<{kind}>"))
    fields = [f.split(":")[0] for f in kind[7:-1].split(",")]
    one = rows.agg(F.array_sort(F.collect_set(F.struct(*fields).cast(kind))).alias(name))
    return lambda df: df.crossJoin(F.broadcast(one))


def reports(
    metrics: DataFrame, artifacts: DataFrame, refs: DataFrame, run_id: str, key: str = "aoi_id", criteria: DataFrame | None = None, assumptions: DataFrame | None = None,
    datasets: DataFrame | None = None, tiles: DataFrame | None = None, classes: DataFrame | None = None, geometry: Column | None = None, generated_at: str = "1970-01-01T00:00:00Z", regulation: str = "EUDR",
) -> DataFrame:
    """A nested report of the contract for each row of ``metrics`` (its numbers, the status, aoi_ha where known).

    ``artifacts``: key, class_id, relpath and where known sha256, size_bytes. ``classes`` (class_id): those that every
    report has an entry for, if no report has an artifact of one, too; else those that artifacts have. ``criteria``: criteria_id, description,
    class_id, metric, most (a result passes up to there). ``assumptions``: assumption_id, testable, result_id.
    ``refs`` (ref), criteria, assumptions and ``datasets`` (dataset_id, retrieved_at_utc, license) belong to the run:
    short lists that are broadcast. ``tiles``: key, dependency_id, tile_source, tile_id, source_url.
    """
    names = [c for c, kind in metrics.dtypes if kind == "double"]
    unit = lambda c: F.lit("percent" if "_pct" in c else "ha")
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.struct(F.col(c).alias("value"), unit(c).alias("unit"), F.lit("").alias("notes")).alias("value")) for c in names])
    declared = (artifacts if classes is None else classes).select("class_id").distinct()
    ids = metrics.select(F.col(key).alias("report_id")).crossJoin(F.broadcast(declared))
    status = E.class_status(ids, artifacts.withColumnRenamed(key, "report_id"))
    classes = status.groupBy(F.col("report_id").alias(key)).agg(F.array_sort(F.collect_list(F.struct("class_id", F.lit(True).alias("mandatory"), "status"))).alias("evidence_classes"))
    known = lambda c, kind: F.col(c) if c in artifacts.columns else F.lit(None).cast(kind).alias(c)
    files = artifacts.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("relpath", known("sha256", "string"), known("size_bytes", "bigint"), "class_id"))).alias("files"))
    both = metrics.join(classes, key, "left").join(files, key, "left")
    if tiles is not None:
        used = tiles.groupBy(key, "dependency_id", "tile_source").agg(F.array_sort(F.collect_set(F.struct("tile_id", "source_url"))).alias("tiles_used"))
        both = both.join(used.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dependency_id", "tile_source", "tiles_used"))).alias("external_dependencies")), key, "left")
    both = both.crossJoin(F.broadcast(refs.agg(F.array_sort(F.collect_set("ref")).alias("policy_mapping_refs"))))
    for rows, name, kind in [
        (criteria, "asked", "struct<criteria_id:string,description:string,class_id:string,metric:string,most:double>"),
        (assumptions, "assumed", "struct<assumption_id:string,testable:boolean,result_id:string>"),
        (datasets, "datasets", "struct<dataset_id:string,retrieved_at_utc:string,license:string>"),
    ]:
        both = _listed(rows, name, kind)(both)
    texts = lambda values: F.coalesce(values, F.array().cast("array<string>"))
    both = both.withColumn("metrics", F.map_from_entries(entries)).withColumn("artifact_relpaths", texts(F.array_distinct(F.transform("files", lambda f: f["relpath"]))))
    if criteria is None:
        every = F.transform("evidence_classes", lambda c: c["class_id"])
        plain = F.struct(F.lit(NO_LOSS[0]).alias("criteria_id"), F.lit(NO_LOSS[1]).alias("description"), every.alias("classes"), F.lit(NO_LOSS[2]).alias("metric"), F.col("status").alias("outcome"))
        both = both.withColumn("tried", F.array(plain))
    else:
        outcome = lambda c: F.when(F.col("metrics")[c["metric"]]["value"] <= c["most"], "pass").when(F.col("metrics")[c["metric"]]["value"].isNull(), "na").otherwise("fail")
        both = both.withColumn("tried", F.transform("asked", lambda c: F.struct(c["criteria_id"].alias("criteria_id"), c["description"].alias("description"), F.array_compact(F.array(c["class_id"])).alias("classes"), c["metric"].alias("metric"), outcome(c).alias("outcome"))))
    of = lambda r: F.filter("assumed", lambda a: a["result_id"] == r)
    result = lambda c: F.struct(
        c["criteria_id"].alias("result_id"), F.array(c["criteria_id"]).alias("criteria_ids"), c["outcome"].alias("outcome"), c["classes"].alias("evidence_classes"),
        F.array_distinct(F.transform(of(c["criteria_id"]), lambda a: a["assumption_id"])).alias("assumption_refs"), F.exists(of(c["criteria_id"]), lambda a: ~a["testable"]).alias("non_testable_due_to_assumptions"),
    )
    trace = lambda c: F.struct(F.lit(regulation).alias("regulation"), F.try_element_at(c["classes"], F.lit(1)).alias("evidence_class"), c["criteria_id"].alias("acceptance_criteria"), c["criteria_id"].alias("result_ref"), c["metric"].alias("metric"))
    criterion = lambda c: F.struct(c["criteria_id"].alias("criteria_id"), c["description"].alias("description"), c["classes"].alias("evidence_classes"), F.lit("threshold").alias("decision_type"))
    shared = F.transform(F.array_distinct(F.transform("assumed", lambda a: F.struct(a["assumption_id"], a["testable"]))), lambda u: F.struct(u["assumption_id"].alias("assumption_id"), u["testable"].alias("testable"), F.transform(F.filter("assumed", lambda a: a["assumption_id"] == u["assumption_id"]), lambda a: a["result_id"]).alias("affects_results")))
    mapping = F.transform("policy_mapping_refs", lambda r: F.struct(r.alias("article_ref"), r.alias("requirement"), F.transform("tried", lambda c: F.concat(F.lit("metrics."), c["metric"])).alias("evidence_fields"), F.col("artifact_relpaths"), F.col("status").alias("status")))
    assessable = F.when(F.exists("evidence_classes", lambda c: c["status"] == "missing"), "inspectable_only").otherwise("assessable")
    area = F.col("aoi_ha") if "aoi_ha" in metrics.columns else F.lit(None).cast("double")
    where = geometry if geometry is not None else F.concat_ws("/", F.lit(run_id), key)
    mask = F.try_element_at(F.transform(F.filter("files", lambda f: f["class_id"] == V.LOSS), lambda f: f["relpath"]), F.lit(1))
    out = both.select(
        F.col(key).alias("aoi_id"), F.concat_ws("::", F.lit(run_id), key).alias("report_id"), F.lit("aoi_report_v2").alias("report_version"), F.lit(generated_at).alias("generated_at_utc"), F.lit(run_id).alias("bundle_id"),
        F.struct(F.lit("production").alias("report_type"), F.lit(regulation).alias("regulatory_context"), assessable.alias("assessment_capability")).alias("report_metadata"),
        F.struct(F.lit("uri" if geometry is None else "wkt").alias("kind"), where.alias("value")).alias("aoi_geometry_ref"),
        F.struct(F.transform("datasets", lambda d: F.struct(d["dataset_id"].alias("source_id"))).alias("sources")).alias("inputs"), "metrics",
        F.transform("files", lambda f: f.dropFields("class_id")).alias("evidence_artifacts"), F.struct("evidence_classes").alias("evidence_registry"),
        F.transform("tried", criterion).alias("acceptance_criteria"), F.transform("tried", result).alias("results"), F.transform("tried", trace).alias("regulatory_traceability"),
        shared.alias("assumptions"), "policy_mapping_refs", F.create_map(F.lit("run_id"), F.lit(run_id)).alias("parameters"), "datasets", mapping.alias("policy_mapping"),
        F.struct(F.struct(area.alias("area_ha"), F.lit("geodesic").alias("method")).alias("aoi_area"), F.struct(F.col("status").alias("status")).alias("deforestation_free_post_2020")).alias("results_summary"),
        F.struct(F.transform_values("metrics", lambda _, m: m["value"]).alias(V.LOSS)).alias("computed"), F.struct(F.struct(F.lit(False).alias("is_placeholder")).alias(V.LOSS)).alias("methodology"),
        F.struct(F.struct(F.struct(mask.alias("relpath")).alias("mask_geojson_ref")).alias(V.LOSS)).alias("computed_outputs"), *(["external_dependencies"] if tiles is not None else []),
    )
    return out if key == "aoi_id" else out.withColumnRenamed("aoi_id", key).withColumn("aoi_id", F.col(key))


def plot_reports(zones: DataFrame, facts: DataFrame, run_id: str) -> DataFrame:
    """Report id, plot id, centroid, geodesic area, polygon count and the answers of each plot (``facts`` as
    ``plot_report_blocks`` takes them; plots without have N/A)."""
    plots = S.plots(zones).select(F.concat_ws("::", F.lit(run_id), "zone_id").alias("report_id"), F.col("zone_id").alias("plot_id"), "lon", "lat", "area_ha", "n_polygons")
    named = plots.select("plot_id").join(facts, "plot_id", "left")
    return plots.join(P.plot_report_blocks(named), "plot_id")


def publish(runs: DataFrame, files: DataFrame, links: DataFrame, keep: int = 2) -> DataFrame:
    """The latest runs of each site, how many files each has, and whether the site can be published."""
    latest = E.latest_runs(runs, keep)
    ok = E.publishable(latest, files, links, keep).select("site_id", "ok")
    inventory = files.groupBy("site_id", "run_name").agg(F.count("*").alias("n_files"))
    return latest.join(inventory, ["site_id", "run_name"], "left").fillna(0, ["n_files"]).join(ok, "site_id")


def publish_changes(runs: DataFrame, files: DataFrame, published: DataFrame, keep: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index of the latest runs, what changed in them, and the published runs' files that are to go.

    ``files`` and ``published``: site_id, run_name, relpath, sha256, size_bytes; what inventories leave out doesn't count.
    The index has for each run its rank, count, size and signature of files, its state against what is published
    (added, changed, same) and how many files differ. Changes are (site_id, run_name, relpath, state) of runs that
    are published already and whose signatures differ; only their files are compared."""
    keys = ["site_id", "run_name"]
    latest = S.cut_lineage(E.latest_runs(runs, keep).select(*keys, "bundle_date", "rank"))
    files, published = [E.exclude_paths(d) for d in (files, published)]
    # files of other runs than the latest leave before anything is hashed or shuffled; the latest are written, as
    # Spark takes them for as large as all runs otherwise and shuffles every file to meet them
    of_latest = lambda df: S.cut_lineage(df.join(latest.select(*keys), keys, "left_semi"))
    own, known = of_latest(files), of_latest(published)
    whole = lambda df: E.folder_signatures(df, keys, top=True).drop("folder")
    mine = whole(own)
    there = whole(known).select(*keys, F.col("signature").alias("published_signature"))
    state = F.when(F.col("published_signature").isNull(), "added").when(F.col("signature") == F.col("published_signature"), "same").otherwise("changed")
    index = latest.join(mine, keys, "left").join(there, keys, "left").withColumn("state", state).drop("published_signature")
    index = S.cut_lineage(index)
    touched = index.where("state = 'changed'").select(*keys)
    changes = E.diff_by_folders(known.join(touched, keys, "left_semi"), own.join(touched, keys, "left_semi"), keys)
    counts = changes.groupBy(*keys).agg(F.count("*").alias("n_changes"))
    index = E.ordered(index.join(counts, keys, "left").fillna(0, ["n_changes", "n_files", "size_bytes"]), "index")
    return index, changes, published.join(latest, keys, "left_anti").select(*keys, "relpath")


def catalogue(datasets: DataFrame, families: DataFrame) -> DataFrame:
    """Datasets with their family, and whether they have one."""
    out = E.join_families(datasets, families)
    return out.withColumn("has_family", F.col("family").isNotNull() if "family" in out.columns else F.lit(False))


def link_review(links: DataFrame, history: DataFrame, current: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The registry with the best link of each family that scores above the current one, the history with these
    links if it lacks them, and the check's summary."""
    known = E.normalised_links(links)
    scored = E.scored_links(known)
    best = E.best_candidate(scored, "family", F.lit(current))
    best = best.withColumn("discovered_by", F.lit("tool")).withColumn("discovery_method", F.lit("probe"))
    kept = E.append_history(history, best.select(*E.HISTORY_KEY, "family", "score"))
    return E.promote(known.select("dependency_id", "url"), best), kept, E.link_summary(scored)
