"""Parcel rules, rankings and cross-checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C

DESIGNATION_KEYS = ["siht1", "land_use_designation", "land_use", "sihtotstarve"]
ID_KEYS = ["parcel_id", "katastritunnus", "tunnus", "id"]
MUNICIPALITY_KEYS = ["ov_nimi", "ay_nimi", "omavalitsus"]


def property_of(props: Column, keys: list[str]) -> Column:
    """First non-blank property of the keys."""
    return C.first_filled(*[props[k] for k in keys])


def designation(props: Column) -> Column:
    return property_of(props, DESIGNATION_KEYS)


def _first_not_empty(props: Column, keys: list[str]) -> Column:
    return F.coalesce(*[F.nullif(props[k], F.lit("")) for k in keys])


def municipality(props: Column) -> Column:
    return _first_not_empty(props, MUNICIPALITY_KEYS)


def parcel_id(props: Column, n: Column) -> Column:
    """The first property of the id keys that isn't empty, else a name by number."""
    return F.coalesce(_first_not_empty(props, ID_KEYS), F.concat(F.lit("parcel-"), n.cast("string")))


def filter_parcels(df: DataFrame, label: Column, wanted: str | None = None, has_geometry: Column | None = None) -> DataFrame:
    out = df if has_geometry is None else df.where(has_geometry)
    return out if wanted is None else out.where(F.trim(label) == wanted.strip())


def with_forest_area(df: DataFrame) -> DataFrame:
    """land_ha, forest_ha, key_used, reference_source, method, by a ladder: mets (square metres), mets_ha,
    forest_area_ha, the first other forest field in hectares by name with a number in ``properties`` (a map, if
    the column is there), then geometry, whose key is null; capped at the land and rounded to six places."""
    df = df.withColumn("land_ha", C.land_area(F.col("pindala"), F.col("geodesic_area_ha")))

    def step(key: Column, value: Column, named: Column) -> Column:
        area = C.normalised_area(value, named, F.col("land_ha"))
        return F.when(value.isNotNull(), F.struct(area["area_ha"].alias("area"), key.alias("key"), F.concat(F.lit("attribute:"), key).alias("source"), area["method"].alias("method")))

    rungs = [step(F.lit(k), F.col(k), F.lit("mets_m2" if k == "mets" else k)) for k in ("mets", "mets_ha", "forest_area_ha")]
    if "properties" in df.columns:
        props = F.col("properties")
        names = F.filter(F.array_sort(F.map_keys(props)), lambda k: C.is_forest_ha_field(k) & C.number(props[k]).isNotNull())
        first = F.get(names, F.lit(0))
        rungs.append(step(first, C.number(props[first]), first))
    text = lambda v: F.lit(v).cast("string")
    rung = lambda area, source, method: F.struct(area.alias("area"), text(None).alias("key"), text(source).alias("source"), text(method).alias("method"))
    shape = F.when(F.col("geodesic_area_ha").isNotNull(), rung(F.col("geodesic_area_ha"), "geometry", "geodesic_wgs84_pyproj"))
    found = F.coalesce(*rungs, shape, rung(F.lit(None).cast("double"), "missing", "missing"))
    df = df.select("*", F.explode(F.array(found)).alias("f"))  # one row; keeps the ladder from being copied into each of its uses
    over = F.coalesce(F.col("f.area") > F.col("land_ha"), F.lit(False))
    capped = F.round(F.when(over, F.col("land_ha")).otherwise(F.col("f.area")), 6)
    method = F.when(over, "capped_to_land_area").otherwise(F.col("f.method"))
    return df.select("*", capped.alias("forest_ha"), F.col("f.key").alias("key_used"), F.col("f.source").alias("reference_source"), method.alias("method")).drop("f")


def _ranked(df: DataFrame, forest: Column, n: int, by: str) -> DataFrame:
    """The n parcels of each area by forest, then land (reported if above zero, else geodesic), then id."""
    land = F.when(F.col("pindala") > 0, F.col("pindala")).otherwise(F.coalesce("geodesic_area_ha", F.lit(0.0)) * 10000)
    rank = F.row_number().over(W.partitionBy(by).orderBy(forest.desc(), land.desc(), "parcel_id"))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def top_parcels(df: DataFrame, n: int = 10, min_ha: float = 0.0, by: str = "aoi_id", prefer_raster: bool = False) -> DataFrame:
    """The n parcels of each area by forest (none counts as zero; that of the raster first if preferred)."""
    own = ["raster_forest_ha", "forest_ha"] if prefer_raster else ["forest_ha"]
    forest = F.coalesce(*own, F.lit(0.0))
    return _ranked(df.where(forest >= min_ha), forest, n, by)


def preselect_parcels(df: DataFrame, n: int, least_ha: float = 3.0, by: str = "aoi_id") -> DataFrame:
    """The n parcels of each area, of those with enough reported forest, before raster statistics."""
    forest = F.coalesce("forest_ha", F.lit(0.0))
    return _ranked(df.where(forest >= least_ha), forest, n, by)


def limit_parcels(df: DataFrame, n: int, by: str = "aoi_id") -> DataFrame:
    """The first n parcels of each area in file order."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy("pos"))).where(F.col("rank") <= n)


def designation_counts(df: DataFrame, label: Column) -> DataFrame:
    return df.groupBy(label.alias("designation")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "designation")


def field_inventory(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Parcels that hold each candidate field, and that used it."""
    held = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), c) for c in candidates]))
    considered = df.select(F.explode(held).alias("field")).groupBy("field").agg(F.count("*").alias("n_considered"))
    used = df.groupBy(F.coalesce("key_used", F.lit("geometry")).alias("field")).agg(F.count("*").alias("n_used"))
    return considered.join(used, "field", "full_outer").fillna(0, ["n_considered", "n_used"])


def fields_used(df: DataFrame, by: str = "aoi_id") -> DataFrame:
    keys = F.array_sort(F.collect_set(F.coalesce("key_used", F.lit("geometry"))))
    return df.groupBy(by).agg(F.concat(F.lit("forest_area_key_used:"), F.concat_ws("|", keys)).alias("summary"))


def land_area_totals(df: DataFrame, ours: Column, theirs: Column, by: str = "aoi_id") -> DataFrame:
    out = df.groupBy(by).agg(F.sum(ours).alias("computed_ha"), F.sum(theirs).alias("reported_ha"))
    diff = F.col("computed_ha") - F.col("reported_ha")
    return out.withColumn("diff_ha", diff).withColumn("diff_pct", F.when(F.col("reported_ha") > 0, diff / F.col("reported_ha") * 100))


def crosscheck_rows(parcels: DataFrame, computed: Column) -> DataFrame:
    """Each parcel against the computed area: signed difference, outcome and reason. A parcel without reference
    area is told apart from one whose area is zero, which has no reason."""
    area = F.col("forest_ha")
    pct = F.when(computed.isNotNull() & (area > 0), (computed - area) / area * 100)
    outcome = F.when(pct.isNull(), "not_comparable").otherwise("comparable")
    reason = F.when(area.isNull(), "missing_reference_forest_area").when(computed.isNull(), "missing_computed_forest_area")
    return parcels.withColumn("diff_pct", F.round(pct, 6)).withColumn("outcome", outcome).withColumn("reason", reason)


def crosscheck_total(parcels: DataFrame, computed: Column, tolerance_percent: float = 5.0, by: str = "aoi_id") -> DataFrame:
    """The reference areas' sum against the computed area: outcome within the tolerance, or why there is none."""
    total = parcels.groupBy(by).agg(F.coalesce(F.sum("forest_ha"), F.lit(0.0)).alias("reference_ha"), computed.alias("computed_ha"))
    usable = F.col("computed_ha").isNotNull() & (F.col("reference_ha") > 0)
    pct = F.when(usable, (F.col("computed_ha") - F.col("reference_ha")) / F.col("reference_ha") * 100)
    outcome = F.when(~usable, "not_comparable").when(F.abs(pct) <= tolerance_percent, "pass").otherwise("fail")
    reason = F.when(F.col("computed_ha").isNull(), "missing_computed_forest_area").when(~usable, "missing_reference_forest_area")
    return total.withColumn("diff_pct", pct).withColumn("outcome", outcome).withColumn("reason", reason)


def single_or_mixed(c: Column) -> Column:
    """Aggregate: the one value, ``mixed`` or ``missing``."""
    return F.when(F.count(c) == 0, "missing").when(F.min(c) == F.max(c), F.min(c)).otherwise("mixed")


def loss_status(df: DataFrame, aoi_ha: Column, loss_ha: Column, threshold: float = 0.0) -> DataFrame:
    status = F.when(aoi_ha.isNull() | (aoi_ha <= 0), "na").when(loss_ha <= threshold, "pass").otherwise("fail")
    return df.withColumn("loss_pct", F.when(aoi_ha > 0, loss_ha / aoi_ha * 100)).withColumn("status", status)


def attach_stats(parcels: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    return parcels.join(stats, keys, "left")


def parcel_metadata(df: DataFrame, label: Column, by: str = "aoi_id") -> DataFrame:
    """Count, parcels per designation (most first, then by name) and the parcels of each area, by id. An area's
    parcels make one row, as its report does; they are bounded by the area's register."""
    labelled = df.withColumn("designation", label)
    counts = labelled.where("designation is not null").groupBy(by, "designation").agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "designation")))
    counts = counts.groupBy(by).agg(F.transform(order, lambda s: F.struct(s["designation"].alias("designation"), (-s["less"]).alias("n"))).alias("designation_counts"))
    fields = [c for c in ("parcel_id", "designation", "municipality", "pindala", "land_ha", "forest_ha") if c in labelled.columns]
    rows = labelled.groupBy(by).agg(F.count("*").alias("parcel_count"), F.array_sort(F.collect_list(F.struct(*fields))).alias("parcels"))
    return rows.join(counts, by, "left")


def merge_properties(features: DataFrame) -> DataFrame:
    """doc, key, value: the first non-blank value of each key in feature order."""
    each = features.select("doc", "pos", F.explode("properties").alias("key", "value")).where(F.trim("value") != "")
    return each.groupBy("doc", "key").agg(F.min_by("value", "pos").alias("value"))


def plot_report_blocks(df: DataFrame) -> DataFrame:
    """Company, commodity and deforestation answers of plots: known facts, then analysis, then properties.

    Of the columns kyc_operator_name, kyc_operator, kyc_company_name, kyc_address, prop_operator_name,
    prop_operator, prop_address; kyc_commodity_type, kyc_type, analysis_commodity_type, prop_commodity_type;
    kyc_country, analysis_country, prop_country; evidence_maps (array); summary_forest_ha, summary_loss_ha,
    summary_aoi_ha, metric_forest_ha, metric_loss_ha, metric_aoi_ha (numbers); and detected, any may be absent.
    The analysis's numbers count only if the summary has none. Loss above zero means detected where nothing
    says so."""
    column = lambda c, kind: (F.col(c) if c in df.columns else F.lit(None)).cast(kind)
    first = lambda *names: C.na(C.first_filled(*[column(c, "string") for c in names]))
    names = ("forest", "loss", "aoi")
    summary = {k: column(f"summary_{k}_ha", "double") for k in names}
    bare = F.coalesce(*summary.values()).isNull()
    area = {k: F.when(bare, column(f"metric_{k}_ha", "double")).otherwise(summary[k]) for k in names}
    said = C.filled(column("detected", "string"))
    detected = F.when(said.isNotNull(), C.yes_no_na(said)).when(area["loss"] > 0, "Yes").when(area["loss"].isNotNull(), "No").otherwise("N/A")
    maps = F.coalesce(F.transform(F.col("evidence_maps"), lambda x: x.cast("string")) if "evidence_maps" in df.columns else F.lit(None).cast("array<string>"), F.array().cast("array<string>"))
    return df.select(
        "plot_id", first("kyc_operator_name", "kyc_operator", "kyc_company_name", "prop_operator_name", "prop_operator").alias("operator"), first("kyc_address", "prop_address").alias("address"),
        first("kyc_commodity_type", "kyc_type", "analysis_commodity_type", "prop_commodity_type").alias("commodity_type"), first("kyc_country", "analysis_country", "prop_country").alias("country_of_production"),
        F.lit("2020-12-31").alias("cutoff_date"), detected.alias("deforestation_detected"), maps.alias("evidence_maps"),
        *[C.na(v.cast("string")).alias(f"area_{'loss_post_2020' if k == 'loss' else k}_ha") for k, v in area.items()],
    )


def parcel_comparison(df: DataFrame) -> DataFrame:
    return df.select("parcel_id", "land_ha", "forest_ha", "raster_land_ha", "raster_forest_ha", "raster_loss_ha")
