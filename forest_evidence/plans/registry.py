"""Queries by operator id, each next to the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import columns as C
from ..operators import evidence as E
from ..operators import parcels as P
from ..operators import regions as R
from ..operators import report_rules as V
from ..operators import spatial as S
from ..operators import zonal as Z
from . import jobs
from .views import sql, view, with_views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: The pixel grid's upper left corner and step in degrees; canopy threshold, cutoff and end year.
Y0, STEP, T, CUTOFF, END = 60.0, 0.02, 30, 2012, 2018
PIXEL_HA = 0.09


def query(name: str, text: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda n: view(spark, sf_dir, n) if " " not in n else sql(spark, sf_dir, n))

        _QUERIES[name] = run
        if text:
            _SQL[name] = with_views(text)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r4(c: str | Column, name: str | None = None) -> Column:
    return F.round(c, 4).alias(name or c)


OK = "tree_valid = 1 AND loss_valid = 1"
FOREST = f"treecover >= {T}"

# --- masks and zonal statistics -------------------------------------------------------------------


def _mask_query(name: str, mask: Callable[[], Column], where: str) -> None:
    def run(get):
        return get("pixels").where(C.valid() & mask()).groupBy("zone_id").agg(F.count("*").alias("n"), F.sum("pcol").alias("s"))

    query(name, f"SELECT zone_id, count(*) AS n, cast(sum(pcol) AS bigint) AS s FROM pixels WHERE {OK} AND {where} GROUP BY zone_id")(run)


_mask_query("p1_valid", lambda: F.lit(True), "true")
_mask_query("p2_reference_forest", lambda: C.reference_forest(T), FOREST)
_mask_query("p3_loss_total", lambda: C.loss_total(T), f"{FOREST} AND lossyear > 0")
_mask_query("p4_loss_between", lambda: C.loss_between(T, 2013, 2016), f"{FOREST} AND lossyear BETWEEN 13 AND 16")
_mask_query("p5_loss_after", lambda: C.loss_after(T, CUTOFF), f"{FOREST} AND lossyear > 12")
_mask_query("p6_forest_at", lambda: C.forest_at(T, END), f"{FOREST} AND (lossyear = 0 OR lossyear > 18)")
_mask_query("p7_never_lost", lambda: C.forest_never_lost(T), f"{FOREST} AND lossyear = 0")


@query("p8_loss_year", "SELECT CASE WHEN lossyear > 0 THEN lossyear + 2000 ELSE 0 END AS loss_year, count(*) AS n FROM pixels GROUP BY 1")
def _(get):
    return get("pixels").groupBy(C.loss_year().alias("loss_year")).agg(F.count("*").alias("n"))


_E = "0.08181919084262149"
_Q = f"(1 - {C.WGS84_E2}) * (sin(radians(%s)) / (1 - pow({_E} * sin(radians(%s)), 2)) - (1 / (2 * {_E})) * ln((1 - {_E} * sin(radians(%s))) / (1 + {_E} * sin(radians(%s)))))"
_TOP, _LOW = f"({Y0} - prow * {STEP})", f"({Y0} - (prow + 1) * {STEP})"
AREA = f"({C.WGS84_A} * {C.WGS84_A} / 2 * radians({STEP}) * abs({_Q % ((_TOP,) * 4)} - {_Q % ((_LOW,) * 4)}))"


@query("a1_zonal_area", f"SELECT zone_id, round(sum(CASE WHEN {FOREST} THEN {AREA} ELSE 0 END) / 10000, 2) AS reference_ha FROM pixels WHERE {OK} GROUP BY zone_id")
def _(get):
    out = Z.zonal_area(get("pixels"), {"reference": C.reference_forest(T)}, ["zone_id"], Z.row_area(Y0, STEP))
    return out.select("zone_id", F.round("reference_ha", 2).alias("reference_ha"))


_CASES = {"reference": FOREST, "loss_total": f"{FOREST} AND lossyear > 0", "loss_after": f"{FOREST} AND lossyear > 12", "loss_window": f"{FOREST} AND lossyear BETWEEN 13 AND 18", "remaining": f"{FOREST} AND (lossyear = 0 OR lossyear > 18)", "never_lost": f"{FOREST} AND lossyear = 0"}
_SUMS = ", ".join(f"count(*) FILTER (WHERE {w}) * {PIXEL_HA} AS {k}_ha" for k, w in _CASES.items())
_METRICS = f"SELECT zone_id, {_SUMS} FROM pixels WHERE {OK} GROUP BY zone_id"


def _metrics(get):
    return Z.forest_metrics(get("pixels"), T, CUTOFF, END, F.lit(PIXEL_HA * 10000))


@query("a2_forest_metrics", f"SELECT zone_id, {', '.join(f'round({k}_ha, 4) AS {k}_ha' for k in _CASES)}, round(CASE WHEN reference_ha > 0 THEN loss_after_ha / reference_ha * 100 ELSE 0 END, 4) AS loss_pct FROM ({_METRICS}) m")
def _(get):
    m = _metrics(get)
    return m.select("zone_id", *[r4(c) for c in m.columns if c != "zone_id"])


@query("a3_cover_summary", f"SELECT zone_id, round(reference_ha, 4) AS initial_ha, round(loss_total_ha, 4) AS lost_ha, round(never_lost_ha, 4) AS current_ha FROM ({_METRICS}) m")
def _(get):
    return Z.cover_summary(_metrics(get)).select("zone_id", r4("initial_ha"), r4("lost_ha"), r4("current_ha"))


@query("a4_pixel_diagnostics", f"SELECT zone_id, count(*) FILTER (WHERE {OK} AND {FOREST}) AS n_reference, count(*) FILTER (WHERE {OK} AND {FOREST} AND lossyear > 0) AS n_loss, count(*) FILTER (WHERE {OK} AND {FOREST} AND lossyear = 0) AS n_never_lost, count(*) FILTER (WHERE tree_valid = 0) AS n_tree_missing, count(*) FILTER (WHERE loss_valid = 0) AS n_loss_missing, round(min(CASE WHEN {OK} THEN {AREA} END), 2) AS min_area, round(max(CASE WHEN {OK} THEN {AREA} END), 2) AS max_area, round(avg(CASE WHEN {OK} THEN {AREA} END), 2) AS avg_area FROM pixels GROUP BY zone_id")
def _(get):
    out = Z.pixel_diagnostics(get("pixels"), T, Z.row_area(Y0, STEP))
    return out.select(*[c for c in out.columns if not c.endswith("area")], *[F.round(c, 2).alias(c) for c in out.columns if c.endswith("area")])


@query("a6_loss_consistency", "SELECT count(*) FILTER (WHERE lossyear > 0 AND treecover >= 60) AS year_without_loss, count(*) FILTER (WHERE lossyear = 0 AND treecover < 60) AS loss_without_year FROM pixels")
def _(get):
    return Z.loss_consistency(get("pixels"), F.col("treecover") < 60)


@query("g7_pixel_xy", f"SELECT tile_id, round(min(30 + (pcol + 0.5) * {STEP}), 4) AS min_x, round(max({Y0} - (prow + 0.5) * {STEP}), 4) AS max_y FROM pixels GROUP BY tile_id")
def _(get):
    return Z.pixel_xy(get("pixels"), 30.0, Y0, STEP).groupBy("tile_id").agg(F.round(F.min("x"), 4).alias("min_x"), F.round(F.max("y"), 4).alias("max_y"))


@query("g8_pixel_area", f"SELECT DISTINCT prow, round({AREA}, 2) AS area_m2 FROM pixels")
def _(get):
    return get("pixels").select("prow").distinct().select("prow", F.round(Z.row_area(Y0, STEP), 2).alias("area_m2"))


@query("s3_read_pixels", "SELECT tile_id, prow, pcol, treecover FROM pixels WHERE tile_id IN ('T1', 'T3') AND prow BETWEEN 20 AND 40")
def _(get):
    pixels = get("pixels")
    path = sources.scratch(pixels.sparkSession)
    pixels.repartition("tile_id").sortWithinPartitions("tile_id", "prow").write.partitionBy("tile_id").parquet(path)
    return sources.read_pixels(pixels.sparkSession, path, ["T1", "T3"], (20, 40)).select("tile_id", "prow", "pcol", "treecover")


@query("j2_align_layers", "SELECT tile_id, count(*) AS n, cast(sum(treecover * lossyear) AS bigint) AS s FROM pixels GROUP BY tile_id")
def _(get):
    p = get("pixels")
    both = Z.align_layers(p.select("tile_id", "prow", "pcol", "treecover"), p.select("tile_id", "prow", "pcol", "lossyear"))
    return both.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum(F.col("treecover") * F.col("lossyear")).alias("s"))


@query("u2_tile_ids", "SELECT DISTINCT tile_id FROM pixels ORDER BY tile_id")
def _(get):
    return get("pixels").select("tile_id").distinct().orderBy("tile_id")


# --- boxes, polygons and the pixel grid -----------------------------------------------------------


def _zones(get, step: float = 1.0) -> DataFrame:
    return S.boxes_to_zones(get("boxes"), "box_id", F.col("c0") * step, F.col("r0") * step, F.col("c1") * step, F.col("r1") * step)


_PLACED = "(SELECT p.*, t.x0 + p.pcol + 0.5 AS x, t.y0 - p.prow - 0.5 AS y, t.y0 AS top, t.x0 AS side FROM pixels p JOIN tiles t ON p.tile_id = t.tile_id)"
_IN = "p.x > b.c0 AND p.x < b.c1 AND p.y > b.r0 AND p.y < b.r1"


@query("j3_zone_pixels", f"SELECT b.box_id AS zone_id, p.tile_id, count(*) AS n, cast(sum(p.treecover) AS bigint) AS cover FROM boxes b JOIN {_PLACED} p ON {_IN} GROUP BY 1, 2")
def _(get):
    return S.zone_pixels(_zones(get), get("pixels").drop("zone_id"), get("tiles")).groupBy("zone_id", "tile_id").agg(F.count("*").alias("n"), F.sum("treecover").alias("cover"))


@query("j3_sloped_zones", f"SELECT b.box_id AS zone_id, p.tile_id, count(*) AS n, cast(sum(p.pcol) AS bigint) AS s FROM boxes b JOIN {_PLACED} p ON p.x > b.c0 AND p.y > b.r0 AND (p.x - b.c0) / (b.c1 - b.c0) + (p.y - b.r0) / (b.r1 + 0.3 - b.r0) < 1 GROUP BY 1, 2")
def _(get):
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), (F.col(y) + F.lit(0.3 if y == "r1" else 0.0)).cast("double").alias("y"))
    ring = F.array(corner("c0", "r0"), corner("c1", "r0"), corner("c0", "r1"))
    zones = get("boxes").select(F.col("box_id").alias("zone_id"), F.array(F.array(ring)).alias("polygons"))
    return S.zone_pixels(zones, get("pixels").drop("zone_id"), get("tiles")).groupBy("zone_id", "tile_id").agg(F.count("*").alias("n"), F.sum("pcol").alias("s"))


@query("j4_zone_pixels_touched", f"SELECT b.box_id AS zone_id, p.tile_id, count(*) AS n FROM boxes b JOIN {_PLACED} p ON p.prow BETWEEN p.top - b.r1 - 1 AND p.top - b.r0 - 1 AND p.pcol BETWEEN b.c0 - p.side AND b.c1 - p.side GROUP BY 1, 2")
def _(get):
    half = lambda c, d: F.col(c) + F.lit(d)
    zones = S.boxes_to_zones(get("boxes"), "box_id", half("c0", 0.75), half("r0", 0.75), half("c1", 0.25), half("r1", 0.25))
    return S.zone_pixels(zones, get("pixels").drop("zone_id"), get("tiles"), "touched").groupBy("zone_id", "tile_id").agg(F.count("*").alias("n"))


@query("j1_pair_tiles", "SELECT concat('/cover/', tile_id, '/', tile_id, '.tif') AS cover_path, concat('/loss/', tile_id, '.tif') AS loss_path FROM (SELECT DISTINCT tile_id FROM pixels) t")
def _(get):
    ids = get("pixels").select("tile_id").distinct()
    return S.pair_tiles(ids.select(F.format_string("/cover/%s/%s.tif", "tile_id", "tile_id").alias("path")), ids.select(F.format_string("/loss/%s.tif", "tile_id").alias("path")))


@query("j5_zone_sets", "SELECT (SELECT count(*) FROM (SELECT DISTINCT tile_id, prow, pcol FROM pixels WHERE treecover >= 40 OR lossyear > 0) x) AS n_union, (SELECT count(*) FROM pixels WHERE treecover >= 40 AND lossyear > 0) AS n_both")
def _(get):
    a, b = get("pixels").where("treecover >= 40"), get("pixels").where("lossyear > 0")
    both = S.zone_intersection(a, b).agg(F.count("*").alias("n_both"))
    return S.zone_union(a, b).agg(F.count("*").alias("n_union")).join(both)


def _bbox(get, where: str) -> DataFrame:
    return get("boxes").where(where).select(F.col("box_id").alias("id"), F.col("c0").alias("x0"), F.col("r0").alias("y0"), F.col("c1").alias("x1"), F.col("r1").alias("y1"))


@query("j6_bbox_join", "SELECT a.box_id AS a_id, b.box_id AS b_id FROM boxes a JOIN boxes b ON a.c0 <= b.c1 AND b.c0 <= a.c1 AND a.r0 <= b.r1 AND b.r0 <= a.r1 WHERE a.aoi_id IN ('A0', 'A1') AND b.aoi_id IN ('A2', 'A3')")
def _(get):
    return S.bbox_join(_bbox(get, "aoi_id in ('A0', 'A1')"), _bbox(get, "aoi_id in ('A2', 'A3')"), 16.0).select("a_id", "b_id")


@query("j6_boxes_of_all_sizes", "SELECT a.box_id AS a_id, b.box_id AS b_id FROM boxes a JOIN (SELECT box_id, r0 - w AS r0, r1 + w AS r1, c0 - w AS c0, c1 + w AS c1 FROM (SELECT *, CASE WHEN r0 % 9 = 0 THEN 100000 WHEN r0 % 9 < 3 THEN 40 ELSE 0 END AS w FROM boxes) t) b ON a.c0 <= b.c1 AND b.c0 <= a.c1 AND a.r0 <= b.r1 AND b.r0 <= a.r1")
def _(get):
    wide = _bbox(get, "true").withColumn("w", F.expr("CASE WHEN y0 % 9 = 0 THEN 100000 WHEN y0 % 9 < 3 THEN 40 ELSE 0 END"))
    wide = wide.selectExpr("id", "x0 - w AS x0", "y0 - w AS y0", "x1 + w AS x1", "y1 + w AS y1")
    return S.bbox_join(_bbox(get, "true"), wide, 0.5).select("a_id", "b_id")


@query("j7_covered_by", "SELECT a.box_id AS inner_id, b.box_id AS outer_id FROM boxes a JOIN boxes b ON a.c0 >= b.c0 AND a.c1 <= b.c1 AND a.r0 >= b.r0 AND a.r1 <= b.r1")
def _(get):
    return S.covered_by(_zones(get), _zones(get), 16.0)


#: Shapes of three times a box's size: a square notch, a hole, a notch with sloped sides, two parts with a gap.
_SHAPES = """SELECT box_id, cast(substr(box_id, 2) AS int) % 4 AS shape, cast(c0 AS double) AS x0, cast(r0 AS double) AS y0,
       cast(c1 - c0 AS double) AS w, cast(r1 - r0 AS double) AS h FROM boxes"""
_SMALL = """SELECT concat('P', cast(p_partkey AS int)) AS box_id, cast(p_partkey * 53 % 240 AS double) AS x0, cast(p_partkey * 37 % 230 AS double) AS y0,
       cast(p_partkey * 53 % 240 + 1 + p_partkey % 3 AS double) AS x1, cast(p_partkey * 37 % 230 + 1 + p_partkey % 2 AS double) AS y1 FROM part"""


def _shaped(get) -> DataFrame:
    corner = lambda i, j: F.struct((F.col("x0") + i * F.col("w")).alias("x"), (F.col("y0") + j * F.col("h")).alias("y"))
    ring = lambda *at: F.array(*[corner(i, j) for i, j in at])
    full = [(0, 0), (3, 0), (3, 3), (0, 3)]
    notch = F.array(F.array(ring(*full[:3], (2, 3), (2, 1), (1, 1), (1, 3), (0, 3))))
    hole = F.array(F.array(ring(*full), ring((1, 1), (1, 2), (2, 2), (2, 1))))
    sloped = F.array(F.array(ring((0, 0), (3, 0), (3, 3), (1.5, 1), (0, 3))))
    parts = F.array(F.array(ring((0, 0), (1, 0), (1, 3), (0, 3))), F.array(ring((2, 0), (3, 0), (3, 3), (2, 3))))
    own = get("boxes").selectExpr("box_id", "cast(substr(box_id, 2) AS int) % 4 AS shape", "cast(c0 AS double) AS x0", "cast(r0 AS double) AS y0", "cast(c1 - c0 AS double) AS w", "cast(r1 - r0 AS double) AS h")
    chosen = F.when(F.col("shape") == 0, notch).when(F.col("shape") == 1, hole).when(F.col("shape") == 2, sloped).otherwise(parts)
    return own.select(F.col("box_id").alias("zone_id"), chosen.alias("polygons"))


@query("j7_concave_zones", f"""
SELECT a.box_id AS inner_id, b.box_id AS outer_id FROM ({_SMALL}) a JOIN ({_SHAPES}) b
  ON a.x0 >= b.x0 AND a.x1 <= b.x0 + 3 * w AND a.y0 >= b.y0 AND a.y1 <= b.y0 + 3 * h
WHERE CASE shape WHEN 0 THEN a.x1 <= b.x0 + w OR a.x0 >= b.x0 + 2 * w OR a.y1 <= b.y0 + h
                 WHEN 1 THEN a.x1 <= b.x0 + w OR a.x0 >= b.x0 + 2 * w OR a.y1 <= b.y0 + h OR a.y0 >= b.y0 + 2 * h
                 WHEN 2 THEN a.y1 <= b.y0 + h OR greatest(0, a.x0 - b.x0 - 1.5 * w, b.x0 + 1.5 * w - a.x1) * 2 * h >= 1.5 * w * (a.y1 - b.y0 - h)
                 ELSE a.x1 <= b.x0 + w OR a.x0 >= b.x0 + 2 * w END""")  # fmt: skip
def _(get):
    inner = S.boxes_to_zones(get(_SMALL), "box_id", *map(F.col, ("x0", "y0", "x1", "y1")))
    return S.covered_by(inner, _shaped(get), 4.0)


_TILE = "concat('N', lpad(cast(cast(floor(b.r0 / 10) + y + 1 AS int) * 10 AS string), 2, '0'), '_E', lpad(cast(cast(floor(b.c0 / 10) + x AS int) * 10 AS string), 3, '0'))"


@query("j8_aoi_tiles", f"SELECT b.box_id AS id, {_TILE} AS tile_id FROM boxes b, (SELECT unnest([0, 1, 2, 3]) AS x) gx, (SELECT unnest([0, 1, 2, 3]) AS y) gy WHERE (floor(b.r0 / 10) + y) * 10 < b.r1 AND (floor(b.c0 / 10) + x) * 10 < b.c1")
def _(get):
    return S.tiles_of_boxes(_bbox(get, "true")).select("id", "tile_id")


_SQL["g11_tile_ids"] = with_views(f"SELECT DISTINCT {_TILE} AS tile_id FROM boxes b, (SELECT unnest([0, 1, 2, 3]) AS x) gx, (SELECT unnest([0, 1, 2, 3]) AS y) gy WHERE (floor(b.r0 / 10) + y) * 10 < b.r1 AND (floor(b.c0 / 10) + x) * 10 < b.c1")


@query("g11_tile_ids")
def _(get):
    return S.tiles_of_boxes(_bbox(get, "true")).select("tile_id").distinct()


@query("p25_in_scope", "SELECT box_id AS id FROM boxes WHERE c0 <= 90 AND c1 >= 40 AND r0 <= 80 AND r1 >= 30")
def _(get):
    return S.in_scope(_bbox(get, "true"), 40, 30, 90, 80).select("id")


@query("a5_parcel_stats", f"SELECT b.box_id AS zone_id, round(coalesce(count(p.prow) FILTER (WHERE {OK}), 0) * {PIXEL_HA}, 4) AS land_ha, round(coalesce(count(p.prow) FILTER (WHERE {OK} AND {FOREST} AND (lossyear = 0 OR lossyear > 18)), 0) * {PIXEL_HA}, 4) AS forest_ha, round(coalesce(count(p.prow) FILTER (WHERE {OK} AND {FOREST} AND lossyear > 12), 0) * {PIXEL_HA}, 4) AS loss_ha FROM boxes b LEFT JOIN {_PLACED} p ON {_IN} GROUP BY 1")
def _(get):
    zones = _zones(get)
    spans = S.tile_spans(zones, get("tiles"))
    out = Z.parcel_stats(S.pixels_near(get("pixels").drop("zone_id"), zones, get("tiles")), zones.select("zone_id"), T, CUTOFF, END, F.lit(PIXEL_HA * 10000), ["zone_id"], spans)
    return out.select("zone_id", r4("land_ha"), r4("forest_ha"), r4("loss_ha"))


_SLOPED = "p.x > b.c0 AND p.y > b.r0 AND (p.x - b.c0) / (b.c1 - b.c0) + (p.y - b.r0) / (b.r1 + 0.3 - b.r0) < 1"
_SPAN_SUMS = ", ".join(f"round(count(*) FILTER (WHERE {OK} AND {w}) * {PIXEL_HA}, 4) AS {k}_ha" for k, w in _CASES.items())


def _sloped(get) -> DataFrame:
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), (F.col(y) + F.lit(0.3 if y == "r1" else 0.0)).cast("double").alias("y"))
    ring = F.array(corner("c0", "r0"), corner("c1", "r0"), corner("c0", "r1"))
    return get("boxes").select(F.col("box_id").alias("zone_id"), F.array(F.array(ring)).alias("polygons"))


@query("a2_sloped_zones", f"SELECT b.box_id AS zone_id, {_SPAN_SUMS} FROM boxes b JOIN {_PLACED} p ON {_SLOPED} GROUP BY 1")
def _(get):
    spans = S.tile_spans(_sloped(get), get("tiles"))
    m = Z.forest_metrics(get("pixels").drop("zone_id"), T, CUTOFF, END, F.lit(PIXEL_HA * 10000), spans=spans)
    reached = spans.join(get("pixels").select("tile_id", "prow", "pcol"), ["tile_id", "prow"]).where("pcol between c0 and c1").select("zone_id").distinct()
    return m.join(reached, "zone_id").select("zone_id", *[r4(f"{k}_ha") for k in _CASES])


@query("a1_touched_zones", f"SELECT b.box_id AS zone_id, round(sum(CASE WHEN {FOREST} THEN {AREA} ELSE 0 END) / 10000, 2) AS reference_ha FROM boxes b JOIN {_PLACED} p ON p.prow BETWEEN p.top - b.r1 - 1 AND p.top - b.r0 - 1 AND p.pcol BETWEEN b.c0 - p.side AND b.c1 - p.side WHERE {OK} GROUP BY 1")
def _(get):
    half = lambda c, d: F.col(c) + F.lit(d)
    zones = S.boxes_to_zones(get("boxes"), "box_id", half("c0", 0.75), half("r0", 0.75), half("c1", 0.25), half("r1", 0.25))
    masks = {"valid": F.lit(True), "reference": C.reference_forest(T)}
    spans = S.tile_spans(zones, get("tiles"), "touched")
    out = Z.zonal_area(get("pixels").drop("zone_id"), masks, ["zone_id"], Z.row_area(Y0, STEP), spans)
    return out.where("valid_ha > 0").select("zone_id", F.round("reference_ha", 2).alias("reference_ha"))


@query("a17_bounding_box", "SELECT box_id AS zone_id, cast(c0 AS double) AS min_x, cast(r0 AS double) AS min_y, cast(c1 AS double) AS max_x, cast(r1 AS double) AS max_y FROM boxes")
def _(get):
    return S.bounding_box(_zones(get))


@query("g1_segments", "SELECT box_id AS zone_id, cast(4 AS bigint) AS n, cast(2 * (c1 - c0) + 2 * (r1 - r0) AS double) AS around FROM boxes")
def _(get):
    around = F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1")))
    return S.segments(_zones(get)).groupBy("zone_id").agg(F.count("*").alias("n"), around.alias("around"))


@query("g2_polygon_count", "SELECT box_id AS zone_id, 1 AS n_polygons FROM boxes")
def _(get):
    return S.polygon_count(_zones(get))


@query("g3_vertex_centroid", "SELECT box_id AS zone_id, (c0 + c1) / 2.0 AS lon, (r0 + r1) / 2.0 AS lat FROM boxes")
def _(get):
    return S.vertex_centroid(_zones(get))


@query("g4_approx_area", "SELECT box_id AS zone_id, round((c1 - c0) * (r1 - r0) * 0.0001 * 110574.0 * 111320.0 * cos(radians((r0 + r1) * 0.005)) / 10000, 2) AS area_ha FROM boxes")
def _(get):
    return S.approx_area_ha(_zones(get, 0.01)).select("zone_id", F.round("area_ha", 2).alias("area_ha"))


_BETA = f"asin(least(1.0, ({_Q}) / {C.Q_POLE!r}e0)) / 2"
_ARC = lambda lat: f"2 * atan2(tan(radians((c1 - c0) * 0.01) / 2) * 2 * tan({_BETA % ((lat,) * 4)}), 1 + pow(tan({_BETA % ((lat,) * 4)}), 2))"
_GEODESIC = f"abs({_ARC('(r1 * 0.01)')} - {_ARC('(r0 * 0.01)')}) * {C.WGS84_A}e0 * {C.WGS84_A}e0 * {C.Q_POLE!r}e0 / 2 / 10000"


@query("g5_geodesic_area", f"SELECT box_id AS zone_id, round({_GEODESIC}, 2) AS area_ha FROM boxes")
def _(get):
    return S.geodesic_area_ha(_zones(get, 0.01)).select("zone_id", F.round("area_ha", 2).alias("area_ha"))


@query("g6_plots", f"SELECT box_id AS zone_id, round((c0 + c1) / 200.0, 8) AS lon, round((r0 + r1) / 200.0, 8) AS lat, round({_GEODESIC}, 2) AS area_ha, 1 AS n_polygons FROM boxes")
def _(get):
    return S.plots(_zones(get, 0.01)).withColumn("area_ha", F.round("area_ha", 2))


# --- parcels --------------------------------------------------------------------------------------

_LAND = "coalesce(pindala / 10000, geodesic_area_ha)"
_KEY = "CASE WHEN mets IS NOT NULL THEN 'mets' WHEN mets_ha IS NOT NULL THEN 'mets_ha' WHEN forest_area_ha IS NOT NULL THEN 'forest_area_ha' WHEN geodesic_area_ha >= 100 THEN 'eramets-ha-2020' END"
_RAW = "CASE WHEN mets IS NOT NULL THEN mets WHEN mets_ha IS NOT NULL THEN mets_ha WHEN forest_area_ha IS NOT NULL THEN forest_area_ha WHEN geodesic_area_ha >= 100 THEN geodesic_area_ha - 50 END"
_BIG = f"({_RAW} > {_LAND} AND {_RAW} / 10000 <= {_LAND})"
_AREA = f"CASE WHEN {_RAW} IS NULL THEN geodesic_area_ha WHEN mets IS NOT NULL OR {_BIG} THEN {_RAW} / 10000 ELSE {_RAW} END"
_METHOD = f"CASE WHEN {_AREA} > {_LAND} THEN 'capped_to_land_area' WHEN {_RAW} IS NULL THEN 'geodesic_wgs84_pyproj' WHEN mets IS NOT NULL THEN 'reported_m2' WHEN {_BIG} THEN 'reported_m2_inferred' ELSE 'reported_ha' END"
_F = f"(SELECT *, {_LAND} AS land_ha, round(least({_AREA}, {_LAND}), 6) AS forest_ha, {_KEY} AS key_used, coalesce('attribute:' || {_KEY}, 'geometry') AS reference_source, {_METHOD} AS method FROM parcels)"
_LABEL = "coalesce(nullif(trim(siht1), ''), nullif(trim(land_use), ''))"


def _label() -> Column:
    return C.first_filled(F.col("siht1"), F.col("land_use"))


def _forest(get) -> DataFrame:
    other = F.when(F.col("geodesic_area_ha") >= 100, (F.col("geodesic_area_ha") - 50).cast("string")).otherwise("none")
    props = F.create_map(F.lit("eramets-ha-2020"), other, F.lit("mets_note"), F.lit("7"), F.lit("a_ha"), F.lit("9"))
    return P.with_forest_area(get("parcels").withColumn("properties", props))


@query("p9_filter_parcels", "SELECT parcel_id FROM parcels WHERE trim(siht1) = 'MEDIUM' AND geodesic_area_ha IS NOT NULL")
def _(get):
    return P.filter_parcels(get("parcels").withColumn("siht1", F.concat(F.lit(" "), F.col("siht1"))), F.col("siht1"), "MEDIUM ", F.col("geodesic_area_ha").isNotNull()).select("parcel_id")


@query("p11_designation", f"SELECT parcel_id, {_LABEL} AS designation FROM parcels")
def _(get):
    props = F.create_map(F.lit("siht1"), "siht1", F.lit("land_use"), "land_use")
    return get("parcels").select("parcel_id", P.designation(props).alias("designation"))


@query("p12_municipality", "SELECT parcel_id, CASE WHEN trim(siht1) = '' THEN siht1 ELSE land_use END AS municipality FROM parcels")
def _(get):
    return get("parcels").select("parcel_id", P.municipality(F.create_map(F.lit("omavalitsus"), "land_use", F.lit("ov_nimi"), F.lit(""), F.lit("ay_nimi"), F.when(F.trim("siht1") == "", F.col("siht1")))).alias("municipality"))


@query("p13_parcel_id", "SELECT pos, CASE WHEN pos % 6 = 0 THEN '0' WHEN pos % 3 = 0 THEN concat('parcel-', cast(pos AS string)) ELSE parcel_id END AS parcel_id FROM parcels")
def _(get):
    props = F.create_map(F.lit("parcel_id"), F.when(F.col("pos") % 3 == 0, F.lit("")), F.lit("tunnus"), F.when(F.col("pos") % 3 != 0, F.col("parcel_id")), F.lit("id"), F.when(F.col("pos") % 6 == 0, "0"))
    return get("parcels").select("pos", P.parcel_id(props, F.col("pos")).alias("parcel_id"))


_FIELDS = ["mets", "METS_HA", "forest_area_ha", "pindala", "siht1", "haritav", "rohumaa", "metsatyyp", "omanik", "forest_ha_total", "eramets-ha-2020", "forest_share", "a_ha", "metsa_osa"]


@query("p14_forest_fields", f"SELECT x AS field, list_contains(['mets', 'mets_ha', 'pindala', 'haritav', 'rohumaa', 'metsatyyp', 'siht1'], lower(x)) OR contains(lower(x), 'mets') OR contains(lower(x), 'forest') AS forest, (contains(lower(x), 'mets') OR contains(lower(x), 'forest')) AND (ends_with(lower(x), 'ha') OR regexp_matches(lower(x), '(^|[_-])ha($|[_-])')) AS ha, (SELECT count(*) FROM parcels) AS n FROM (SELECT unnest({_FIELDS}) AS x) t")
def _(get):
    each = get("parcels").select(F.explode(F.array(*map(F.lit, _FIELDS))).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    return each.select("field", C.is_forest_field(F.col("field")).alias("forest"), C.is_forest_ha_field(F.col("field")).alias("ha"), "n")


@query("p15_land_area", f"SELECT parcel_id, round({_LAND}, 4) AS land_ha FROM parcels")
def _(get):
    return get("parcels").select("parcel_id", F.round(C.land_area(F.col("pindala"), F.col("geodesic_area_ha")), 4).alias("land_ha"))


@query("p16_normalise_area", f"SELECT parcel_id, round(CASE WHEN forest_area_ha > {_LAND} AND forest_area_ha / 10000 <= {_LAND} THEN forest_area_ha / 10000 ELSE forest_area_ha END, 4) AS area_ha FROM parcels WHERE forest_area_ha IS NOT NULL")
def _(get):
    land = C.land_area(F.col("pindala"), F.col("geodesic_area_ha"))
    return get("parcels").where("forest_area_ha is not null").select("parcel_id", F.round(C.normalised_area(F.col("forest_area_ha"), F.lit("forest_area_ha"), land)["area_ha"], 4).alias("area_ha"))


@query("p17_forest_area", f"SELECT parcel_id, round(forest_ha, 4) AS forest_ha, key_used, reference_source, method FROM {_F} f")
def _(get):
    return _forest(get).select("parcel_id", r4("forest_ha"), "key_used", "reference_source", "method")


@query("p18_cap_to_land", f"SELECT parcel_id, round(land_ha, 4) AS land_ha, round(forest_ha, 4) AS forest_ha FROM {_F} f WHERE method LIKE 'capped%'")
def _(get):
    return _forest(get).where("method like 'capped%'").select("parcel_id", r4("land_ha"), r4("forest_ha"))


@query("p24_limit_parcels", "SELECT aoi_id, parcel_id FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY pos) AS k FROM parcels) t WHERE k <= 7")
def _(get):
    return P.limit_parcels(get("parcels"), 7).select("aoi_id", "parcel_id")


_ORDER = "coalesce(forest_ha, 0) DESC, CASE WHEN pindala > 0 THEN pindala ELSE coalesce(geodesic_area_ha, 0) * 10000 END DESC, parcel_id"


@query("w1_top_parcels", f"SELECT aoi_id, parcel_id, cast(k AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY {_ORDER}) AS k FROM {_F} f) t WHERE k <= 10")
def _(get):
    return P.top_parcels(_forest(get)).select("aoi_id", "parcel_id", "rank")


@query("w1_top_by_raster", f"SELECT aoi_id, parcel_id, cast(k AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY {_ORDER}) AS k FROM (SELECT f.* REPLACE (CASE WHEN pos % 2 = 0 THEN land_ha * 0.5 ELSE forest_ha END AS forest_ha) FROM {_F} f) g WHERE forest_ha >= 2) t WHERE k <= 10")
def _(get):
    own = _forest(get).withColumn("raster_forest_ha", F.when(F.col("pos") % 2 == 0, F.col("land_ha") * 0.5))
    return P.top_parcels(own, min_ha=2.0, prefer_raster=True).select("aoi_id", "parcel_id", "rank")


@query("w2_preselect_parcels", f"SELECT aoi_id, parcel_id, cast(k AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY {_ORDER}) AS k FROM {_F} f WHERE forest_ha >= 3) t WHERE k <= 5")
def _(get):
    return P.preselect_parcels(_forest(get), 5).select("aoi_id", "parcel_id", "rank")


@query("a7_designation_counts", f"SELECT {_LABEL} AS designation, count(*) AS n FROM parcels GROUP BY 1 ORDER BY n DESC, designation")
def _(get):
    return P.designation_counts(get("parcels"), _label())


@query("a8_field_inventory", f"WITH f AS (SELECT * FROM {_F} f), c AS (SELECT 'mets' AS field, count(mets) AS n FROM f UNION ALL SELECT 'mets_ha', count(mets_ha) FROM f UNION ALL SELECT 'forest_area_ha', count(forest_area_ha) FROM f), u AS (SELECT coalesce(key_used, 'geometry') AS field, count(*) AS n FROM f GROUP BY 1) SELECT coalesce(c.field, u.field) AS field, coalesce(c.n, 0) AS n_considered, coalesce(u.n, 0) AS n_used FROM c FULL JOIN u ON c.field = u.field")
def _(get):
    return P.field_inventory(_forest(get), ["mets", "mets_ha", "forest_area_ha"])


@query("a9_fields_used", f"SELECT aoi_id, concat('forest_area_key_used:', string_agg(key_used, '|' ORDER BY key_used)) AS summary FROM (SELECT DISTINCT aoi_id, coalesce(key_used, 'geometry') AS key_used FROM {_F} f) t GROUP BY 1")
def _(get):
    return P.fields_used(_forest(get))


@query("a10_land_area_totals", f"SELECT aoi_id, round(sum(land_ha), 2) AS computed_ha, round(sum(pindala / 10000), 2) AS reported_ha, round(sum(land_ha) - sum(pindala / 10000), 2) AS diff_ha, round((sum(land_ha) - sum(pindala / 10000)) / sum(pindala / 10000) * 100, 2) AS diff_pct FROM {_F} f GROUP BY 1")
def _(get):
    out = P.land_area_totals(_forest(get), F.col("land_ha"), F.col("pindala") / 10000)
    return out.select("aoi_id", *[F.round(c, 2).alias(c) for c in out.columns if c != "aoi_id"])


_NONE = "pos % 7 = 0"
_PCT = f"CASE WHEN NOT ({_NONE}) AND forest_ha > 0 THEN (land_ha * 0.5 - forest_ha) / forest_ha * 100 END"


def _computed() -> Column:
    return F.when(F.col("pos") % 7 != 0, F.col("land_ha") * 0.5)


@query("a11_crosscheck_rows", f"SELECT parcel_id, round(round({_PCT}, 6), 2) AS diff_pct, CASE WHEN {_PCT} IS NULL THEN 'not_comparable' ELSE 'comparable' END AS outcome, CASE WHEN forest_ha IS NULL THEN 'missing_reference_forest_area' WHEN {_NONE} THEN 'missing_computed_forest_area' END AS reason FROM {_F} f")
def _(get):
    return P.crosscheck_rows(_forest(get), _computed()).select("parcel_id", F.round("diff_pct", 2).alias("diff_pct"), "outcome", "reason")


@query("a12_crosscheck_total", f"SELECT aoi_id, round(r, 2) AS reference_ha, round((c - r) / r * 100, 3) AS diff_pct, CASE WHEN c IS NULL OR r <= 0 THEN 'not_comparable' WHEN abs((c - r) / r * 100) <= 5 THEN 'pass' ELSE 'fail' END AS outcome, CASE WHEN c IS NULL THEN 'missing_computed_forest_area' WHEN r <= 0 THEN 'missing_reference_forest_area' END AS reason FROM (SELECT aoi_id, sum(forest_ha) AS r, CASE WHEN aoi_id <> 'A3' THEN sum(land_ha) * 0.5 END AS c FROM {_F} f GROUP BY 1) t")
def _(get):
    out = P.crosscheck_total(_forest(get), F.sum(F.when(F.col("aoi_id") != "A3", F.col("land_ha"))) * 0.5)
    return out.select("aoi_id", F.round("reference_ha", 2).alias("reference_ha"), F.round("diff_pct", 3).alias("diff_pct"), "outcome", "reason")


@query("a13_single_or_mixed", f"SELECT aoi_id, CASE WHEN count(key_used) = 0 THEN 'missing' WHEN min(key_used) = max(key_used) THEN min(key_used) ELSE 'mixed' END AS source FROM {_F} f GROUP BY 1")
def _(get):
    return _forest(get).groupBy("aoi_id").agg(P.single_or_mixed(F.col("key_used")).alias("source"))


@query("a14_cadastral_forest_sum", f"SELECT aoi_id, round(sum(forest_ha), 2) AS forest_ha FROM {_F} f GROUP BY 1")
def _(get):
    return _forest(get).groupBy("aoi_id").agg(F.round(F.sum("forest_ha"), 2).alias("forest_ha"))


@query("a18_parcel_metadata", f"WITH f AS (SELECT *, {_LABEL} AS designation FROM {_F} g), c AS (SELECT aoi_id, string_agg(concat(designation, ':', cast(n AS string)), '|' ORDER BY n DESC, designation) AS counts FROM (SELECT aoi_id, designation, count(*) AS n FROM f WHERE designation IS NOT NULL GROUP BY 1, 2) d GROUP BY 1) SELECT f.aoi_id, count(*) AS parcel_count, max(c.counts) AS counts, string_agg(f.parcel_id, ',' ORDER BY f.parcel_id) AS parcels FROM f LEFT JOIN c ON f.aoi_id = c.aoi_id GROUP BY 1")
def _(get):
    out = P.parcel_metadata(_forest(get), _label())
    counts = F.array_join(F.transform("designation_counts", lambda c: F.concat(c["designation"], F.lit(":"), c["n"].cast("string"))), "|")
    return out.select("aoi_id", "parcel_count", counts.alias("counts"), F.array_join(F.transform("parcels", lambda p: p["parcel_id"]), ",").alias("parcels"))


@query("j9_attach_stats", f"SELECT p.parcel_id, round(b.n * {PIXEL_HA}, 4) AS raster_ha FROM parcels p LEFT JOIN (SELECT concat('P', substr(box_id, 2)) AS parcel_id, (r1 - r0) * (c1 - c0) AS n FROM boxes) b ON p.parcel_id = b.parcel_id")
def _(get):
    stats = get("boxes").select(F.concat(F.lit("P"), F.substring("box_id", 2, 99)).alias("parcel_id"), ((F.col("r1") - F.col("r0")) * (F.col("c1") - F.col("c0")) * PIXEL_HA).alias("raster_ha"))
    return P.attach_stats(get("parcels").select("parcel_id"), stats, ["parcel_id"]).select("parcel_id", r4("raster_ha"))


@query("p26_parcel_comparison", f"SELECT parcel_id, round(land_ha, 4) AS land_ha, round(forest_ha, 4) AS forest_ha, round(land_ha * 0.9, 4) AS raster_land_ha, round(land_ha * 0.5, 4) AS raster_forest_ha, 0.0 AS raster_loss_ha FROM {_F} f")
def _(get):
    f = _forest(get).withColumn("raster_land_ha", F.col("land_ha") * 0.9).withColumn("raster_forest_ha", F.col("land_ha") * 0.5).withColumn("raster_loss_ha", F.lit(0.0))
    out = P.parcel_comparison(f)
    return out.select("parcel_id", *[r4(c) for c in out.columns if c != "parcel_id"])


@query("p22_loss_status", f"SELECT zone_id, round(loss_after_ha / 10000 * 100, 4) AS loss_pct, CASE WHEN loss_after_ha <= 60 THEN 'pass' ELSE 'fail' END AS status FROM ({_METRICS}) m")
def _(get):
    return P.loss_status(_metrics(get), F.lit(10000.0), F.col("loss_after_ha"), 60.0).select("zone_id", r4("loss_pct"), "status")


@query("p19_na", "SELECT parcel_id, coalesce(nullif(trim(siht1), ''), 'N/A') AS label FROM parcels")
def _(get):
    return get("parcels").select("parcel_id", C.na(F.col("siht1")).alias("label"))


@query("p20_yes_no", "SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN 'Yes' WHEN event_type = 'purchase' THEN 'No' ELSE 'N/A' END AS answer, count(*) AS n FROM events GROUP BY 1, 2")
def _(get):
    said = F.when(F.col("event_type").isin("click", "view"), " YES ").when(F.col("event_type") == "purchase", "false").otherwise("?")
    return get("events").groupBy("user_id", C.yes_no_na(said).alias("answer")).agg(F.count("*").alias("n"))


_FACTS = "SELECT parcel_id AS plot_id, siht1 AS kyc_operator_name, land_use AS prop_operator, land_use AS kyc_type, CASE WHEN pos % 4 = 0 THEN 'EE' END AS kyc_country, 'LV' AS prop_country, CASE WHEN pos % 5 = 0 THEN 'no' END AS detected, CASE WHEN pos % 2 = 0 THEN mets END AS summary_loss_ha, mets_ha AS metric_loss_ha, land_use AS map FROM parcels"


@query("p21_plot_blocks", f"SELECT plot_id, coalesce(nullif(trim(kyc_operator_name), ''), prop_operator, 'N/A') AS operator, 'N/A' AS address, coalesce(kyc_type, 'N/A') AS commodity_type, coalesce(kyc_country, prop_country) AS country_of_production, '2020-12-31' AS cutoff_date, CASE WHEN detected IS NOT NULL THEN 'No' WHEN coalesce(summary_loss_ha, metric_loss_ha) > 0 THEN 'Yes' WHEN coalesce(summary_loss_ha, metric_loss_ha) IS NOT NULL THEN 'No' ELSE 'N/A' END AS deforestation_detected, map AS evidence FROM ({_FACTS}) f")
def _(get):
    facts = get("parcels").selectExpr("parcel_id as plot_id", "siht1 as kyc_operator_name", "land_use as prop_operator", "land_use as kyc_type", "case when pos % 4 = 0 then 'EE' end as kyc_country", "'LV' as prop_country", "case when pos % 5 = 0 then 'no' end as detected", "case when pos % 2 = 0 then mets end as summary_loss_ha", "mets_ha as metric_loss_ha", "array(land_use) as evidence_maps")
    out = P.plot_report_blocks(facts)
    return out.select("plot_id", "operator", "address", "commodity_type", "country_of_production", "cutoff_date", "deforestation_detected", F.col("evidence_maps")[0].alias("evidence"))


@query("a19_merge_properties", "SELECT doc, key, arg_min(value, pos) AS value FROM (SELECT aoi_id AS doc, pos, 'siht1' AS key, siht1 AS value FROM parcels UNION ALL SELECT aoi_id, pos, 'land_use', land_use FROM parcels) t WHERE trim(value) <> '' GROUP BY 1, 2")
def _(get):
    props = F.create_map(F.lit("siht1"), "siht1", F.lit("land_use"), "land_use")
    return P.merge_properties(get("parcels").select(F.col("aoi_id").alias("doc"), "pos", props.alias("properties")))


# --- evidence -------------------------------------------------------------------------------------


def _sides(get) -> tuple[DataFrame, DataFrame]:
    a = get("artifacts")
    sha = lambda extra: F.sha2(F.concat(F.col("content"), extra), 256).alias("sha256")
    pub = a.where("published = 1").select("bundle_id", "relpath", sha(F.lit("")))
    return pub, a.where("local = 1").select("bundle_id", "relpath", sha(F.when(F.col("changed") == 1, "x").otherwise("")))


_STATE = "CASE WHEN published = 0 THEN 'added' WHEN local = 0 THEN 'removed' WHEN changed = 1 THEN 'changed' ELSE 'same' END"


@query("j11_diff_artifacts", f"SELECT bundle_id, relpath, {_STATE} AS state FROM artifacts WHERE published = 1 OR local = 1")
def _(get):
    return E.diff_artifacts(*_sides(get), ["bundle_id", "relpath"])


@query("j12_diff_signatures", f"SELECT bundle_id, relpath, {_STATE} AS state FROM artifacts WHERE (published = 1 OR local = 1) AND {_STATE} <> 'same'")
def _(get):
    return E.diff_signatures(*_sides(get), ["bundle_id", "relpath"])


@query("j12_diff_by_folders", f"SELECT bundle_id, relpath, {_STATE} AS state FROM artifacts WHERE bundle_id IS NOT NULL AND (published = 1 OR local = 1) AND {_STATE} <> 'same'")
def _(get):
    return E.diff_by_folders(*_sides(get), ["bundle_id"])


@query("s6_folder_sizes", """SELECT bundle_id, unnest(['', 'reports', regexp_replace(relpath, '/[^/]*$', '')]) AS folder, count(*) AS n_files, cast(sum(size_bytes) AS bigint) AS size_bytes FROM artifacts GROUP BY 1, 2""")
def _(get):
    files = get("artifacts").select("bundle_id", "relpath", F.sha2("content", 256).alias("sha256"), "size_bytes")
    return E.folder_signatures(files, ["bundle_id"]).drop("signature")


@query("u3_only_published", "SELECT relpath FROM artifacts WHERE published = 1 AND local = 0")
def _(get):
    a, b = _sides(get)
    return a.select("relpath").subtract(b.select("relpath"))


@query("u4_shared_paths", "SELECT relpath FROM artifacts WHERE published = 1 AND local = 1")
def _(get):
    a, b = _sides(get)
    return a.select("relpath").intersect(b.select("relpath"))


@query("u5_declared_paths", "SELECT bundle_id, relpath, min(pos) AS pos FROM (SELECT bundle_id, relpath, artifact_no AS pos FROM artifacts WHERE published = 1 UNION ALL SELECT bundle_id, relpath, artifact_no + 1000000 FROM artifacts) t GROUP BY 1, 2")
def _(get):
    a = get("artifacts")
    both = a.where("published = 1").select("bundle_id", "relpath", F.col("artifact_no").alias("pos")).union(a.select("bundle_id", "relpath", F.col("artifact_no") + 1000000))
    return E.declared_paths(both, "bundle_id", "relpath", "pos")


@query("s6_inventory_hashes", "SELECT bundle_id, sha256(concat(body, chr(10))) AS sha256, strlen(body) + 1 AS size_bytes, CAST(NULL AS string) AS content_type FROM (SELECT bundle_id, string_agg(relpath, chr(10) ORDER BY relpath) AS body FROM artifacts WHERE bundle_id IS NOT NULL GROUP BY 1) t")
def _(get):
    a = get("artifacts").where("bundle_id is not null")
    path = sources.scratch(a.sparkSession)
    a.groupBy("bundle_id").agg(F.array_join(F.array_sort(F.collect_list("relpath")), "\n").alias("value")).write.partitionBy("bundle_id").text(path)
    files = sources.file_inventory(a.sparkSession, path)
    return files.select(F.regexp_extract("relpath", "^bundle_id=([^/]*)/", 1).alias("bundle_id"), "sha256", "size_bytes", C.content_type(F.concat("relpath", F.lit(".bin"))).alias("content_type"))


_TYPE = "CASE WHEN relpath LIKE '%.geojson' THEN 'application/geo+json' WHEN relpath LIKE '%.json' THEN 'application/json' WHEN relpath LIKE '%.csv' THEN 'text/csv' END"


@query("f6_content_type", f"SELECT relpath, {_TYPE} AS content_type FROM artifacts")
def _(get):
    return get("artifacts").select("relpath", C.content_type(F.col("relpath")).alias("content_type"))


_PATHS = {**E.ROLES, "/x.json": "report_json", "/x.html": "report_html", "geo.json": "aoi_geometry", "x.bin": None}
_CASE_ROLE = " ".join(f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(_PATHS.values()))


@query("f7_artifact_role", f"SELECT artifact_no, CASE cast(artifact_no % {len(_PATHS)} AS int) {_CASE_ROLE} END AS role FROM artifacts")
def _(get):
    ends = F.array(*[F.lit(k if k.startswith("/") else f"/{k}") for k in _PATHS])
    path = F.concat(F.lit("out"), F.element_at(ends, (F.col("artifact_no") % len(_PATHS)).cast("int") + 1))
    return get("artifacts").select("artifact_no", E.artifact_role(path, F.lit("x"), F.lit("out/geo.json")).alias("role"))


@query("f12_row_hash", """SELECT relpath, sha256(concat('{"bundle_id":"', bundle_id, '","relpath":"', relpath, '"}')) AS row_sha FROM artifacts""")
def _(get):
    return get("artifacts").select("relpath", E.row_hash("relpath", "bundle_id").alias("row_sha"))


@query("f13_ids", "SELECT concat(bundle_id, '::', relpath) AS report_id FROM artifacts")
def _(get):
    return get("artifacts").select(F.concat_ws("::", "bundle_id", "relpath").alias("report_id"))


@query("f14_relative_path", "SELECT relpath, CASE WHEN relpath LIKE 'reports/en/%' THEN substr(relpath, 12) ELSE concat('../', substr(relpath, 9)) END AS href FROM artifacts")
def _(get):
    return get("artifacts").select("relpath", E.relative_path(F.col("relpath"), F.lit("reports/en")).alias("href"))


@query("p23_exclude_paths", "SELECT artifact_no FROM artifacts WHERE artifact_no % 9 IN (3, 5, 7, 8)")
def _(get):
    kinds = ["audit/x.json", "outputs/a/b.csv", "conf/keys.yml", "node_modules/x.js", "src/A.PYC", ".envrc", "conf/.env.local", "audits/x", "x/keys.yml.txt"]
    path = F.element_at(F.array(*map(F.lit, kinds)), (F.col("artifact_no") % 9).cast("int") + 1)
    return E.exclude_paths(get("artifacts").withColumn("relpath", path)).select("artifact_no")


def _yearly(get) -> DataFrame:
    return get("runs").select(F.make_date(F.year("bundle_date"), F.lit(1), F.lit(1)).alias("bundle_date"), F.col("site_id").alias("bundle_id"), F.col("run_name").alias("relpath"))


@query("s7_read_evidence", "SELECT bundle_id, relpath FROM (SELECT date_trunc('year', bundle_date) AS y, site_id AS bundle_id, run_name AS relpath FROM runs) t WHERE y BETWEEN DATE '1994-01-01' AND DATE '1995-03-31'")
def _(get):
    rows = _yearly(get)
    path = sources.scratch(rows.sparkSession)
    sources.write_evidence(rows, path)
    return sources.read_evidence(rows.sparkSession, path, "1994-01-01", "1995-03-31").select("bundle_id", "relpath")


@query("s11_write_evidence", "SELECT site_id AS bundle_id, count(*) AS n, count(*) FILTER (WHERE site_id = 'site3' AND year(bundle_date) = 1995) AS n_new FROM runs WHERE NOT (site_id = 'site3' AND year(bundle_date) = 1995 AND run_name LIKE '%1') GROUP BY 1")
def _(get):
    rows = _yearly(get)
    path = sources.scratch(rows.sparkSession)
    sources.write_evidence(rows.withColumn("v", F.lit(1)), path)
    again = rows.where("bundle_id = 'site3' and bundle_date = date'1995-01-01' and relpath not like '%1'").withColumn("v", F.lit(2))
    sources.write_evidence(again, path)  # replaces one bundle, leaves the others
    return rows.sparkSession.read.parquet(path).groupBy("bundle_id").agg(F.count("*").alias("n"), F.count_if(F.col("v") == 2).alias("n_new"))


@query("w3_latest_runs", "SELECT site_id, run_name, cast(k AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY bundle_date DESC, run_name DESC) AS k FROM runs) t WHERE k <= 2")
def _(get):
    return E.latest_runs(get("runs")).select("site_id", "run_name", "rank")


@query("w5_bundle_order", "SELECT cast(bundle_date AS string) AS bundle_date, site_id AS bundle_id, run_name AS relpath FROM runs ORDER BY 1, 2, 3")
def _(get):
    return E.ordered(get("runs").select(F.col("bundle_date").cast("string").alias("bundle_date"), F.col("site_id").alias("bundle_id"), F.col("run_name").alias("relpath")), "bundles")


@query("f11_run_timestamp", "SELECT run_name, cast(substr(run_name, 5, 10) AS timestamp) + CASE WHEN k = 1 THEN INTERVAL 11045 SECOND ELSE INTERVAL 0 SECOND END AS run_at FROM (SELECT *, cast(right(run_name, 1) AS int) % 3 AS k FROM runs) t WHERE k < 2 UNION ALL SELECT run_name, CASE WHEN has_report = 1 THEN cast(bundle_date AS timestamp) ELSE TIMESTAMP '1970-01-01 00:00:00' END FROM runs WHERE cast(right(run_name, 1) AS int) % 3 = 2")
def _(get):
    k = F.substring("run_name", -1, 1).cast("int") % 3
    day = F.substring("run_name", 5, 10)
    name = F.when(k == 0, F.col("run_name")).when(k == 1, F.concat(F.lit("x-"), F.replace(day, F.lit("-"), F.lit("")), F.lit("-030405"))).otherwise("run")
    modified = F.when(F.col("has_report") == 1, F.col("bundle_date").cast("timestamp"))
    return get("runs").select("run_name", C.run_timestamp(name, modified, F.lit("none")).alias("run_at"))


_LATEST = "(SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY bundle_date DESC, run_name DESC) AS k FROM runs)"


def _files(get) -> tuple[DataFrame, DataFrame]:
    """Files of runs and links of the index: every run has a page, those with a report its JSON too; links of every tenth lack."""
    runs = get("runs")
    names = F.when(F.col("has_report") == 1, F.array(*map(F.lit, E.RUN_FILES))).otherwise(F.array(F.lit(E.RUN_FILES[0])))
    links = runs.where("run_name not like '%7'").select("site_id", F.format_string("../runs/%s/report.html", "run_name").alias("href"))
    return runs.select("site_id", "run_name", F.explode(names).alias("file")), links


@query("v12_publishable", f"SELECT site_id, count(*) AS n_runs, count(*) FILTER (WHERE has_report = 0) AS n_without, count(*) FILTER (WHERE run_name LIKE '%7') AS n_unlinked, count(*) = 2 AND count(*) FILTER (WHERE has_report = 0 OR run_name LIKE '%7') = 0 AS ok FROM {_LATEST} t WHERE k <= 2 GROUP BY 1")
def _(get):
    return E.publishable(E.latest_runs(get("runs")), *_files(get))


_METRIC = "SELECT event_id, split_part(raw, '=', 1) AS variable, cast(split_part(split_part(raw, '=', 2), ':', 1) AS double) AS value, split_part(raw, ':', 2) AS unit, split_part(raw, ':', 3) AS source, 'note a:b' AS notes FROM metric_text WHERE event_id % 50 <> 0"


@query("f1_metric_text", f"{_METRIC}")
def _(get):
    return E.metric_rows(get("metric_text"))[0].select("event_id", "variable", "value", "unit", "source", "notes")


@query("a15_metrics_map", f"SELECT variable, arg_max(value, event_id) AS value, arg_max(unit, event_id) AS unit, arg_max(notes, event_id) AS notes FROM ({_METRIC}) m GROUP BY 1")
def _(get):
    one = E.metrics_map(E.metric_rows(get("metric_text"))[0], "event_id")
    return one.select(F.explode("metrics").alias("variable", "m")).select("variable", "m.*")


@query("s10_write_metrics", f"SELECT variable, count(*) AS n, round(sum(value), 2) AS total, max(notes) AS notes FROM ({_METRIC}) m GROUP BY 1")
def _(get):
    rows = E.metric_rows(get("metric_text"))[0]
    path = sources.scratch(rows.sparkSession)
    sources.write_metrics(rows, path)
    back = rows.sparkSession.read.option("header", True).csv(path)
    return back.groupBy("variable").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total"), F.max("notes").alias("notes"))


@query("s10_metric_rejects", "SELECT event_id, raw FROM metric_text WHERE event_id % 50 = 0")
def _(get):
    return E.metric_rows(get("metric_text"))[1].select("event_id", "raw")


@query("f2_safe_id", "SELECT parcel_id, regexp_replace(trim(siht1), '[^A-Za-z0-9._-]+', '_', 'g') AS safe FROM parcels WHERE trim(siht1) <> ''")
def _(get):
    return get("parcels").where("trim(siht1) <> ''").select("parcel_id", C.safe_id(F.col("siht1")).alias("safe"))


@query("f3_number", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN cast(event_id AS double) / 2 END AS value FROM events")
def _(get):
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), (F.col("event_id").cast("decimal(20,1)") / 2).cast("string"))).when(F.col("event_id") % 3 == 1, "5d").otherwise("1_000")
    return get("events").select("event_id", C.number(text).alias("value"))


@query("f4_end_year", "WITH l AS (SELECT *, split_part(dependency_id, '/', 1) AS family, cast(substr(url, 25, 4) AS int) AS y FROM links) SELECT l.dependency_id, CASE WHEN probe % 3 = 0 THEN 2024 WHEN probe % 3 = 1 THEN l.y ELSE m.y END AS end_year FROM l JOIN (SELECT family, max(y) AS y FROM l GROUP BY 1) m ON l.family = m.family")
def _(get):
    links = get("links").withColumn("family", C.link_family(F.col("dependency_id")))
    folders = links.groupBy("family").agg(C.latest_year(F.col("url")).alias("latest"))
    version = F.when(F.col("probe") % 3 == 0, "2024-v1.12").otherwise("v1")
    path = F.when(F.col("probe") % 3 == 1, F.col("url")).otherwise("/data/x")
    return links.join(folders, "family").select("dependency_id", F.coalesce(C.end_year(version, path), "latest").alias("end_year"))


@query("f5_tile_of_path", "SELECT box_id, concat('N', lpad(cast(r0 % 90 AS string), 2, '0'), '_E', lpad(cast(c0 AS string), 3, '0')) AS tile_id FROM boxes")
def _(get):
    name = F.concat(F.lit("n"), F.lpad((F.col("r0") % 90).cast("string"), 2, "0"), F.lit("_e"), F.lpad(F.col("c0").cast("string"), 3, "0"))
    return get("boxes").select("box_id", C.tile_of_path(F.concat(F.lit("/x/"), name, F.lit("/lossyear.tif"))).alias("tile_id"))


@query("p10_prune_tiles", "SELECT DISTINCT tile_id FROM pixels WHERE tile_id IN ('T2', 'T5')")
def _(get):
    tiles = get("pixels").select("tile_id").distinct()
    return S.prune_tiles(tiles, tiles.where(F.col("tile_id").isin("T2", "T5")))


@query("u1_policy_refs", "SELECT DISTINCT trim(ref) AS ref FROM (SELECT p_type AS ref FROM part UNION ALL SELECT p_brand FROM part) t WHERE trim(ref) <> '' AND ref NOT LIKE '#%'")
def _(get):
    return E.policy_refs(get("part").select(F.col("p_type").alias("ref")), get("part").select(F.col("p_brand").alias("ref")))


# --- catalogue and links --------------------------------------------------------------------------


@query("j10_join_families", "SELECT c.dataset_id, c.name, f.family FROM catalogue c LEFT JOIN families f ON c.dataset_id = f.dataset_id")
def _(get):
    return E.join_families(get("catalogue"), get("families"))


@query("s4_seed_rows", "SELECT dataset_id, name FROM catalogue")
def _(get):
    rows = get("catalogue")
    path = sources.scratch(rows.sparkSession)
    rows.write.option("header", True).csv(path)
    return sources.read_seed_csv(rows.sparkSession, path)


@query("s5_link_registry", "SELECT dependency_id, url, expected_content_type, CAST(NULL AS string) AS update_policy, 10 AS n_columns FROM links WHERE probe % 4 <> 0")
def _(get):
    rows = get("links")
    path = sources.scratch(rows.sparkSession)
    note = F.when(F.col("probe") % 4 == 0, F.concat(F.lit("# "), "dependency_id")).otherwise(F.col("dependency_id"))
    rows.select(note.alias("dependency_id"), "url", "expected_content_type").write.option("header", True).option("comment", "~").csv(path)  # else the writer quotes what begins with #
    out = sources.read_link_registry(rows.sparkSession, path)
    return out.select("dependency_id", "url", "expected_content_type", "update_policy", F.lit(len(out.columns)).alias("n_columns"))


@query("s12_export_catalogue", "SELECT c.dataset_id, c.name, f.family FROM catalogue c LEFT JOIN families f ON c.dataset_id = f.dataset_id")
def _(get):
    out = E.join_families(get("catalogue"), get("families"))
    path = sources.scratch(out.sparkSession)
    sources.export_catalogue(out, path)
    return sources.read_seed_csv(out.sparkSession, path)


def _features(get) -> DataFrame:
    """A GeoJSON document for each area, and one bare geometry for each box of area A0."""
    ring = F.array(*[F.array(F.col(x).cast("double"), F.col(y).cast("double")) for x, y in (("c0", "r0"), ("c1", "r0"), ("c1", "r1"), ("c0", "r1"), ("c0", "r0"))])
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    one = F.struct(F.lit("Feature").alias("type"), F.struct("box_id", "aoi_id").alias("properties"), shape.alias("geometry"))
    whole = get("boxes").groupBy("aoi_id").agg(F.array_sort(F.collect_list(F.struct("box_id", one.alias("f")))).alias("s"))
    return whole.select("aoi_id", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("s", lambda x: x["f"]).alias("features"))).alias("value"))


@query("s1_read_features", "SELECT box_id, aoi_id, row_number() OVER (PARTITION BY aoi_id ORDER BY box_id) AS pos, cast((c1 - c0) * (r1 - r0) AS double) AS area FROM boxes")
def _(get):
    documents = _features(get)
    path = sources.scratch(documents.sparkSession)
    documents.write.partitionBy("aoi_id").text(path)
    rows = sources.read_features(documents.sparkSession, path)
    zones = sources.zones_of_features(rows)
    return zones.select(F.col("properties")["box_id"].alias("box_id"), F.col("properties")["aoi_id"].alias("aoi_id"), F.col("pos").cast("bigint").alias("pos"), F.abs(R.polygon_area(F.col("polygons"))).alias("area"))


@query("s2_read_parcels", "SELECT parcel_id, forest_area_ha, CASE WHEN forest_area_ha IS NULL THEN 'missing' ELSE 'register' END AS reference_source, fmt FROM parcels, (SELECT unnest(['csv', 'json']) AS fmt) t")
def _(get):
    p = get("parcels")
    rows = p.select("parcel_id", F.coalesce(F.col("forest_area_ha").cast("string"), F.lit(" ")).alias("forest_area_ha"), F.lit("register").alias("reference_source"), F.lit("m").alias("reference_method"))
    path = sources.scratch(p.sparkSession)
    rows.write.option("header", True).csv(f"{path}/csv")
    rows.write.json(f"{path}/json")
    read = lambda fmt: sources.read_parcels(p.sparkSession, f"{path}/{fmt}", fmt).select("parcel_id", "forest_area_ha", "reference_source", F.lit(fmt).alias("fmt"))
    return read("csv").union(read("json"))


@query("s8_read_reports", "SELECT aoi_id, count(*) AS n_metrics, cast(1 AS bigint) AS n_bad FROM parcels GROUP BY 1")
def _(get):
    p = get("parcels")
    path = sources.scratch(p.sparkSession)
    whole = p.groupBy("aoi_id").agg(F.collect_list("parcel_id").alias("ids"))
    good = whole.select("aoi_id", F.to_json(F.struct("aoi_id", "ids")).alias("value"))
    bad = whole.select(F.lit("broken").alias("aoi_id"), F.lit('{"aoi_id": ').alias("value")).limit(1)
    good.union(bad).write.partitionBy("aoi_id").text(path)
    rows, broken = sources.read_reports(p.sparkSession, path, "aoi_id string, ids array<string>")
    return rows.select("aoi_id", F.size("ids").cast("bigint").alias("n_metrics")).crossJoin(broken.agg(F.count("*").alias("n_bad")))


@query("s9_write_parcels", "SELECT parcel_id, aoi_id, 'POINT' AS geometry FROM parcels")
def _(get):
    p = get("parcels").withColumn("geometry", F.lit("POINT"))
    path = sources.scratch(p.sparkSession)
    sources.write_parcels(p, path, ["parcel_id", "aoi_id"])
    table = p.sparkSession.read.option("header", True).csv(f"{path}/table")
    kind = "type string, properties struct<parcel_id:string,aoi_id:string>, geometry string"
    rows = p.sparkSession.read.schema(kind).json(f"{path}/features").select("properties.parcel_id", "geometry")
    return table.join(rows, "parcel_id").select("parcel_id", "aoi_id", "geometry")


_SCORE = "CASE WHEN http_status BETWEEN 200 AND 399 THEN 1.0 ELSE 0.0 END + CASE WHEN starts_with(content_type, expected_content_type) THEN 0.5 ELSE 0.0 END + CASE WHEN http_status BETWEEN 200 AND 299 THEN 0.2 ELSE 0.0 END"


@query("f9_link_score", f"SELECT dependency_id, split_part(dependency_id, '/', 1) AS family, round(cast({_SCORE} AS double), 4) AS score FROM links")
def _(get):
    return E.scored_links(get("links")).select("dependency_id", "family", r4("score"))


_Y = "cast(substr(url, 25, 4) AS int)"
_V = "cast(regexp_extract(url, 'v1\\.(\\d+)', 1) AS int)"


@query("f8_link_candidates", f"SELECT dependency_id, replace(url, concat('GFC-', cast({_Y} AS string)), concat('GFC-', cast({_Y} + 1 AS string))) AS candidate, 'year_bump_probe' AS method FROM links UNION ALL SELECT dependency_id, replace(url, concat('v1.', cast({_V} AS string), '/'), concat('v1.', cast({_V} + 1 AS string), '/')), 'version_probe' FROM links")
def _(get):
    twice = F.concat("url", F.lit("?v9.1"))  # only the first version and year count
    rows = get("links").select("dependency_id", F.explode(C.link_candidates(twice)).alias("c"))
    return rows.select("dependency_id", F.replace("c.url", F.lit("?v9.1"), F.lit("")).alias("candidate"), "c.method")


@query("f15_normalised_links", "SELECT dependency_id, url FROM links WHERE contains(dependency_id, 'fam3')")
def _(get):
    return E.normalised_links(get("links"), "fam3").select("dependency_id", "url")


@query("w4_best_candidate", f"SELECT family, dependency_id FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY score DESC, probe) AS k FROM (SELECT *, split_part(dependency_id, '/', 1) AS family, {_SCORE} AS score FROM links) s WHERE score > 1.0) t WHERE k = 1")
def _(get):
    return E.best_candidate(E.scored_links(get("links")), "family", F.lit(1.0)).select("family", "dependency_id")


@query("a16_link_summary", "SELECT count(*) AS checked, count(*) FILTER (WHERE NOT coalesce(http_status BETWEEN 200 AND 399, false)) AS broken FROM links")
def _(get):
    return E.link_summary(get("links"))


@query("j13_append_history", "SELECT dependency_id, url FROM links")
def _(get):
    rows = get("links").select("dependency_id", "url", F.lit("tool").alias("discovered_by"), F.lit("bump").alias("discovery_method"))
    half = rows.where("dependency_id like 'fam1%'")
    return E.append_history(E.append_history(half, rows.union(rows)), rows).select("dependency_id", "url")


@query("j14_promote", "SELECT dependency_id, CASE WHEN dependency_id LIKE 'fam2%' THEN concat(url, '?new') ELSE url END AS url FROM links")
def _(get):
    links = get("links").select("dependency_id", "url")
    return E.promote(links, links.where("dependency_id like 'fam2%'").withColumn("url", F.concat("url", F.lit("?new")))).select("dependency_id", "url")


@query("q9_page_artifacts", "SELECT page_id, href, min(pos) AS pos FROM (SELECT page_id, trim(unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS href, generate_subscripts(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), 1) - 1 AS pos FROM pages) t WHERE href <> '' GROUP BY 1, 2")
def _(get):
    return E.page_artifacts(get("pages")).select("page_id", "href", F.col("pos").cast("bigint").alias("pos"))


# pages as reports: every third has its time in a cell, every fifth no list
_REPORT_PAGES = "SELECT page_id, concat('<p>Generated (UTC)', CASE WHEN page_id % 3 = 0 THEN '</p><table><td> ' ELSE ': <code> ' END, page_id, CASE WHEN page_id % 3 = 0 THEN ' </td></table>' ELSE ' </code></p>' END, '<a href=\"before\">x</a>', CASE WHEN page_id % 5 = 0 THEN '<h2>Other</h2>' WHEN page_id % 2 = 0 THEN '<h2>Artifacts</h2>' ELSE '<h2 id=\"a\">Declared evidence artifacts (2)</h2>' END, '<ul><li><a href=\" ', url, ' \">x</a></li><li><a class=\"c\" href=\"r', page_id, '.json\">x</a></li>', html, '</ul>') AS html FROM pages"


@query("q9_declared_artifacts", f"""SELECT page_id, generated_utc, href, min(pos) AS pos FROM (SELECT page_id, trim(coalesce(nullif(regexp_extract(html, '(?is)Generated \\(UTC\\).*?<code>([^<]+)</code>', 1), ''), regexp_extract(html, '(?is)Generated \\(UTC\\).*?<td>([^<]+)</td>', 1))) AS generated_utc, trim(unnest(hrefs), ' \"''') AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM (SELECT page_id, html, regexp_extract_all(array_to_string(regexp_extract_all(html, '(?is)<h2\\b[^>]*>(?:[^<]*declared evidence artifacts[^<]*|\\s*artifacts\\s*)</h2>(.*?)</ul>', 1), chr(10)), '(?i)<a\\s(?:[^>]*?\\s)??href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>"'']+)', 1) AS hrefs FROM ({_REPORT_PAGES}) r) a) t WHERE href <> '' GROUP BY 1, 2, 3""")
def _(get):
    return E.declared_artifacts(get(_REPORT_PAGES)).select("page_id", "generated_utc", "href", F.col("pos").cast("bigint").alias("pos"))


# --- integrity rules: orders stand for reports, their items for results ----------------------------

_RESULTS = "SELECT cast(l_orderkey AS bigint) AS report_id, cast(l_linenumber AS bigint) AS result_id, cast(l_suppkey % 7 AS bigint) AS assumption_id, l_returnflag = 'R' AS flagged FROM lineitem"


@query("v2_unknown_class", "SELECT DISTINCT cast(o_orderkey AS bigint) AS report_id, 'unknown_class_id' AS rule, cast(cast(o_custkey AS bigint) AS string) AS detail FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o_custkey AND c.c_custkey % 3 = 0)")
def _(get):
    trace = get("orders").select(F.col("o_orderkey").cast("bigint").alias("report_id"), F.col("o_custkey").cast("bigint").alias("class_id"))
    known = trace.join(get("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("bigint").alias("class_id")), "class_id", "left_semi")
    return E.traceability_unknown(trace, {"class_id": known})


@query("v3_untraced_results", f"SELECT DISTINCT report_id, 'untraced_result' AS rule, cast(result_id AS string) AS detail FROM ({_RESULTS}) r WHERE result_id > 4")
def _(get):
    r = get(_RESULTS)
    return E.untraced_results(r, r.where("result_id <= 4"))


@query("v4_assumption_of_unknown_result", f"SELECT DISTINCT report_id, 'unknown_result' AS rule, cast(result_id AS string) AS detail FROM ({_RESULTS}) r WHERE result_id > 5")
def _(get):
    r = get(_RESULTS)
    return E.dangling(r, r.where("result_id <= 5"), ["report_id", "result_id"], "unknown_result", "result_id")


@query("v5_unknown_assumption", f"SELECT DISTINCT report_id, 'unknown_assumption' AS rule, cast(assumption_id AS string) AS detail FROM ({_RESULTS}) r WHERE assumption_id >= 5")
def _(get):
    r = get(_RESULTS)
    return E.dangling(r, r.where("assumption_id < 5").select("assumption_id").distinct(), ["assumption_id"], "unknown_assumption", "assumption_id")


@query("v6_unflagged_results", f"SELECT r.report_id, 'unflagged_result' AS rule, cast(r.result_id AS string) AS detail FROM ({_RESULTS}) r WHERE NOT r.flagged AND EXISTS (SELECT 1 FROM ({_RESULTS}) a WHERE a.report_id = r.report_id AND a.result_id = r.result_id AND a.assumption_id = 0)")
def _(get):
    r = get(_RESULTS)
    return E.unflagged_results(r, r.select("report_id", "result_id", (F.col("assumption_id") != 0).alias("testable")))


@query("v7_missing_blocks", "SELECT parcel_id AS report_id, 'missing_block' AS rule, 'siht1' AS detail FROM parcels WHERE mets IS NOT NULL AND trim(siht1) = '' UNION ALL SELECT parcel_id, 'missing_block', 'pindala' FROM parcels WHERE mets IS NOT NULL AND pindala IS NULL UNION ALL SELECT parcel_id, 'placeholder_methodology', 'is_placeholder' FROM parcels WHERE mets IS NOT NULL AND pos % 4 <> 0")
def _(get):
    df = get("parcels").select(F.col("parcel_id").alias("report_id"), F.col("mets").isNotNull().alias("has_loss"), "siht1", "pindala", F.when(F.col("pos") % 4 == 0, False).when(F.col("pos") % 4 == 1, True).alias("placeholder"))
    return E.missing_blocks(df, ["siht1", "pindala"], F.col("placeholder"))


@query("v9_missing_dependency", "SELECT parcel_id AS report_id, 'missing_dependency' AS rule, CASE WHEN pos % 3 = 0 THEN 'none' ELSE 'hansen_gfc_2024_v1_12' END AS detail FROM parcels WHERE mets IS NOT NULL AND pos % 3 <> 1")
def _(get):
    p = get("parcels").withColumn("report_id", F.col("parcel_id")).withColumn("has_loss", F.col("mets").isNotNull())
    deps = p.where("pos % 3 <> 0").select("report_id", F.when(F.col("pos") % 3 == 1, "hansen_gfc_2024_v1_12").otherwise("other").alias("dependency_id"))
    return E.reports_without_dependency(p, deps.union(deps))


@query("v8_unlisted_paths", "SELECT DISTINCT bundle_id AS report_id, 'unlisted_path' AS rule, relpath AS detail FROM artifacts WHERE published = 1 AND local = 0")
def _(get):
    a = get("artifacts").withColumn("report_id", F.col("bundle_id"))
    return E.dangling(a.where("published = 1"), a.where("local = 1"), ["report_id", "relpath"], "unlisted_path", "relpath")


@query("v9_tiles_without_source", "SELECT aoi_id AS report_id, 'tile_without_source' AS rule, parcel_id AS detail FROM parcels WHERE mets IS NOT NULL AND trim(siht1) = ''")
def _(get):
    tiles = get("parcels").select(F.col("aoi_id").alias("report_id"), F.col("parcel_id").alias("tile_id"), F.when(F.col("mets").isNotNull(), "x").alias("local_path"), F.col("siht1").alias("source_url"))
    return E.tiles_without_source(tiles)


@query("v10_assessable_missing", "SELECT parcel_id AS report_id, 'assessable_with_missing_class' AS rule, '' AS detail FROM parcels WHERE mets IS NOT NULL AND pindala IS NULL")
def _(get):
    classes = F.array(F.struct(F.lit(True).alias("mandatory"), F.when(F.col("pindala").isNull(), "missing").otherwise("present").alias("status")))
    return E.assessable_but_missing(get("parcels").select(F.col("parcel_id").alias("report_id"), F.col("mets").isNotNull().alias("assessable"), classes.alias("classes")))


@query("v11_class_status", "SELECT a.bundle_id AS report_id, l.lang AS class_id, CASE WHEN count(*) FILTER (WHERE a.published = 1 AND a.relpath LIKE concat('reports/', l.lang, '/%')) > 0 THEN 'present' ELSE 'missing' END AS status FROM artifacts a, (SELECT DISTINCT lang FROM documents) l GROUP BY 1, 2")
def _(get):
    a = get("artifacts").select(F.col("bundle_id").alias("report_id"), F.split("relpath", "/")[1].alias("class_id"), "published")
    classes = a.select("report_id").distinct().join(F.broadcast(get("documents").select(F.col("lang").alias("class_id")).distinct()))
    return E.class_status(classes, a.where("published = 1"))


_BAD = {
    "('required', 'aoi_id')": "pos % 11 = 0", "('required', 'map')": None, "('enum', 'report_version')": "pos % 5 = 0", "('sha256', 'evidence_artifacts[].sha256')": "pos % 7 = 0",
    "('minimum', 'evidence_artifacts[].size_bytes')": "pos % 3 = 0", "('min_length', 'bundle_id')": "pos % 2 = 0", "('min_items', 'datasets')": "pos % 13 = 0", "('enum', 'policy_mapping[].status')": "pos % 17 = 0",
}
_LACKING = ["inputs", "metrics", "evidence_registry", "acceptance_criteria", "regulatory_traceability", "assumptions", "policy_mapping_refs", "parameters", "results_summary"]
_V1 = " UNION ALL ".join([f"SELECT parcel_id AS report_id, {k[1:-1].split(', ')[0]} AS rule, {k[1:-1].split(', ')[1]} AS detail FROM parcels WHERE {w}" for k, w in _BAD.items() if w] + [f"SELECT parcel_id, 'required', '{k}' FROM parcels" for k in _LACKING])


@query("v1_contract_errors", _V1)
def _(get):
    when = lambda n, bad, good: F.when(F.col("pos") % n == 0, bad).otherwise(good)
    artifact = F.struct(F.lit("a").alias("relpath"), when(7, F.lit("xyz"), F.sha2("parcel_id", 256)).alias("sha256"), when(3, F.lit(-1), F.lit(5)).alias("size_bytes"))
    whole = F.struct(F.lit("a").alias("relpath"), F.sha2("parcel_id", 256).alias("sha256"), F.lit(0).alias("size_bytes"))
    dataset = F.struct(F.lit("d").alias("dataset_id"), F.lit("2024").alias("retrieved_at_utc"), F.lit("free").alias("license"))
    mapping = F.struct(F.lit("a").alias("article_ref"), F.lit("r").alias("requirement"), F.array(F.lit("f")).alias("evidence_fields"), F.array(F.lit("p")).alias("artifact_relpaths"), when(17, F.lit("maybe"), F.lit("pass")).alias("status"))
    meta = F.struct(F.lit("test").alias("report_type"), F.lit("EUDR").alias("regulatory_context"), F.lit("assessable").alias("assessment_capability"))
    geometry = F.struct(F.lit("wkt").alias("kind"), F.lit("POINT").alias("value"))
    reports = get("parcels").select(
        F.col("parcel_id").alias("report_id"), when(5, F.lit("v1"), F.lit("aoi_report_v2")).alias("report_version"), F.lit("2024").alias("generated_at_utc"), when(2, F.lit(""), F.lit("b")).alias("bundle_id"), meta.alias("report_metadata"),
        F.when(F.col("pos") % 11 != 0, F.col("aoi_id")).alias("aoi_id"), geometry.alias("aoi_geometry_ref"), F.array(whole, artifact).alias("evidence_artifacts"),
        when(13, F.array().cast("array<struct<dataset_id:string,retrieved_at_utc:string,license:string>>"), F.array(dataset)).alias("datasets"), F.array(mapping).alias("policy_mapping"),
    )
    return E.report_errors(reports)


_LINES = "SELECT cast(l_orderkey AS bigint) AS k, cast(l_linenumber AS int) AS ln, cast(l_partkey AS int) AS pk, cast(l_suppkey AS int) AS sk, l_returnflag = 'R' AS rf, l_quantity > 10 AS listed FROM lineitem"
#: What the reports of ``_nested`` break, by rule; ``loss`` holds the orders whose report speaks of loss.
_BROKEN = {
    "unknown_evidence_class": "'c4' FROM l WHERE ln <= 4 AND pk % 5 = 4",
    "unknown_acceptance_criteria": "'k2' FROM l WHERE ln = 2",
    "unknown_result_ref": "concat('x', ln) FROM l WHERE ln <= 4 AND pk % 7 = 0",
    "untraced_result": "concat('r', ln) FROM l WHERE NOT EXISTS (SELECT 1 FROM l AS o WHERE o.k = l.k AND o.ln = l.ln AND o.ln <= 4 AND o.pk % 7 <> 0)",
    "unknown_result": "concat('r', ln + 1) FROM l WHERE NOT EXISTS (SELECT 1 FROM l AS o WHERE o.k = l.k AND o.ln = l.ln + 1)",
    "unknown_assumption": "concat('a', pk % 5) FROM l WHERE NOT EXISTS (SELECT 1 FROM l AS o WHERE o.k = l.k AND o.sk % 5 = l.pk % 5)",
    "unflagged_result": "concat('r', ln) FROM l WHERE NOT rf AND EXISTS (SELECT 1 FROM l AS o WHERE o.k = l.k AND o.ln = l.ln - 1 AND o.sk % 5 = 0)",
    "missing_block": "unnest([CASE WHEN k % 4 = 0 THEN 'computed.forest_loss_post_2020' END, CASE WHEN k % 5 = 0 THEN 'methodology.forest_loss_post_2020' END, CASE WHEN k % 6 = 0 THEN 'computed_outputs.forest_loss_post_2020' END]) FROM loss",
    "placeholder_methodology": "'is_placeholder' FROM loss WHERE k % 5 <> 0 AND k % 7 = 0",
    "unlisted_path": "unnest([CASE WHEN NOT EXISTS (SELECT 1 FROM l AS o WHERE o.k = l.k AND o.ln = l.ln AND o.listed) THEN concat('p', ln) END, CASE WHEN k IN (SELECT k FROM loss) AND k % 6 <> 0 THEN concat('m', k) END]) FROM l",
    "missing_dependency": "CASE WHEN k % 8 = 0 OR NOT EXISTS (SELECT 1 FROM l WHERE l.k = loss.k AND ln <= 2) THEN 'none' WHEN NOT EXISTS (SELECT 1 FROM l WHERE l.k = loss.k AND ln <= 2 AND pk % 2 = 0) THEN 'hansen_gfc_2024_v1_12' END FROM loss",
    "tile_without_source": "concat('t', ln) FROM l WHERE k IN (SELECT k FROM loss) AND k % 8 <> 0 AND ln <= 2 AND pk % 3 = 0 AND sk % 2 = 0",
    "missing_outcome": "'validation.forest_area_crosscheck.outcome' FROM loss WHERE k % 18 = 0",
    "assessable_with_missing_class": "'' FROM l WHERE k % 10 = 0",
}
_BROKEN_SQL = " UNION ALL ".join(f"SELECT DISTINCT k, '{rule}' AS rule, {rest.replace(' FROM ', ' AS detail FROM ', 1) if not rest.startswith(('unnest', 'CASE')) else ' AS detail FROM '.join(rest.rsplit(' FROM ', 1))}" for rule, rest in _BROKEN.items())


def _nested(get) -> DataFrame:
    """A report in JSON for each order, with its lines as results, assumptions, artifacts and dependencies."""
    named = lambda letter, c: F.concat(F.lit(letter), F.col(c) if isinstance(c, str) else c)
    k = F.col("k")
    # lines come together once; the lists are made of them in their order's row
    every = lambda made, where=None: F.array_sort(F.array_distinct(F.transform("lines" if where is None else F.filter("lines", where), made)))
    ref = lambda l: F.concat(F.when(l["pk"] % 7 == 0, "x").otherwise("r"), l["ln"])
    trace = lambda l: F.struct(named("c", l["pk"] % 5).alias("evidence_class"), named("k", l["ln"] % 3).alias("acceptance_criteria"), ref(l).alias("result_ref"))
    kind = lambda l: F.when(l["rf"], "forest_loss_post_2020").otherwise("other")
    result = lambda l: F.struct(named("r", l["ln"]).alias("result_id"), F.array(named("a", l["pk"] % 5)).alias("assumption_refs"), F.array(kind(l)).alias("evidence_classes"), l["rf"].alias("non_testable_due_to_assumptions"))
    assumption = lambda l: F.struct(named("a", l["sk"] % 5).alias("assumption_id"), (l["sk"] % 5 != 0).alias("testable"), F.array(named("r", l["ln"] + 1)).alias("affects_results"))
    tile = lambda l: F.struct(named("t", l["ln"]).alias("tile_id"), F.when(l["sk"] % 2 == 0, " ").otherwise("u").alias("source_url"))
    source = lambda l: F.struct(F.when(l["pk"] % 2 == 0, V.WANTED).otherwise("other").alias("dependency_id"), F.when(l["pk"] % 3 == 0, "local").otherwise("url").alias("tile_source"), F.array(tile(l)).alias("tiles_used"))
    path = lambda l: F.struct(named("p", l["ln"]).alias("relpath"))
    article = lambda l: F.struct(named("x", l["ln"]).alias("article_ref"), F.array(named("p", l["ln"])).alias("artifact_relpaths"))
    orders = get(_LINES).groupBy("k").agg(F.collect_list(F.struct("ln", "pk", "sk", "rf", "listed")).alias("lines")).select(
        "k", every(trace, lambda l: l["ln"] <= 4).alias("regulatory_traceability"), every(result).alias("results"), every(assumption).alias("assumptions"),
        every(source, lambda l: (l["ln"] <= 2) & (k % 8 != 0)).alias("external_dependencies"), every(path, lambda l: l["listed"]).alias("evidence_artifacts"), every(article).alias("policy_mapping"),
    )
    block = lambda n, inner: F.when(k % n != 0, F.struct(inner.alias("forest_loss_post_2020")))
    classes = F.array(*[F.struct(F.lit(f"c{i}").alias("class_id"), F.lit(i == 0).alias("mandatory"), F.when(k % 10 == 0, "missing").otherwise("present").alias("status")) for i in range(4)])
    return orders.select(
        named("R", "k").alias("report_id"), "regulatory_traceability", "results", "assumptions", "external_dependencies", "evidence_artifacts", "policy_mapping",
        F.struct(classes.alias("evidence_classes")).alias("evidence_registry"), F.array(*[F.struct(F.lit(c).alias("criteria_id")) for c in ("k0", "k1")]).alias("acceptance_criteria"),
        F.struct(F.lit("assessable").alias("assessment_capability")).alias("report_metadata"),
        F.when(k % 3 == 0, F.create_map(F.lit(V.LOSS_METRIC), F.struct(F.lit(1.0).alias("value")))).alias("metrics"),
        block(4, F.create_map(F.lit("area"), F.lit("1"))).alias("computed"), block(5, F.struct((k % 7 == 0).alias("is_placeholder"))).alias("methodology"),
        block(6, F.struct(F.struct(named("m", "k").alias("relpath")).alias("mask_geojson_ref"))).alias("computed_outputs"),
        F.when(k % 9 == 0, F.struct(F.struct(F.when(k % 2 == 0, "").otherwise("pass").alias("outcome")).alias("forest_area_crosscheck"))).alias("validation"),
    )


def _read_nested(get) -> DataFrame:
    rows = _nested(get)
    path = sources.scratch(rows.sparkSession)
    sources.write_reports(rows, path)
    return sources.read_reports(rows.sparkSession, path, whole=False)[0]


@query("v2_to_v10_nested_reports", f"WITH l AS ({_LINES}), loss AS (SELECT DISTINCT k FROM l WHERE k % 3 = 0 OR rf) SELECT concat('R', k) AS report_id, rule, detail FROM ({_BROKEN_SQL}) b WHERE detail IS NOT NULL")
def _(get):
    return V.integrity_errors(_read_nested(get))


@query("s8_report_values", f"WITH l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY 'p' || ln) - 1 AS i FROM (SELECT DISTINCT k, ln FROM ({_LINES}) x WHERE listed) y) SELECT concat('R', k) AS report_id, concat('/evidence_artifacts/', i, '/relpath') AS pointer, concat('p', ln) AS value FROM l UNION ALL SELECT DISTINCT concat('R', k), concat('/metrics/', '{V.LOSS_METRIC}', '/value'), '1.0' FROM ({_LINES}) x WHERE k % 3 = 0")
def _(get):
    return V.report_values(_read_nested(get), ["evidence_artifacts", "metrics"])


# --- regions and regridding -----------------------------------------------------------------------

_MASK = f"SELECT tile_id, prow, pcol, cast(prow AS bigint) * {R.WIDTH} + pcol AS id FROM pixels WHERE {OK} AND {FOREST} AND lossyear > 12"
_BESIDE = "a.tile_id = b.tile_id AND ((a.prow = b.prow AND abs(a.pcol - b.pcol) = 1) OR (a.pcol = b.pcol AND abs(a.prow - b.prow) = 1))"


@query("g10_mask_regions", f"WITH RECURSIVE m AS ({_MASK}), e AS (SELECT a.tile_id, a.id AS x, b.id AS y FROM m a JOIN m b ON a.tile_id = b.tile_id AND a.prow = b.prow AND b.pcol = a.pcol + 1 UNION ALL SELECT a.tile_id, a.id, b.id FROM m a JOIN m b ON a.tile_id = b.tile_id AND a.pcol = b.pcol AND b.prow = a.prow + 1), l AS (SELECT * FROM e UNION ALL SELECT tile_id, y, x FROM e), t AS (SELECT tile_id, id, id AS other FROM m UNION SELECT t.tile_id, t.id, l.y FROM t JOIN l ON t.tile_id = l.tile_id AND t.other = l.x), k AS (SELECT tile_id, id, min(other) AS region FROM t GROUP BY 1, 2), d AS (SELECT tile_id, x, count(*) AS n FROM l GROUP BY 1, 2) SELECT k.tile_id, k.region, cast(count(*) AS double) AS n_pixels, cast(sum(4 - coalesce(d.n, 0)) AS double) AS outline FROM k LEFT JOIN d ON k.tile_id = d.tile_id AND k.id = d.x GROUP BY 1, 2")
def _(get):
    mask = get("pixels").where(C.valid() & C.loss_after(T, CUTOFF))
    return R.mask_regions(mask).select("tile_id", "region", R.polygon_area(F.col("polygons")).alias("n_pixels"), R.polygon_outline(F.col("polygons")).alias("outline"))


_GRID_MASK = f"SELECT DISTINCT prow, pcol, cast(prow AS bigint) * {R.WIDTH} + pcol AS id FROM (SELECT cast((SELECT max(y0) FROM tiles) - t.y0 + p.prow AS int) AS prow, cast(t.x0 - (SELECT min(x0) FROM tiles) + p.pcol AS int) AS pcol FROM pixels p JOIN tiles t ON p.tile_id = t.tile_id WHERE {OK} AND {FOREST} AND lossyear > 12) g"


@query(
    "g10_regions_over_tiles",
    f"WITH RECURSIVE m AS ({_GRID_MASK}), e AS (SELECT a.id AS x, b.id AS y FROM m a JOIN m b ON a.prow = b.prow AND b.pcol = a.pcol + 1 UNION ALL SELECT a.id, b.id FROM m a JOIN m b ON a.pcol = b.pcol AND b.prow = a.prow + 1), l AS (SELECT * FROM e UNION ALL SELECT y, x FROM e), t AS (SELECT id, id AS other FROM m UNION SELECT t.id, l.y FROM t JOIN l ON t.other = l.x), k AS (SELECT id, min(other) AS region FROM t GROUP BY 1), d AS (SELECT x, count(*) AS n FROM l GROUP BY 1) SELECT k.region, cast(count(*) AS double) AS n_pixels, cast(sum(4 - coalesce(d.n, 0)) AS double) AS outline FROM k LEFT JOIN d ON k.id = d.x GROUP BY 1",
)
def _(get):
    mask = get("pixels").where(C.valid() & C.loss_after(T, CUTOFF))
    polygons = F.col("polygons")
    return R.regions_over_tiles(mask, get("tiles")).select("region", F.abs(R.polygon_area(polygons)).alias("n_pixels"), R.polygon_outline(polygons).alias("outline"))


_K0 = f"(cos(radians(30)) / sqrt(1 - {C.WGS84_E2} * 0.25))"
_SIZE = f"({C.WGS84_A} * {_K0} * radians({STEP}))"
_YOF = f"({C.WGS84_A} * {_Q} / (2 * {_K0}))"
_TOPY, _LOWY = _YOF % ((f"{Y0}",) * 4), _YOF % ((f"({Y0} - 200 * {STEP})",) * 4)


def _latitude(b: str) -> str:
    e = C.WGS84_E2
    return f"degrees({b} + {e / 3 + 31 * e**2 / 180 + 517 * e**3 / 5040:.18f}::double * sin(2 * {b}) + {23 * e**2 / 360 + 251 * e**3 / 3780:.18f}::double * sin(4 * {b}) + {761 * e**3 / 45360:.18f}::double * sin(6 * {b}))"


@query("g9_regrid", f"WITH b AS (SELECT i, asin(({_TOPY} - (i + 0.5) * {_SIZE}) * 2 * {_K0} / ({C.WGS84_A}e0 * {C.Q_POLE!r}e0)) AS beta FROM (SELECT unnest(range(cast(ceil(({_TOPY} - {_LOWY}) / {_SIZE}) AS bigint))) AS i) t), r AS (SELECT cast(i AS int) AS drow, cast(floor(({Y0} - {_latitude('beta')}) / {STEP}) AS int) AS prow FROM b) SELECT tile_id, drow, count(*) AS n, cast(sum(treecover) AS bigint) AS cover FROM pixels JOIN r USING (prow) GROUP BY 1, 2")
def _(get):
    return R.regrid(get("pixels"), 30.0, Y0, STEP, 200, 200).groupBy("tile_id", "drow").agg(F.count("*").alias("n"), F.sum("treecover").alias("cover"))


#: Eight tiles of two pixel sizes: six in degrees, one in metres of equal area, one without a grid.
_GRIDS = "SELECT tile_id, CASE WHEN k = 6 THEN 1000000e0 ELSE 10.3e0 + 7 * k END AS x0, CASE WHEN k = 6 THEN 4000000e0 ELSE 61.7e0 - 13 * k END AS y0, CASE WHEN k = 6 THEN 2500e0 WHEN k % 2 = 0 THEN 0.02e0 ELSE 0.05e0 END AS step, 200 AS width, 200 AS height, CASE WHEN k < 6 THEN 'EPSG:4326' WHEN k = 6 THEN 'EPSG:6933' END AS crs FROM (SELECT tile_id, cast(substr(tile_id, 2) AS int) AS k FROM tiles) t"


@query("g8_area_of_any_grid", f"SELECT g.tile_id, prow, round(CASE WHEN crs = 'EPSG:6933' THEN step * step ELSE {C.WGS84_A}e0 ^ 2 / 2 * radians(step) * abs({_Q % (('(y0 - prow * step)',) * 4)} - {_Q % (('(y0 - (prow + 1) * step)',) * 4)}) END, 1) AS area_m2 FROM (SELECT DISTINCT tile_id, prow FROM pixels) p JOIN ({_GRIDS}) g ON p.tile_id = g.tile_id")
def _(get):
    rows = get("pixels").select("tile_id", "prow").distinct().join(F.broadcast(_grids(get)), "tile_id")
    return rows.select("tile_id", "prow", F.round(R.pixel_area_m2(F.col("crs"), F.col("y0"), F.col("step")), 1).alias("area_m2"))


def _grids(get) -> DataFrame:
    tiles = get("tiles").withColumn("k", F.substring("tile_id", 2, 9).cast("int"))
    k, plane = F.col("k"), F.col("k") == 6
    return tiles.select(
        "tile_id", F.when(plane, 1000000.0).otherwise(10.3 + 7 * k).alias("x0"), F.when(plane, 4000000.0).otherwise(61.7 - 13 * k).alias("y0"),
        F.when(plane, 2500.0).when(k % 2 == 0, 0.02).otherwise(0.05).alias("step"), F.lit(200).alias("width"), F.lit(200).alias("height"), F.when(k < 6, R.DEGREES).when(plane, R.EQUAL_AREA).alias("crs"),
    )


_AK = f"({C.WGS84_A}e0 * {_K0})"
_MERCATOR_Y = f"({C.WGS84_A}e0 * ln(tan(pi() / 4 + radians(%s) / 2)))"
_BETA = f"asin((%s) * 2 * {_K0} / ({C.WGS84_A}e0 * {C.Q_POLE!r}e0))"
_SOURCE_LAT = f"CASE WHEN crs = 'EPSG:6933' THEN {_latitude('(' + _BETA + ')')} ELSE %s END"
_TARGET = f"""g AS (SELECT * FROM ({_GRIDS}) x),
e AS (SELECT *, {_SOURCE_LAT % (('y0',) * 5)} AS la, {_SOURCE_LAT % (('(y0 - height * step)',) * 5)} AS lb, CASE WHEN crs = 'EPSG:6933' THEN degrees(x0 / {_AK}) ELSE x0 END AS oa, CASE WHEN crs = 'EPSG:6933' THEN degrees((x0 + width * step) / {_AK}) ELSE x0 + width * step END AS ob FROM g WHERE crs IS NOT NULL),
f AS (SELECT *, CASE WHEN crs = 'EPSG:6933' THEN {_MERCATOR_Y % 'la'} ELSE {_YOF % (('la',) * 4)} END AS ya, CASE WHEN crs = 'EPSG:6933' THEN {_MERCATOR_Y % 'lb'} ELSE {_YOF % (('lb',) * 4)} END AS yb, CASE WHEN crs = 'EPSG:6933' THEN {C.WGS84_A}e0 ELSE {_AK} END AS k FROM e),
h AS (SELECT *, sqrt((k * radians(ob - oa)) ^ 2 + (ya - yb) ^ 2) / sqrt(width ^ 2 + height ^ 2) AS size FROM f),
r AS (SELECT *, ya - (i + 0.5) * size AS y FROM (SELECT *, unnest(range(cast(ceil((ya - yb) / size) AS bigint))) AS i FROM h) u),
rr AS (SELECT tile_id, cast(i AS int) AS drow, cast(floor(CASE WHEN crs = 'EPSG:6933' THEN (y0 - {_YOF % (('degrees(2 * atan(exp(y / ' + str(C.WGS84_A) + 'e0)) - pi() / 2)',) * 4)}) / step ELSE (y0 - {_latitude('(' + _BETA % 'y' + ')')}) / step END) AS int) AS prow FROM r),
c AS (SELECT *, degrees(radians(oa) + (i + 0.5) * size / k) AS lon FROM (SELECT *, unnest(range(cast(ceil(k * radians(ob - oa) / size) AS bigint))) AS i FROM h) u),
cc AS (SELECT tile_id, cast(i AS int) AS dcol, cast(floor(CASE WHEN crs = 'EPSG:6933' THEN ({_AK} * radians(lon) - x0) / step ELSE (lon - x0) / step END) AS int) AS pcol FROM c)"""


@query("g9_regrid_tiles", f"WITH {_TARGET} SELECT p.tile_id, drow, count(*) AS n, cast(sum(dcol) AS bigint) AS columns, cast(sum(treecover) AS bigint) AS cover FROM pixels p JOIN rr USING (tile_id, prow) JOIN cc USING (tile_id, pcol) GROUP BY 1, 2 UNION ALL SELECT tile_id, prow, count(*), cast(sum(pcol) AS bigint), cast(sum(treecover) AS bigint) FROM pixels JOIN g USING (tile_id) WHERE crs IS NULL GROUP BY 1, 2")
def _(get):
    out = R.regrid_tiles(get("pixels").drop("zone_id"), _grids(get))
    return out.groupBy("tile_id", "drow").agg(F.count("*").alias("n"), F.sum("dcol").alias("columns"), F.sum("treecover").alias("cover"))


# --- jobs that chain the operators ----------------------------------------------------------------

_ZONED = f"SELECT b.box_id AS zone_id, {', '.join(f'count(p.prow) FILTER (WHERE {OK} AND {w}) * {PIXEL_HA} AS {k}_ha' for k, w in _CASES.items())}, count(p.prow) FILTER (WHERE {OK} AND {FOREST}) AS n_reference, count(p.prow) FILTER (WHERE tree_valid = 0) AS n_tree_missing, (b.c1 - b.c0) * (b.r1 - b.r0) * {PIXEL_HA} AS aoi_ha FROM boxes b LEFT JOIN {_PLACED} p ON {_IN} GROUP BY b.box_id, b.c0, b.c1, b.r0, b.r1"
_REACHED = "SELECT b.box_id AS zone_id, string_agg(t.tile_id, '|' ORDER BY t.tile_id) AS tile_ids FROM boxes b JOIN tiles t ON b.c0 < t.x0 + 200 AND b.c1 > t.x0 AND b.r0 < t.y0 AND b.r1 > t.y0 - 200 GROUP BY 1"


@query("q1_aoi_evidence", f"SELECT z.zone_id, round(aoi_ha, 4) AS aoi_ha, {', '.join(f'round({k}_ha, 4) AS {k}_ha' for k in _CASES)}, n_reference, n_tree_missing, tile_ids, round(loss_after_ha / aoi_ha * 100, 4) AS loss_pct_of_aoi, CASE WHEN loss_after_ha <= 0 THEN 'pass' ELSE 'fail' END AS status FROM ({_ZONED}) z LEFT JOIN ({_REACHED}) r ON z.zone_id = r.zone_id")
def _(get):
    zones = _zones(get)
    areas = zones.select("zone_id", (R.polygon_area(F.col("polygons")) * PIXEL_HA).alias("aoi_ha"))
    out = jobs.aoi_evidence(zones, get("pixels").drop("zone_id"), get("tiles"), areas, T, CUTOFF, END, F.lit(PIXEL_HA * 10000))
    return out.select("zone_id", "n_reference", "n_tree_missing", "tile_ids", "status", *[r4(c) for c in ("aoi_ha", *[f"{k}_ha" for k in _CASES], "loss_pct_of_aoi")])


def _parcels(get) -> DataFrame:
    stats = get("parcels").where("pos % 2 = 0").select("parcel_id", (F.col("geodesic_area_ha") * 0.9).alias("raster_land_ha"), (F.col("geodesic_area_ha") * 0.4).alias("raster_forest_ha"), F.lit(0.0).alias("raster_loss_ha"))
    return jobs.parcels(_forest(get).drop("land_ha", "forest_ha", "key_used", "reference_source", "method"), _label(), stats)


_STATS = f"(SELECT *, {_LABEL} AS designation, CASE WHEN pos % 2 = 0 THEN geodesic_area_ha * 0.9 END AS raster_land_ha, CASE WHEN pos % 2 = 0 THEN geodesic_area_ha * 0.4 END AS raster_forest_ha FROM {_F} f)"


@query("q2_parcels", f"SELECT aoi_id, parcel_id, designation, round(land_ha, 4) AS land_ha, round(forest_ha, 4) AS forest_ha, round(raster_forest_ha, 4) AS raster_forest_ha, key_used, method, row_number() OVER (PARTITION BY aoi_id ORDER BY coalesce(raster_forest_ha, forest_ha, 0) DESC, CASE WHEN pindala > 0 THEN pindala ELSE coalesce(geodesic_area_ha, 0) * 10000 END DESC, parcel_id) <= 10 AS top FROM {_STATS} s")
def _(get):
    return _parcels(get).select("aoi_id", "parcel_id", "designation", r4("land_ha"), r4("forest_ha"), r4("raster_forest_ha"), "key_used", "method", "top")


@query("q2_parcel_summary", f"SELECT aoi_id, count(*) AS parcel_count, count(DISTINCT designation) AS n_designations, concat('forest_area_key_used:', string_agg(DISTINCT coalesce(key_used, 'geometry'), '|' ORDER BY coalesce(key_used, 'geometry'))) AS summary, round(sum(raster_land_ha) - sum(land_ha), 2) AS diff_ha FROM {_STATS} s GROUP BY 1")
def _(get):
    out = jobs.parcel_summary(_parcels(get))
    return out.select("aoi_id", "parcel_count", F.size("designation_counts").cast("bigint").alias("n_designations"), "summary", F.round("diff_ha", 2).alias("diff_ha"))


@query("q3_crosscheck", f"SELECT p.aoi_id, p.parcel_id, round(p.forest_ha, 4) AS forest_ha, round(t.computed, 4) AS computed_ha, CASE WHEN p.forest_ha > 0 THEN 'comparable' ELSE 'not_comparable' END AS outcome, CASE WHEN abs(t.computed - t.r) / t.r <= 0.05 THEN 'pass' ELSE 'fail' END AS total_outcome, t.source AS total_reference_source FROM {_F} p JOIN (SELECT aoi_id, sum(forest_ha) AS r, sum(land_ha) * 0.5 AS computed, CASE WHEN min(reference_source) = max(reference_source) THEN min(reference_source) ELSE 'mixed' END AS source FROM {_F} g GROUP BY 1) t ON p.aoi_id = t.aoi_id")
def _(get):
    own = _forest(get)
    computed = own.groupBy("aoi_id").agg((F.sum("land_ha") * 0.5).alias("computed_ha"))
    return jobs.crosscheck(own, computed).select("aoi_id", "parcel_id", r4("forest_ha"), r4("computed_ha"), "outcome", "total_outcome", "total_reference_source")


@query("q4_reports", f"SELECT zone_id AS aoi_id, 'report::' || zone_id AS report_id, {len(_CASES) + 1} AS n_metrics, round(loss_after_ha, 4) AS loss_after_ha, CASE WHEN loss_after_ha <= 60 THEN 'pass' ELSE 'fail' END AS outcome, CASE WHEN zone_id = 'A1' THEN 'mask=missing|summary=present' ELSE 'mask=present|summary=present' END AS classes, CASE WHEN zone_id = 'A1' THEN 'inspectable_only' ELSE 'assessable' END AS assessment_capability, (SELECT count(DISTINCT p_brand) FROM part) AS n_mapped FROM ({_METRICS}) m")
def _(get):
    status = P.loss_status(_metrics(get), F.lit(10000.0), F.col("loss_after_ha"), 60.0).withColumnRenamed("zone_id", "aoi_id")
    ids = status.select("aoi_id")
    artifacts = ids.select("aoi_id", F.lit("summary").alias("class_id"), F.concat("aoi_id", F.lit("/summary.json")).alias("relpath"))
    artifacts = artifacts.union(ids.where("aoi_id <> 'A1'").select("aoi_id", F.lit("mask"), F.concat("aoi_id", F.lit("/mask.geojson"))))
    declared = status.sparkSession.createDataFrame([("mask",), ("summary",)], "class_id string")
    out = jobs.reports(status, artifacts, E.policy_refs(get("part").select(F.col("p_brand").alias("ref")), get("part").select(F.concat(F.lit("#"), "p_type").alias("ref"))), "report", classes=declared)
    classes = F.array_join(F.transform("evidence_registry.evidence_classes", lambda c: F.concat(c["class_id"], F.lit("="), c["status"])), "|")
    return out.select("aoi_id", "report_id", F.size("metrics").alias("n_metrics"), F.round(F.col("metrics")["loss_after_ha"]["value"], 4).alias("loss_after_ha"), F.col("results")[0]["outcome"].alias("outcome"), classes.alias("classes"), "report_metadata.assessment_capability", F.size("policy_mapping").cast("bigint").alias("n_mapped"))


_RULED = " UNION ALL ".join(f"SELECT 'run::' || z.zone_id AS report_id, {v}" for v in [
    "'sha256' AS rule, 'evidence_artifacts[].sha256' AS detail FROM z WHERE zone_id = 'A0'",
    "'tile_without_source', t.tile_id FROM z JOIN tiles t ON z.zone_id = 'A2' AND t.tile_id >= 'T4'",
    "'missing_dependency', 'hansen_gfc_2024_v1_12' FROM z WHERE zone_id = 'A3'",
    "'unknown_result', 'gone' FROM z",
    "'min_length', 'policy_mapping[].article_ref' FROM z WHERE EXISTS (SELECT 1 FROM part WHERE p_size = 50)",
    "'min_length', 'policy_mapping[].requirement' FROM z WHERE EXISTS (SELECT 1 FROM part WHERE p_size = 50)",
])


@query("q4_report_rules", f"WITH z AS (SELECT DISTINCT zone_id FROM pixels) {_RULED}")
def _(get):
    # zones without a valid pixel have a report, too
    metrics = get("pixels").select("zone_id").distinct().join(_metrics(get), "zone_id", "left").fillna(0.0)
    status = P.loss_status(metrics, F.lit(10000.0), F.col("loss_after_ha"), 60.0).withColumnRenamed("zone_id", "aoi_id").withColumn("aoi_ha", F.lit(900.0))
    one = lambda c, path: status.select("aoi_id", F.lit(c).alias("class_id"), F.concat("aoi_id", F.lit(path)).alias("relpath"))
    artifacts = one("summary", "/summary.json").union(one(V.LOSS, "/mask.geojson"))
    artifacts = artifacts.withColumn("sha256", F.when(F.col("aoi_id") == "A0", "none").otherwise(F.sha2("relpath", 256))).withColumn("size_bytes", F.lit(10).cast("bigint"))
    spark = status.sparkSession
    criteria = spark.createDataFrame([("loss", "loss after the cutoff", V.LOSS, "loss_after_ha", 60.0), ("cover", "cover at the start", "summary", "reference_ha", 1e9)], "criteria_id string, description string, class_id string, metric string, most double")
    assumptions = spark.createDataFrame([("tiles", False, "loss"), ("tiles", False, "gone"), ("grid", True, "cover")], "assumption_id string, testable boolean, result_id string")
    datasets = get("catalogue").select("dataset_id", F.lit("2024-01-01").alias("retrieved_at_utc"), F.lit("free").alias("license"))
    dependency = F.when(F.col("aoi_id") == "A3", "other").otherwise(V.WANTED).alias("dependency_id")
    source = F.when((F.col("aoi_id") == "A2") & (F.col("tile_id") >= "T4"), " ").otherwise(F.concat(F.lit("https://example.org/"), "tile_id")).alias("source_url")
    tiles = status.select("aoi_id").join(F.broadcast(get("tiles").select("tile_id"))).select("aoi_id", dependency, F.lit("local").alias("tile_source"), "tile_id", source)
    refs = get("part").select(F.when(F.col("p_size") == 50, "").otherwise(F.col("p_brand")).alias("ref"))
    return V.all_errors(jobs.reports(status, artifacts, refs, "run", criteria=criteria, assumptions=assumptions, datasets=datasets, tiles=tiles))


@query("q5_plot_reports", "SELECT concat('run::', box_id) AS report_id, box_id AS plot_id, round((c0 + c1) / 200.0, 8) AS lon, round((r0 + r1) / 200.0, 8) AS lat, 1 AS n_polygons, CASE WHEN r0 % 2 = 0 THEN aoi_id ELSE 'N/A' END AS operator, CASE WHEN r0 % 2 = 0 AND c0 % 3 = 0 THEN 'Yes' WHEN r0 % 2 = 0 AND c0 % 3 = 1 THEN 'No' ELSE 'N/A' END AS deforestation_detected FROM boxes")
def _(get):
    boxes = get("boxes")
    props = F.create_map(F.lit("operator"), F.col("aoi_id"), F.lit("blank"), F.lit(" "))
    merged = P.merge_properties(boxes.where("r0 % 2 = 0").select(F.col("box_id").alias("doc"), F.lit(1).alias("pos"), props.alias("properties")))
    facts = merged.where("key = 'operator'").select(F.col("doc").alias("plot_id"), F.col("value").alias("prop_operator"))
    loss = boxes.select(F.col("box_id").alias("plot_id"), F.when(F.col("c0") % 3 == 0, 2.5).when(F.col("c0") % 3 == 1, 0.0).alias("metric_loss_ha"))
    out = jobs.plot_reports(_zones(get, 0.01), facts.join(loss, "plot_id"), "run")
    return out.select("report_id", "plot_id", "lon", "lat", "n_polygons", "operator", "deforestation_detected")


@query("q6_publish", f"WITH l AS (SELECT * FROM {_LATEST} t WHERE k <= 2), s AS (SELECT site_id, count(*) = 2 AND count(*) FILTER (WHERE has_report = 0 OR run_name LIKE '%7') = 0 AS ok FROM l GROUP BY 1) SELECT l.site_id, l.run_name, cast(l.k AS int) AS rank, cast(1 + has_report AS bigint) AS n_files, s.ok FROM l JOIN s ON l.site_id = s.site_id")
def _(get):
    return jobs.publish(get("runs"), *_files(get), 2).select("site_id", "run_name", "rank", "n_files", "ok")


_RUN_FILES = "SELECT site_id, concat('run_', cast(cast(o_orderdate AS date) AS string), '_', cast(o_orderkey AS int)) AS run_name, concat('maps/', cast(l_linenumber AS int), '/', CASE WHEN l_linenumber = 6 THEN '.env' WHEN l_linenumber % 2 = 0 THEN 'tile.json' ELSE 'mask.geojson' END) AS relpath, cast(l_partkey AS bigint) AS size_bytes, cast(l_linenumber AS int) AS ln, cast(o_orderkey AS int) AS k FROM (SELECT *, concat('site', cast(o_custkey % 10 AS int)) AS site_id FROM orders) o JOIN (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2) l ON o_orderkey = l_orderkey"
_PUBLISHED = "k % 3 <> 0 AND (k % 3 <> 1 OR ln <> 1)"


def _run_files(get) -> tuple[DataFrame, DataFrame]:
    """A file for each line of a run; of the runs, a third isn't published, in another the first line's file lacks and
    the second's differs. What inventories leave out always differs."""
    files = S.cut_lineage(get(_RUN_FILES))  # both sides are made of them, and read more than once
    named = files.select("site_id", "run_name", "relpath", "size_bytes", "ln", "k")
    sha = lambda extra: F.sha2(F.concat("relpath", extra), 256).alias("sha256")
    keys = ["site_id", "run_name", "relpath", "size_bytes"]
    other = F.when((F.col("ln") == 6) | ((F.col("k") % 3 == 1) & (F.col("ln") == 2)), "old").otherwise("")
    return named.select(*keys, sha(F.lit(""))), named.where(_PUBLISHED).select(*keys, sha(other))


_KEPT_FILES = f"(SELECT f.*, k3.rank, k3.bundle_date FROM ({_RUN_FILES}) f JOIN (SELECT site_id, run_name, bundle_date, cast(k AS int) AS rank FROM {_LATEST} t WHERE k <= 2) k3 USING (site_id, run_name) WHERE ln <> 6)"


@query("q6_bundle_index", f"SELECT site_id, run_name, rank, count(*) AS n_files, cast(sum(size_bytes) AS bigint) AS size_bytes, CASE WHEN count(*) FILTER (WHERE {_PUBLISHED}) = 0 THEN 'added' WHEN count(*) FILTER (WHERE k % 3 = 1 AND ln <= 2) = 0 THEN 'same' ELSE 'changed' END AS state, CASE WHEN count(*) FILTER (WHERE {_PUBLISHED}) > 0 THEN count(*) FILTER (WHERE k % 3 = 1 AND ln <= 2) ELSE 0 END AS n_changes FROM {_KEPT_FILES} f GROUP BY 1, 2, 3")
def _(get):
    index, _, _ = jobs.publish_changes(get("runs"), *_run_files(get))
    return index.where("n_files > 0").select("site_id", "run_name", "rank", "n_files", "size_bytes", "state", "n_changes")


@query("q6_bundle_changes", f"SELECT site_id, run_name, relpath, CASE WHEN ln = 1 THEN 'added' ELSE 'changed' END AS state FROM {_KEPT_FILES} f WHERE k % 3 = 1 AND ln <= 2 AND EXISTS (SELECT 1 FROM {_KEPT_FILES} o WHERE o.k = f.k AND o.ln <> 1) UNION ALL SELECT site_id, run_name, relpath, 'to_go' FROM ({_RUN_FILES}) f WHERE ln <> 6 AND {_PUBLISHED} AND k NOT IN (SELECT k FROM {_KEPT_FILES} o)")
def _(get):
    _, changes, old = jobs.publish_changes(get("runs"), *_run_files(get))
    return changes.union(old.withColumn("state", F.lit("to_go")))


@query("q7_catalogue", "SELECT c.dataset_id, c.name, f.family, f.family IS NOT NULL AS has_family FROM catalogue c LEFT JOIN families f ON c.dataset_id = f.dataset_id")
def _(get):
    spark, paths = get("catalogue").sparkSession, []
    for name in ("catalogue", "families"):
        paths.append(sources.scratch(spark))
        get(name).write.option("header", True).csv(paths[-1])
    out = jobs.catalogue(*[sources.read_seed_csv(spark, p) for p in paths])
    where = sources.scratch(spark)
    sources.export_catalogue(out, where)
    return sources.read_seed_csv(spark, where).withColumn("has_family", F.col("has_family").cast("boolean"))


_BEST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY score DESC, probe) AS k FROM (SELECT *, split_part(dependency_id, '/', 1) AS family, {_SCORE} AS score FROM links) s WHERE score > 1.0) t WHERE k = 1)"


@query("q8_link_review", f"SELECT dependency_id, url, discovery_method, (SELECT count(*) FROM links) AS checked, (SELECT count(*) FROM links WHERE NOT coalesce(http_status BETWEEN 200 AND 399, false)) AS broken FROM (SELECT dependency_id, url, 'probe' AS discovery_method FROM {_BEST} b UNION SELECT dependency_id, url, 'probe' FROM links WHERE dependency_id LIKE 'fam1/%') h")
def _(get):
    links = get("links")
    known = links.where("dependency_id like 'fam1/%'").select("dependency_id", "url", F.lit("tool").alias("discovered_by"), F.lit("probe").alias("discovery_method"))
    registry, history, summary = jobs.link_review(links, known, 1.0)
    return history.join(registry.select("dependency_id").distinct(), "dependency_id", "left_semi").select("dependency_id", "url", "discovery_method").crossJoin(F.broadcast(summary))
