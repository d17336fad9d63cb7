"""Known answers and invariants."""

import math
import random

import pytest

from pyspark.sql import functions as F

from forest_evidence import sources
from forest_evidence.functions import columns as C
from forest_evidence.operators import evidence as E
from forest_evidence.operators import parcels as P
from forest_evidence.operators import regions as R
from forest_evidence.operators import spatial as S
from forest_evidence.operators import zonal as Z


def test_two_by_two_raster(spark):
    rows = [("t", 0, 0, "z", 0, 0, 1, 1), ("t", 0, 1, "z", 50, 21, 1, 1), ("t", 1, 0, "z", 60, 0, 1, 1), ("t", 1, 1, "z", 20, 0, 1, 1)]
    px = spark.createDataFrame(rows, "tile_id string, prow int, pcol int, zone_id string, treecover int, lossyear int, tree_valid int, loss_valid int")
    m = Z.forest_metrics(px, 30, 2020, 2024, F.lit(10000.0)).first()
    assert (m.reference_ha, m.loss_after_ha, m.never_lost_ha, m.loss_pct) == (2, 1, 1, 50)
    assert m.reference_ha == m.never_lost_ha + m.loss_total_ha


def polygon(spark, *rings):
    return spark.createDataFrame([("p", [[[(float(x), float(y)) for x, y in r] for r in rings]])], f"zone_id string, polygons {S.POLYGONS}")


def inside(x, y, rings):
    hit = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                hit = not hit
    return hit


def test_zone_spans_with_hole_equal_brute_force(spark):
    rings = [[(1.2, 1), (30.7, 4.4), (25, 20.1), (12, 9.5), (3, 28)], [(10, 5.5), (14, 6), (12.5, 8)]]
    got = {(r.prow, c) for r in S.zone_spans(polygon(spark, *rings)).collect() for c in range(r.c0, r.c1 + 1)}
    assert got == {(r, c) for r in range(40) for c in range(40) if inside(c + 0.5, r + 0.5, rings)}


def test_geodesic_area_of_a_box(spark):
    box = polygon(spark, [(0, 0), (1, 0), (1, 1), (0, 1)])
    assert math.isclose(S.geodesic_area_ha(box).first().area_ha, 1230877.8, rel_tol=2e-4)
    assert math.isclose(S.approx_area_ha(box).first().area_ha, 110574 * 111320 * math.cos(math.radians(0.5)) / 1e4, rel_tol=1e-9)


def test_tile_names(spark):
    boxes = spark.createDataFrame([("a", 24.1, 58.6, 24.2, 58.7), ("b", 20.0, 50.0, 31.0, 61.0)], "id string, x0 double, y0 double, x1 double, y1 double")
    got = {(r.id, r.tile_id) for r in S.tiles_of_boxes(boxes).collect()}
    assert got == {("a", "N60_E020"), ("b", "N60_E020"), ("b", "N60_E030"), ("b", "N70_E020"), ("b", "N70_E030")}


def test_covered_by_rejects_a_crossing(spark):
    outer = polygon(spark, [(0, 0), (10, 0), (10, 10), (5, 3), (0, 10)])
    inner = polygon(spark, [(1, 1), (9, 1), (9, 7), (1, 7)])
    small = polygon(spark, [(1, 1), (2, 1), (2, 2), (1, 2)])
    assert S.covered_by(inner, outer, 4.0).count() == 0
    assert S.covered_by(small, outer, 4.0).count() == 1
    assert S.covered_by(outer, outer, 4.0).count() == 1


def test_parcel_rules(spark):
    rows = [("a", "x", 100000.0, 20000.0, None, None, 5.0), ("b", "x", 886903.0, None, None, None, 90.0), ("c", "x", None, None, 30000.0, None, 4.0)]
    df = spark.createDataFrame(rows, "parcel_id string, aoi_id string, pindala double, mets double, mets_ha double, forest_area_ha double, geodesic_area_ha double")
    got = {r.parcel_id: (r.forest_ha, r.method) for r in P.with_forest_area(df).collect()}
    assert got == {"a": (2.0, "reported_m2"), "b": (88.6903, "capped_to_land_area"), "c": (3.0, "reported_m2_inferred")}
    assert P.top_parcels(P.with_forest_area(df.limit(0))).count() == 0


def test_crosscheck(spark):
    df = spark.createDataFrame([("p", 10.0, 10.0), ("f", 10.0, 20.0), ("n", None, 10.0), ("z", 0.0, 1.0)], "parcel_id string, forest_ha double, c double")
    got = {r.parcel_id: r.outcome for r in P.crosscheck_rows(df, F.col("c")).collect()}
    assert got == {"p": "comparable", "f": "comparable", "n": "not_comparable", "z": "not_comparable"}
    rows = {r.parcel_id: (r.diff_pct, r.reason) for r in P.crosscheck_rows(df, F.col("c")).collect()}
    assert rows == {"p": (0.0, None), "f": (100.0, None), "n": (None, "missing_reference_forest_area"), "z": (None, None)}
    total = P.crosscheck_total(df.withColumn("aoi_id", F.lit("A")), F.max("c")).first()
    assert (total.reference_ha, total.outcome, total.reason) == (20.0, "pass", None)


def test_numbers_and_timestamps(spark):
    df = spark.createDataFrame([("1_000",), ("5d",), (" 2.5 ",), ("1e3",), ("",)], "t string")
    assert [r[0] for r in df.select(C.number(F.col("t"))).collect()] == [None, None, 2.5, 1000.0, None]
    names = spark.createDataFrame([("run_20240102T030405Z",), ("2024-01-02",), ("none",), ("r-20240102-030405",)], "t string")
    assert [str(r[0]) for r in names.select(C.run_timestamp(F.col("t")).cast("string")).collect()] == ["2024-01-02 03:04:05", "2024-01-02 00:00:00", "1970-01-01 00:00:00", "2024-01-02 03:04:05"]


def test_history_twice_is_once_and_diff_of_itself_is_empty(spark):
    new = spark.createDataFrame([("d", "u", "t", "m"), ("d", "u", "t", "m")], "dependency_id string, url string, discovered_by string, discovery_method string")
    once = E.append_history(new.limit(0), new)
    assert once.count() == 1 and E.append_history(once, new).count() == 1
    a = spark.createDataFrame([("x", "1")], "relpath string, sha256 string")
    assert E.diff_signatures(a, a, ["relpath"]).count() == 0


def test_features_from_geojson(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"k":"v"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}}]}')
    zones = sources.zones_of_features(sources.read_features(spark, str(tmp_path)))
    assert math.isclose(S.geodesic_area_ha(zones).first().area_ha, 1230877.8, rel_tol=2e-4)
    assert sources.file_inventory(spark, str(tmp_path)).first().relpath == "a.json"


def test_evidence_overwrites_just_its_bundles(spark, tmp_path):
    rows = lambda b, v: spark.createDataFrame([("2024-01-01", b, "p", v)], "bundle_date string, bundle_id string, relpath string, v int").withColumn("bundle_date", F.col("bundle_date").cast("date"))
    for b, v in (("a", 1), ("b", 1), ("a", 2)):
        sources.write_evidence(rows(b, v), str(tmp_path / "e"))
    got = sources.read_evidence(spark, str(tmp_path / "e"), "2024-01-01", "2024-01-02")
    assert [(r.bundle_id, r.v) for r in got.collect()] == [("a", 2), ("b", 1)]


def test_regions_equal_flood_fill(spark):
    rng = random.Random(3)
    cells = {(t, r, c) for t in "ab" for r in range(12) for c in range(12) if rng.random() < 0.6}
    df = spark.createDataFrame(sorted(cells) + sorted(cells)[:5], "tile_id string, prow int, pcol int")
    polygons = F.col("polygons")
    got = {(x.tile_id, x.region): (x.a, x.o) for x in R.mask_regions(df).select("tile_id", "region", R.polygon_area(polygons).alias("a"), R.polygon_outline(polygons).alias("o")).collect()}
    beside = lambda t, r, c: ((t, r + 1, c), (t, r - 1, c), (t, r, c + 1), (t, r, c - 1))
    want, todo = {}, set(cells)
    while todo:
        stack, own = [todo.pop()], set()
        while stack:
            own.add(cell := stack.pop())
            stack += [n for n in beside(*cell) if n in todo]
            todo.difference_update(stack)
        t, r, c = min(own)
        want[t, r * R.WIDTH + c] = (float(len(own)), float(sum(n not in own for cell in own for n in beside(*cell))))
    assert got == want


def test_rings_equal_traced_ones(spark):
    """Random cells over four tiles, by tile and joined over the seams: the same rings as tracing them one by one."""
    rng = random.Random(21)
    cells = {(x, y) for x in range(24) for y in range(20) if rng.random() < 0.6} | {(x, 10) for x in range(24)}
    tile = lambda x, y: f"{x // 12}{y // 10}"
    df = spark.createDataFrame([(tile(x, y), y % 10, x % 12) for x, y in cells] * 2, "tile_id string, prow int, pcol int")
    tiles = spark.createDataFrame([(f"{a}{b}", 5.0 + 6 * a, 40.0 - 5 * b, 0.5) for a in range(2) for b in range(2)], "tile_id string, x0 double, y0 double, step double")

    def turned(ring):
        k = ring.index(min(ring, key=lambda v: (v[1], v[0])))
        return tuple(ring[k:] + ring[:k])

    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1]))
    whole = sorted(tuple(sorted((turned(r) for r in p), key=lambda r: (-area(r), r))) for p in traced(cells))
    got = []
    for r in R.regions_over_tiles(df, tiles).collect():
        (rings,) = r.polygons
        own = [[((v.x - 5) / 0.5, (40 - v.y) / 0.5) for v in ring] for ring in rings]
        assert all(o[0] == o[-1] for o in own) and area(own[0]) > 0 and all(area(o) < 0 for o in own[1:])
        got.append(tuple(sorted((tuple(o[:-1]) for o in own), key=lambda r: (-area(list(r)), r))))
    assert sorted(got) == whole
    parts = {t: {(x % 12, y % 10) for x, y in cells if tile(x, y) == t} for t in ("00", "01", "10", "11")}
    by_tile = sorted((t, tuple(sorted((turned(r) for r in p), key=lambda r: (-area(r), r)))) for t, own in parts.items() for p in traced(own))
    found = R.mask_regions(df)
    assert sorted((r.tile_id, tuple(sorted((tuple((v.x, v.y) for v in ring[:-1]) for ring in r.polygons[0]), key=lambda r: (-area(list(r)), r)))) for r in found.collect()) == by_tile
    plan = found._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_no_pixels_make_no_regions(spark):
    assert R.mask_regions(spark.createDataFrame([], "tile_id string, prow int, pcol int")).count() == 0


def test_regridding_keeps_area(spark):
    # each cell of the new grid has the same area, so their number follows the ground's area
    rows, columns = R.equal_area_maps(spark.range(1), 20.0, 60.0, 0.01, 100, 100)
    cells = rows.count() * columns.count()
    truth = spark.range(100).select(F.sum(C.cell_area_m2(60 - F.col("id") * 0.01, 60 - (F.col("id") + 1) * 0.01, F.lit(0.01))) * 100).first()[0]
    size = C.WGS84_A * math.cos(math.radians(30)) / math.sqrt(1 - C.WGS84_E2 * 0.25) * math.radians(0.01)
    assert abs(cells * size**2 / truth - 1) < 0.02


def test_a_zone_meets_only_its_own_tile(spark):
    tiles = spark.createDataFrame([("N60_E020", 20.0, 60.0, 0.1, 100, 100), ("S10_W070", -70.0, -10.0, 0.1, 100, 100)], "tile_id string, x0 double, y0 double, step double, width int, height int")
    pixels = spark.range(2 * 100 * 100).select(F.when(F.col("id") < 10000, "N60_E020").otherwise("S10_W070").alias("tile_id"), (F.col("id") % 10000 / 100).cast("int").alias("prow"), (F.col("id") % 100).cast("int").alias("pcol"))
    box = spark.createDataFrame([("z", 20.0, 59.8, 20.2, 60.0)], "id string, x0 double, y0 double, x1 double, y1 double")
    zones = S.boxes_to_zones(box, "id", F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    got = {(r.tile_id, r.prow, r.pcol) for r in S.zone_pixels(zones, pixels, tiles).collect()}
    assert got == {("N60_E020", r, c) for r in (0, 1) for c in (0, 1)}
    far = S.boxes_to_zones(box, "id", F.lit(100.0), F.lit(0.0), F.lit(101.0), F.lit(1.0))
    assert S.zone_pixels(far, pixels, tiles).count() == 0


def test_zone_pixels_read_only_what_they_need(spark, tmp_path):
    tiles = spark.createDataFrame([(f"T{k}", 10.0 * k, 10.0, 1.0, 10, 10) for k in range(4)], "tile_id string, x0 double, y0 double, step double, width int, height int")
    pixels = spark.range(400).select(F.concat(F.lit("T"), (F.col("id") / 100).cast("int")).alias("tile_id"), (F.col("id") % 100 / 10).cast("int").alias("prow"), (F.col("id") % 10).cast("int").alias("pcol"))
    pixels.write.partitionBy("tile_id").parquet(str(tmp_path / "p"))
    box = spark.createDataFrame([("z",)], "id string")
    zones = S.boxes_to_zones(box, "id", F.lit(18.0), F.lit(2.0), F.lit(22.0), F.lit(4.0))
    out = S.zone_pixels(zones, sources.read_pixels(spark, str(tmp_path / "p")), tiles)
    plan = out._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "tile_id" in plan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(prow" in plan
    assert {(r.tile_id, r.prow, r.pcol) for r in out.collect()} == {(t, r, c) for t, cs in (("T1", (8, 9)), ("T2", (0, 1))) for c in cs for r in (6, 7)}


def test_tile_pairs(spark):
    paths = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    pairs = lambda a, b: {tuple(r) for r in S.pair_tiles(a, b).collect()}
    assert pairs(paths("/a/cover.tif"), paths("/b/loss.tif")) == {("/a/cover.tif", "/b/loss.tif")}
    assert pairs(paths("/c/1.tif", "/c/2.tif"), paths("/l/2.tif", "/l/1.tif", "/l/3.tif")) == {("/c/1.tif", "/l/1.tif"), ("/c/2.tif", "/l/2.tif")}
    assert pairs(paths("/N1/c.tif", "/N2/c.tif"), paths("/x/N2/l.tif", "/x/N1/l.tif")) == {("/N1/c.tif", "/x/N1/l.tif"), ("/N2/c.tif", "/x/N2/l.tif")}
    with pytest.raises(Exception, match="no loss tile"):
        pairs(paths("/c/1.tif", "/c/2.tif"), paths("/l/2.tif", "/l/3.tif"))


def test_path_rules(spark):
    df = spark.createDataFrame([("audit/x",), ("outputs/x",), ("keys.yml",), ("A.PYC",), (".envrc",), ("node_modules/x",), (".env.a",)], "relpath string")
    assert {r.relpath for r in E.exclude_paths(df).collect()} == {".envrc", "node_modules/x"}
    at = spark.createDataFrame([("reports/de/1.json", "reports/en"), ("reports/en/1.json", "reports/en"), ("a.json", ""), ("x/en", "x/en"), ("y/a.json", "x/en")], "p string, b string")
    assert [r[0] for r in at.select(E.relative_path(F.col("p"), F.col("b"))).collect()] == ["../de/1.json", "1.json", "a.json", "../en", "../../y/a.json"]
    url = spark.createDataFrame([("https://x/2023/v1.2/2023-v1.2",), ("v3/x",), ("plain",)], "u string")
    got = [[tuple(c) for c in r[0]] for r in url.select(C.link_candidates(F.col("u"))).collect()]
    assert got == [[("https://x/2024/v1.2/2023-v1.2", "year_bump_probe"), ("https://x/2023/v1.3/2023-v1.2", "version_probe")], [], []]
    names = spark.createDataFrame([("pindala",), ("forest_ha_total",), ("omanik",), ("metsaha",)], "n string")
    assert [tuple(r) for r in names.select(C.is_forest_field(F.col("n")), C.is_forest_ha_field(F.col("n"))).collect()] == [(True, False), (True, True), (False, False), (True, True)]


def test_declared_artifacts(spark):
    html = '<a href="no">x</a><dl>GENERATED (UTC)\n<dd><code> 2026-02-20T00:00:00Z\n</code></dl><h2>Map</h2><ul><a href="no">x</a></ul><h2 class="c">Declared evidence artifacts</h2><p><a href=" a.json ">a</a><ul><li><a class=c href=\'b/c.csv\'>b</a><li><a href="a.json">a</a><a href="">none</a></ul><a href="no">x</a>'
    pages = spark.createDataFrame([(1, html), (2, "<h2>Artifacts</h2><ul></ul>"), (3, None), (4, "<h2>Artifacts</h2><ul><a href=x>x</a><a href='y'>y</a></ul>")], "page_id int, html string")
    got = sorted((r.page_id, r.pos, r.href, r.generated_utc) for r in E.declared_artifacts(pages).collect())
    assert got == [(1, 0, "a.json", "2026-02-20T00:00:00Z"), (1, 1, "b/c.csv", "2026-02-20T00:00:00Z"), (4, 0, "x", None), (4, 1, "y", None)]


def traced(cells):
    """Polygons (outer ring first) of a set of unit cells, the cells on the right hand, turning right in corners."""
    ahead = {}
    for x, y in cells:
        for (ax, ay), (bx, by), beside in (((x, y), (x + 1, y), (x, y - 1)), ((x + 1, y), (x + 1, y + 1), (x + 1, y)), ((x + 1, y + 1), (x, y + 1), (x, y + 1)), ((x, y + 1), (x, y), (x - 1, y))):
            if beside not in cells:
                ahead.setdefault((ax, ay), []).append((bx, by))
    rings = []
    while ahead:
        at = start = min(ahead)
        ring, step = [], None
        while True:
            ways = ahead[at]
            right = (at[0] - step[1], at[1] + step[0]) if step else None
            to = right if right in ways else ways[0]
            ways.remove(to)
            if not ways:
                del ahead[at]
            new = (to[0] - at[0], to[1] - at[1])
            if new != step:
                ring.append(at)
            at, step = to, new
            if at == start:
                break
        rings.append(ring)
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1]))
    outer, holes = [r for r in rings if area(r) > 0], [r for r in rings if area(r) < 0]
    polygons = [[r] for r in outer]
    for h in holes:
        x, y = min(h)  # the least corner has a hole's cell below right of it and a cell of the zone to its left
        least = min((p for p in polygons if inside(x - 0.5, y + 0.5, [p[0]])), key=lambda p: area(p[0]))
        least.append(h)
    return polygons


def test_covered_by_equals_brute_force_on_cells(spark):
    """Random sets of cells, concave, with holes, in parts, sharing edges and corners, sheared and of two scales."""
    rng = random.Random(12)
    kinds = f"zone_id long, polygons {S.POLYGONS}"
    grown = lambda n, w: {(rng.randrange(w), rng.randrange(w)) for _ in range(n)}
    for shear, scale in ((0.0, 1.0), (1 / 3, 0.1)):
        outer = [grown(n, 6) for n in (10, 20, 40, 60, 100) for _ in range(5)]
        inner = [{(x, y) for x, y in rng.choice(outer) if rng.random() < rng.choice([0.1, 0.9, 1])} | (grown(1, 6) if rng.random() < 0.4 else set()) for _ in range(50)]
        inner = [c for c in inner if c]
        place = lambda cells: [[[(scale * (x + shear * y), scale * (y - shear * x)) for x, y in r] for r in p] for p in traced(cells)]  # noqa: E731, B023
        a = spark.createDataFrame([(i, place(c)) for i, c in enumerate(inner)], kinds)
        b = spark.createDataFrame([(i, place(c)) for i, c in enumerate(outer)], kinds)
        got = {(r.inner_id, r.outer_id) for r in S.covered_by(a, b, 0.5).collect()}
        assert got == {(i, j) for i, x in enumerate(inner) for j, y in enumerate(outer) if x <= y}


def test_covered_by_without_polygons(spark):
    kinds = f"zone_id string, polygons {S.POLYGONS}"
    some = polygon(spark, [(0, 0), (4, 0), (4, 4)])
    none = spark.createDataFrame([("n", None), ("e", [])], kinds)
    assert S.covered_by(none, some, 1.0).count() == S.covered_by(some, none, 1.0).count() == S.covered_by(none.where("false"), some, 1.0).count() == 0


def test_boxes_of_all_sizes_meet(spark):
    rng = random.Random(3)
    boxes = []
    for i in range(400):
        size = 10 ** rng.uniform(-6, 3) if i else 4e4
        x, y = (rng.uniform(-1, 1) * 10 ** rng.uniform(-3, 3) for _ in "xy")
        boxes.append((i, x, y, x + size * rng.choice([0, 1, 0.01]), y + size))
    boxes += [(400, 0.0, 0.0, 0.0, 0.0), (401, 0.0, 0.0, 1.0, 0.0), (402, -4e4, -4e4, 4e4, 4e4)]
    df = spark.createDataFrame(boxes, "id int, x0 double, y0 double, x1 double, y1 double")
    rows = S.bbox_join(df, df, 1e-3).select("a_id", "b_id").collect()
    meet = lambda a, b: a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    assert sorted((r.a_id, r.b_id) for r in rows) == sorted((a[0], b[0]) for a in boxes for b in boxes if meet(a, b))
    cells = df.withColumn("level", S._level(1e-3)).withColumn("s", 1e-3 * F.pow(F.lit(4.0), F.col("level")))
    own = cells.selectExpr("(floor(x1 / s) - floor(x0 / s) + 1) * (floor(y1 / s) - floor(y0 / s) + 1) AS n").agg(F.max("n")).first()[0]
    assert own <= 4


def test_features_are_read_as_whole_texts(spark, tmp_path):
    """No JSON scan, which reads the file again for each feature's coordinates; marks and blank files do no harm."""
    one = '{"type": "Feature", "properties": {"a": "%d"}, "geometry": {"type": "Point", "coordinates": [%d, 2.50]}}'
    (tmp_path / "a.json").write_text('\ufeff{"type": "FeatureCollection",\n"features": [' + ",\n".join(one % (i, i) for i in range(3)) + "]}", "utf-8")
    (tmp_path / "b.json").write_text('{"type": "Point",\n "coordinates": [7, 8]}')
    (tmp_path / "c.json").write_text("\n")
    rows = sources.read_features(spark, str(tmp_path))
    assert sorted((r.doc[-6:], r.pos, r.coordinates) for r in rows.collect()) == [("a.json", i + 1, f"[{i},2.5]") for i in range(3)] + [("b.json", 1, "[7,8]")]
    assert "Format: Text" in rows._jdf.queryExecution().executedPlan().toString()


def test_equal_boxes_and_zones_are_tested_once(spark, monkeypatch):
    """Many ids of few boxes: what meets in cells is bounded by the distinct ones, and every pair of ids is there."""
    shapes = [(0, 0, 9, 9), (1, 1, 3, 3), (2, 2, 5, 12), (20, 20, 21, 21)]
    boxes = [(i, *map(float, shapes[i % 4])) for i in range(120)]
    df = spark.createDataFrame(boxes, "id int, x0 double, y0 double, x1 double, y1 double")
    seen, plain = [], S.boxes_that_meet

    def counted(a, b, cell, on):
        seen.append((a.count(), b.count()))
        return plain(a, b, cell, on)

    monkeypatch.setattr(S, "boxes_that_meet", counted)
    meet = lambda a, b: a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    got = sorted((r.a_id, r.b_id) for r in S.bbox_join(df, df, 1.0).collect())
    assert got == [(a[0], b[0]) for a in boxes for b in boxes if meet(a, b)]
    zones = S.boxes_to_zones(df, "id", *map(F.col, ("x0", "y0", "x1", "y1")))
    zones = zones.union(zones.where("zone_id < 7"))  # ids that repeat are one zone
    got = sorted((r.inner_id, r.outer_id) for r in S.covered_by(zones, zones, 1.0).collect())
    within = lambda a, b: a[1] >= b[1] and a[2] >= b[2] and a[3] <= b[3] and a[4] <= b[4]
    assert got == [(a[0], b[0]) for a in boxes for b in boxes if within(a, b)]
    assert max(max(n) for n in seen) < 60


def test_span_counts_equal_counts_of_zoned_pixels(spark):
    """Rows of several blocks of 64 columns, with gaps, invalid pixels, long spans, ends on block edges, empty zones."""
    rng = random.Random(6)
    pixels = [(f"t{t}", r, c, rng.randrange(100), rng.randrange(0, 24), int(rng.random() < 0.9), 1) for t in range(2) for r in range(3) for c in sorted(rng.sample(range(400), 250)) if not (128 <= c < 192 and r == 1)]
    px = spark.createDataFrame(pixels, "tile_id string, prow int, pcol int, treecover int, lossyear int, tree_valid int, loss_valid int")
    spans = [(z, f"t{rng.randrange(2)}", rng.randrange(4), c0, c0 + rng.choice([0, 1, 63, 64, 200])) for z in range(30) for c0 in (rng.choice([0, 1, 63, 64, 65, 127, 128, 190, 191, 192, 320, 399]),)]
    spans = [s for s in spans if s[4] < 600]
    own = spark.createDataFrame(spans, "zone_id int, tile_id string, prow int, c0 int, c1 int")
    masks = {"all_": F.lit(True), "loss": C.loss_total(30)}
    got = {(r.zone_id, r.tile_id, r.prow): (r.all_, r.loss) for r in Z.span_counts(own, px, masks).collect()}
    want = {}
    for z, t, row, c0, c1 in spans:
        inside_ = [p for p in pixels if p[0] == t and p[1] == row and c0 <= p[2] <= c1 and p[5]]
        a, b = want.get((z, t, row), (0, 0))
        want[z, t, row] = (a + len(inside_), b + sum(p[3] >= 30 and p[4] > 0 for p in inside_))
    assert got == want
    assert Z.span_counts(own.where("false"), px, masks).count() == 0
    assert {tuple(r)[3:] for r in Z.span_counts(own, px.where("false"), masks).collect()} == {(0, 0)}


def test_touched_spans_are_merged(spark):
    zones = polygon(spark, [(1.2, 1.1), (9.4, 1.3), (9.2, 8.8), (5, 3.2), (1.5, 8.7)])
    tiles = spark.createDataFrame([("t", 0.0, 10.0, 1.0, 12, 10)], "tile_id string, x0 double, y0 double, step double, width int, height int")
    spans = S.tile_spans(zones, tiles, "touched").collect()
    cells = [(r.prow, c) for r in spans for c in range(r.c0, r.c1 + 1)]
    assert len(cells) == len(set(cells))
    pixels = spark.createDataFrame([("t", r, c) for r in range(10) for c in range(12)], "tile_id string, prow int, pcol int")
    met = S.zone_pixels(zones, pixels, tiles, "touched")
    assert sorted((r.prow, r.pcol) for r in met.collect()) == sorted(cells)
    assert "deduplicate" not in met._jdf.queryExecution().toString().lower()


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_equal_boxes_in_lists(spark, monkeypatch, most):
    """Groups of more and fewer ids than a list, ids that repeat and null ones, broadcast or not, either side the larger."""
    monkeypatch.setattr(S, "BROADCAST_BYTES", most)
    monkeypatch.setattr(S, "LIST", 7)
    monkeypatch.setattr(S, "PIECE_PAIRS", 50)
    monkeypatch.setattr(S, "PARTNERS", 10)
    at = random.Random(5)
    box = [(float(x := at.randrange(30)), float(y := at.randrange(30)), x + at.choice([0.0, 1.0, 9.0]), y + at.choice([1.0, 4.0, 20.0])) for _ in range(40)]
    made = lambda n, p: [(None if k % 50 == 0 else f"{p}{k % 300}", *box[min(at.randrange(40), at.randrange(40)) if k % 4 else 3]) for k in range(n)]
    few, many = made(60, "f"), made(400, "m") + [("n", None, 0.0, 1.0, 1.0)] * 9
    kind = "id string, x0 double, y0 double, x1 double, y1 double"
    text = lambda pairs: sorted(map(str, pairs))
    for a, b in ((few, many), (many, few)):
        got = S.bbox_join(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), 1.0).collect()
        known = lambda rows: [r for r in rows if r[1] is not None]
        want = [(r, s) for r in known(a) for s in known(b) if r[1] <= s[3] and s[1] <= r[3] and r[2] <= s[4] and s[2] <= r[4]]
        assert len(want) > 1000
        assert text(((r.a_id, r.a_x0, r.a_y0, r.a_x1, r.a_y1), (r.b_id, r.b_x0, r.b_y0, r.b_x1, r.b_y1)) for r in got) == text(want)


def test_ids_of_equal_boxes_are_not_shuffled_for_each_pair(spark):
    """60 boxes that all meet, 100 times each: 36 million pairs of ids, which no shuffle may hold on either side."""
    from pathlib import Path

    files = lambda: {f: f.stat().st_size for f in Path(spark.sparkContext.getConf().get("spark.local.dir")).rglob("shuffle_*.data")}
    df = spark.range(6000).selectExpr("concat('B', id) AS id", "0.0D AS x0", "0.0D AS y0", "1.0D + id % 60 AS x1", "1.0D AS y1")
    before = files()
    S.bbox_join(df, df, 1.0).select("a_id", "b_id").write.format("noop").mode("overwrite").save()
    new = sum(size for f, size in files().items() if f not in before)
    assert 0 < new < 1_000_000
