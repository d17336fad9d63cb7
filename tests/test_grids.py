"""Tiles of any grid on target grids."""

import math

import pytest
from pyspark.sql import functions as F

from forest_evidence.functions import columns as C
from forest_evidence.operators import regions as R

KIND = "tile_id string, x0 double, y0 double, step double, width int, height int, crs string"
TILES = [
    ("north", 20.0, 60.0, 0.02, 40, 30, R.DEGREES), ("south", -70.0, -10.0, 0.05, 20, 50, R.DEGREES), ("equator", -1.0, 1.0, 0.1, 20, 20, R.DEGREES),
    ("plane", 1e6, 4e6, 900.0, 30, 20, R.EQUAL_AREA), ("sphere", 2e6, 8e6, 700.0, 25, 25, R.MERCATOR), ("bare", 5.0, 5.0, 1.0, 4, 3, None), ("other", 5.0, 5.0, 1.0, 4, 3, "EPSG:3301"),
]


@pytest.fixture(scope="module")
def tiles(spark):
    return spark.createDataFrame(TILES, KIND)


def pixels_of(tiles):
    return tiles.select("tile_id", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("prow"), F.col("width")).select("tile_id", "prow", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("pcol"), F.lit("v").alias("g"))


def test_each_target_cell_has_one_pixel_and_the_area_is_kept(spark, tiles):
    grid = {r.tile_id: r for r in R.target_grids(tiles).collect()}
    assert {k: r.to_crs for k, r in grid.items()} == {"north": R.EQUAL_AREA, "south": R.EQUAL_AREA, "equator": R.EQUAL_AREA, "plane": R.MERCATOR, "sphere": R.EQUAL_AREA, "bare": None, "other": "EPSG:3301"}
    out = R.regrid_tiles(pixels_of(tiles), tiles)
    cells = {r.tile_id: r for r in out.groupBy("tile_id").agg(F.count("*").alias("n"), F.countDistinct("drow", "dcol").alias("d"), F.max("drow").alias("rows"), F.max("dcol").alias("cols"), F.min("drow").alias("r0"), F.min("dcol").alias("c0")).collect()}
    area = {r.tile_id: r.a for r in pixels_of(tiles).drop("g").join(tiles, "tile_id").groupBy("tile_id").agg(F.sum(R.pixel_area_m2(F.col("crs"), F.col("y0"), F.col("step"))).alias("a")).collect()}
    for k, r in cells.items():
        g = grid[k]
        assert r.n == r.d and (r.r0, r.c0) == (0, 0)
        # only the last line of cells may have its centres outside
        assert g.to_height - 1 - r.rows in (0, 1) and g.to_width - 1 - r.cols in (0, 1)
        assert (r.rows + 1) * (r.cols + 1) == r.n
        if g.crs == R.DEGREES:
            edge = g.to_step**2 * (r.rows + r.cols + 2)
            assert abs(r.n * g.to_step**2 - area[k]) <= edge
    assert cells["bare"].n == 12 and cells["other"].n == 12
    assert "g" in out.columns  # a column of the pixels' own keeps its name and value
    assert out.where("g is null or g <> 'v'").count() == 0


def test_nearest_pixels_by_the_inverse_projection(spark):
    tile = ("t", 23.0, 59.0, 0.013, 37, 41, R.DEGREES)
    one = spark.createDataFrame([tile], KIND)
    grid = R.target_grids(one, R.MERCATOR, 1000.0).first()
    got = {(r.drow, r.dcol): (r.srow, r.scol) for r in R.regrid_tiles(pixels_of(one).withColumn("srow", F.col("prow")).withColumn("scol", F.col("pcol")), one, R.MERCATOR, 1000.0).collect()}
    want = {}
    for i in range(grid.to_height):
        for j in range(grid.to_width):
            x, y = grid.to_x0 + (j + 0.5) * 1000, grid.to_y0 - (i + 0.5) * 1000
            lon, lat = math.degrees(x / C.WGS84_A), math.degrees(2 * math.atan(math.exp(y / C.WGS84_A)) - math.pi / 2)
            row, col = math.floor((59.0 - lat) / 0.013), math.floor((lon - 23.0) / 0.013)
            if row < 41 and col < 37:
                want[i, j] = (row, col)
    assert got == want


def test_poles_and_unknown_targets(spark, tiles):
    polar = spark.createDataFrame([("p", 0.0, 90.0, 0.5, 10, 10, R.DEGREES)], KIND)
    assert R.target_grids(polar, R.MERCATOR).first().to_crs == R.DEGREES
    assert R.regrid_tiles(pixels_of(polar), polar, R.MERCATOR).count() == 100
    assert R.target_grids(polar).first().to_crs == R.EQUAL_AREA
    with pytest.raises(ValueError):
        R.target_grids(tiles, "EPSG:9999")
    assert R.regrid_tiles(pixels_of(tiles).where("false"), tiles).count() == 0


def test_pixels_are_not_shuffled(spark, tiles, tmp_path):
    pixels_of(tiles).write.parquet(str(tmp_path / "p"))
    plan = R.regrid_tiles(spark.read.parquet(str(tmp_path / "p")), tiles)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
