"""Connected regions of a pixel mask as polygons, and regridding to equal areas."""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from .spatial import POLYGONS, cut_lineage, equal_area_xy

#: Column numbers stay below this, those of a globe of 30 m pixels too, so that row and column make one number.
WIDTH = 1 << 22


def runs(masked: DataFrame) -> DataFrame:
    """tile_id, prow, c0, c1, run: unbroken runs of masked pixels in a row."""
    order = W.partitionBy("tile_id", "prow").orderBy("pcol")
    cells = masked.select("tile_id", "prow", "pcol").distinct().withColumn("g", F.col("pcol") - F.row_number().over(order))
    out = cells.groupBy("tile_id", "prow", "g").agg(F.min("pcol").alias("c0"), F.max("pcol").alias("c1"))
    return out.select("tile_id", "prow", "c0", "c1", (F.col("prow").cast("long") * WIDTH + F.col("c0")).alias("run"))


def region_labels(masked: DataFrame) -> DataFrame:
    """tile_id, prow, c0, c1, region: 4-connected regions within a tile, named by their first pixel.

    Runs of pixels that meet in neighbouring rows are linked. Each round takes the least name among the
    neighbours and then the name of the run so named, so that names travel in doubling steps; it ends
    when none changes.
    """
    own = cut_lineage(runs(masked))
    below = own.select("tile_id", (F.col("prow") - 1).alias("prow"), F.col("c0").alias("d0"), F.col("c1").alias("d1"), F.col("run").alias("b"))
    meet = own.join(below, ["tile_id", "prow"]).where("c0 <= d1 and d0 <= c1").select("tile_id", F.col("run").alias("a"), "b")
    links = cut_lineage(meet.union(meet.select("tile_id", F.col("b").alias("a"), F.col("a").alias("b"))))
    names = own.select("tile_id", "run", F.col("run").alias("region"))
    while True:
        least = links.join(names.select("tile_id", F.col("run").alias("b"), "region"), ["tile_id", "b"]).groupBy("tile_id", F.col("a").alias("run")).agg(F.min("region").alias("least"))
        near = names.join(least, ["tile_id", "run"], "left").select("tile_id", "run", "region", F.least("region", "least").alias("least"))
        root = names.select("tile_id", F.col("run").alias("least"), F.col("region").alias("root"))
        new = cut_lineage(near.join(root, ["tile_id", "least"]).select("tile_id", "run", F.least("least", "root").alias("region"), (F.least("least", "root") < F.col("region")).alias("moved")))
        names = new.drop("moved")
        if new.where("moved").isEmpty():
            return own.join(names, ["tile_id", "run"]).drop("run")


def boundary(labels: DataFrame) -> DataFrame:
    """tile_id, region, x1, y1, x2, y2: unit edges of the regions' outlines, the region on the right hand
    (rows run down). An edge between two pixels of a region shows twice and goes."""
    cells = labels.select("tile_id", "region", "prow", F.explode(F.sequence("c0", "c1")).alias("pcol"))
    x, y = F.col("pcol"), F.col("prow")
    edge = lambda x1, y1, x2, y2: F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    four = F.array(edge(x, y, x + 1, y), edge(x + 1, y, x + 1, y + 1), edge(x + 1, y + 1, x, y + 1), edge(x, y + 1, x, y))
    edges = cells.select("tile_id", "region", F.explode(four).alias("e")).select("tile_id", "region", "e.*")
    same = [F.least("x1", "x2").alias("ex"), F.least("y1", "y2").alias("ey"), (F.col("y1") == F.col("y2")).alias("flat")]
    first = F.min(F.struct("region", "x1", "y1", "x2", "y2")).alias("e")
    return edges.groupBy("tile_id", *same).agg(F.count("*").alias("n"), first).where("n = 1").select("tile_id", "e.*")


def corner_runs(edges: DataFrame) -> DataFrame:
    """tile_id, region, id, x, y, following: straight pieces of the outlines from corner to corner, named by where
    and which way they begin, each with the piece that follows it.

    Directions 0 to 3 turn right. Where two pixels of a region touch in a corner alone two pieces begin there,
    and the outline turns right, so that they stay apart.
    """
    way = F.when(F.col("x2") > F.col("x1"), 0).when(F.col("y2") > F.col("y1"), 1).when(F.col("x2") < F.col("x1"), 2).otherwise(3)
    e = edges.withColumn("way", way)
    e = e.withColumn("ways", F.count("*").over(W.partitionBy("tile_id", "region", "x1", "y1")))
    along = F.when(F.col("way") == 0, F.col("x1")).when(F.col("way") == 1, F.col("y1")).when(F.col("way") == 2, -F.col("x1")).otherwise(-F.col("y1"))
    e = e.withColumn("line", F.when(F.col("way") % 2 == 0, F.col("y1")).otherwise(F.col("x1"))).withColumn("at", along)
    line = ["tile_id", "region", "way", "line"]
    order = W.partitionBy(*line).orderBy("at")
    begins = F.lag("at").over(order).isNull() | (F.lag("at").over(order) != F.col("at") - 1) | (F.col("ways") > 1)
    e = e.withColumn("begins", begins.cast("int")).withColumn("piece", F.sum("begins").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ends = [F.min_by(F.struct("x1", "y1"), "at").alias("a"), F.max_by(F.struct("x2", "y2"), "at").alias("b"), F.min_by("ways", "at").alias("ways")]
    pieces = e.groupBy(*line, "piece").agg(*ends)
    name = ((F.col("a.y1").cast("long") * WIDTH + F.col("a.x1")) * 4 + F.col("way")).alias("id")
    pieces = pieces.select("tile_id", "region", "way", "ways", name, F.col("a.x1").alias("x"), F.col("a.y1").alias("y"), F.col("b.x2").alias("ex"), F.col("b.y2").alias("ey"))
    after = pieces.select("tile_id", "region", F.col("x").alias("ex"), F.col("y").alias("ey"), F.col("id").alias("following"), F.col("way").alias("next_way"), F.col("ways").alias("next_ways"))
    both = pieces.join(after, ["tile_id", "region", "ex", "ey"]).where("next_ways = 1 or next_way = (way + 1) % 4")
    return both.select("tile_id", "region", "id", "x", "y", "following")


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ring``, the least id of its ring, and ``ahead``, the pieces from it to that one.

    Pointer doubling: after round k a piece knows the least id among the 2**k pieces that follow it, itself
    included, and how far away that is. When a round changes none, all know that of their ring. The number of rounds is the
    logarithm of the longest ring's pieces; each is one join on all pieces.
    """
    now = cut_lineage(pieces.select("tile_id", "region", "id", "x", "y", F.col("following").alias("to"), F.col("id").alias("ring"), F.lit(0).cast("long").alias("ahead")))
    step = 1
    while True:
        far = now.select("tile_id", F.col("id").alias("to"), F.col("to").alias("then"), F.col("ring").alias("far_ring"), F.col("ahead").alias("far_ahead"))
        met = now.join(far, ["tile_id", "to"])
        less = F.col("far_ring") < F.col("ring")
        new = met.select(
            "tile_id", "region", "id", "x", "y", F.col("then").alias("to"), F.least("ring", "far_ring").alias("ring"),
            F.when(less, F.col("far_ahead") + step).otherwise(F.col("ahead")).alias("ahead"), less.alias("moved"),
        )
        new = cut_lineage(new)
        now, step = new.drop("moved"), step * 2
        if new.where("moved").isEmpty():
            return now.drop("to")


def mask_regions(masked: DataFrame) -> DataFrame:
    """tile_id, region, polygons of every 4-connected region of the rows of ``masked`` (tile_id, prow, pcol).

    x is the column, y the row; the outer ring comes first, each ring begins in its first corner by rows and is closed. Rings are ordered
    on Spark: an outline's pieces between corners find the pieces that follow and then their rank, by doubling.
    Regions end at their tile's edge; ``regions_over_tiles`` joins them. No rows give no regions.
    """
    pieces = ranked(corner_runs(boundary(region_labels(masked))))
    own = F.struct((-F.col("ahead")).alias("back"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rings = pieces.groupBy("tile_id", "region", "ring").agg(F.array_sort(F.collect_list(own)).alias("p"))
    # the piece before the first one is nearest to it: sorted by -ahead, the ring's order but for its first piece, which comes last
    rings = rings.select("tile_id", "region", "ring", F.expr("transform(concat(slice(p, size(p), 1), p), v -> struct(v.x, v.y))").alias("r"))
    area = F.expr("aggregate(sequence(1, size(r) - 1), 0D, (s, i) -> s + r[i - 1].x * r[i].y - r[i].x * r[i - 1].y)")
    sized = rings.select("tile_id", "region", F.struct((-area).alias("a"), "ring", "r").alias("s"))
    out = sized.groupBy("tile_id", "region").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return out.select("tile_id", "region", F.expr("array(transform(s, v -> v.r))").cast(POLYGONS).alias("polygons"))


def regions_over_tiles(masked: DataFrame, tiles: DataFrame) -> DataFrame:
    """region, polygons of the regions of all tiles together, in the tiles' coordinates.

    Tiles (tile_id, x0, y0, step) share one grid: their corners lie whole pixels apart. Pixels are placed on it, so
    that a region goes on over any number of seams; where tiles overlap a pixel counts once. Tiles are some
    hundreds to a globe, so they are broadcast; work is dealt by rows of the grid and, later, by piece.
    """
    first = tiles.agg(F.min("x0").alias("x"), F.max("y0").alias("y"), F.min("step").alias("s"), F.max("step").alias("t")).first()
    if first["s"] is None:
        return mask_regions(masked.where(F.lit(False))).drop("tile_id")
    if first["s"] != first["t"]:
        raise ValueError("tiles have pixels of several sizes")
    off = tiles.select("tile_id", F.round((F.lit(first["y"]) - F.col("y0")) / first["s"]).cast("int").alias("row0"), F.round((F.col("x0") - first["x"]) / first["s"]).cast("int").alias("col0"))
    cells = masked.join(F.broadcast(off), "tile_id").select(F.lit(0).alias("tile_id"), (F.col("prow") + F.col("row0")).alias("prow"), (F.col("pcol") + F.col("col0")).alias("pcol"))
    placed = f"transform(polygons, p -> transform(p, r -> transform(r, v -> struct({first['x']!r}D + v.x * {first['s']!r}D AS x, {first['y']!r}D - v.y * {first['s']!r}D AS y))))"
    return mask_regions(cells).select("region", F.expr(placed).cast(POLYGONS).alias("polygons"))


def equal_area_maps(pixels: DataFrame, x0: float, y0: float, step: float, width: int, height: int, cell_m: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(drow, prow) and (dcol, pcol): the source row and column nearest to each row and column of an
    equal-area grid over the same ground. In a cylindrical projection rows depend on latitude alone and
    columns on longitude alone. Cells are ``cell_m`` metres, or a pixel's width at the standard parallel."""
    spark = pixels.sparkSession
    e2, q_pole = C.WGS84_E2, C.Q_POLE
    k0 = math.cos(math.radians(30)) / math.sqrt(1 - e2 * 0.25)
    size = cell_m or C.WGS84_A * k0 * math.radians(step)
    edge = spark.range(1).select(*[equal_area_xy(F.lit(x0), F.lit(y))[1].alias(n) for n, y in (("top", y0), ("low", y0 - height * step))]).first()
    y = F.lit(edge["top"]) - (F.col("id") + 0.5) * size
    beta = F.asin(y * 2 * k0 / (C.WGS84_A * q_pole))
    lat = F.degrees(beta + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta) + 761 * e2**3 / 45360 * F.sin(6 * beta))
    rows = spark.range(math.ceil((edge["top"] - edge["low"]) / size)).select(F.col("id").cast("int").alias("drow"), F.floor((y0 - lat) / step).cast("int").alias("prow"))
    lon = F.lit(x0) + F.degrees((F.col("id") + 0.5) * size / (C.WGS84_A * k0))
    columns = spark.range(math.ceil(C.WGS84_A * k0 * math.radians(width * step) / size)).select(F.col("id").cast("int").alias("dcol"), F.floor((lon - x0) / step).cast("int").alias("pcol"))
    return rows.where(F.col("prow").between(0, height - 1)), columns.where(F.col("pcol").between(0, width - 1))


def regrid(pixels: DataFrame, x0: float, y0: float, step: float, width: int, height: int, cell_m: float | None = None) -> DataFrame:
    """Nearest-neighbour values of ``pixels`` on an equal-area grid, with drow and dcol for prow and pcol.

    Cells whose centre lies outside the source have no row. The two maps have a row for each line of the
    grid, not for each pixel; each is broadcast.
    """
    rows, columns = equal_area_maps(pixels, x0, y0, step, width, height, cell_m)
    return pixels.join(F.broadcast(rows), "prow").join(F.broadcast(columns), "pcol").drop("prow", "pcol")


#: Grids that ``regrid_tiles`` knows, as source and target: degrees, equal areas, and Mercator on a sphere.
DEGREES, EQUAL_AREA, MERCATOR = "EPSG:4326", "EPSG:6933", "EPSG:3857"


def _move_lines(df: DataFrame, crs: Column, to_crs: Column, xs: dict[str, Column], ys: dict[str, Column]) -> DataFrame:
    """``df`` with coordinates of lines of a grid on another one: longitude is linear in all of them, latitude goes
    through degrees (also kept, as name_lat). Each step is a projection of its own, so that no expression holds
    another one several times over."""
    e2, k0 = C.WGS84_E2, math.cos(math.radians(30)) / math.sqrt(1 - C.WGS84_E2 * 0.25)
    per_degree = lambda c: F.when(c == EQUAL_AREA, C.WGS84_A * k0 * math.pi / 180).when(c == MERCATOR, C.WGS84_A * math.pi / 180).otherwise(1.0)
    df = df.withColumns({k: x / per_degree(crs) * per_degree(to_crs) for k, x in xs.items()} | {f"{k}_b": y for k, y in ys.items()})
    ratio = 2 * k0 / (C.WGS84_A * C.Q_POLE)
    df = df.withColumns({f"{k}_b": F.when(crs == EQUAL_AREA, F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col(f"{k}_b") * ratio)))).otherwise(F.col(f"{k}_b")) for k in ys})
    series = lambda b: b + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * b) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * b) + 761 * e2**3 / 45360 * F.sin(6 * b)
    lat = lambda b: F.when(crs == EQUAL_AREA, F.degrees(series(b))).when(crs == MERCATOR, F.degrees(2 * F.atan(F.exp(b / C.WGS84_A)) - math.pi / 2)).otherwise(b)
    df = df.withColumns({f"{k}_lat": lat(F.col(f"{k}_b")) for k in ys})
    df = df.withColumns({f"{k}_b": F.sin(F.radians(f"{k}_lat")) for k in ys})
    mercator = lambda k: C.WGS84_A * F.ln(F.tan(math.pi / 4 + F.radians(f"{k}_lat") / 2))
    equal = lambda k: C.WGS84_A * C.authalic_q(F.col(f"{k}_b")) / (2 * k0)
    return df.withColumns({k: F.when(to_crs == EQUAL_AREA, equal(k)).when(to_crs == MERCATOR, mercator(k)).otherwise(F.col(f"{k}_lat")) for k in ys}).drop(*[f"{k}_b" for k in ys])


def pixel_area_m2(crs: Column, y0: Column, step: Column) -> Column:
    """A pixel's area in square metres: by its row in degrees, the same for all in a plane grid."""
    top, low = y0 - F.col("prow") * step, y0 - (F.col("prow") + 1) * step
    return F.when(F.coalesce(crs, F.lit(DEGREES)) == DEGREES, C.cell_area_m2(top, low, step)).otherwise(F.abs(step * step))


def target_grids(tiles: DataFrame, target: str = EQUAL_AREA, cell: float | None = None) -> DataFrame:
    """``tiles`` (tile_id, x0, y0, step, width, height, crs) with the grid that each goes to: to_crs, to_x0, to_y0,
    to_step, to_width, to_height.

    A tile of the target's own grid goes to EPSG:3857, one of that grid, without a grid, or where the target has no
    finite coordinates (the poles in EPSG:3857) stays as it is. Cells are square, ``cell`` wide or such that the
    diagonal has as many of them as the tile's has pixels."""
    known = [DEGREES, EQUAL_AREA, MERCATOR]
    if target not in known:
        raise ValueError(f"the target must be one of {known}")
    crs = F.col("crs")
    right, low = F.col("x0") + F.col("width") * F.col("step"), F.col("y0") - F.col("height") * F.col("step")
    wanted = F.when(~crs.isin(known), None).when(crs != target, F.lit(target)).when(crs != MERCATOR, F.lit(MERCATOR))
    out = tiles.withColumn("to_crs", wanted)
    out = _move_lines(out, crs, F.col("to_crs"), {"to_x0": F.col("x0"), "to_x1": right}, {"to_y0": F.col("y0"), "to_y1": low})
    polar = F.greatest(F.abs("to_y0_lat"), F.abs("to_y1_lat")) >= 90
    out = out.withColumn("to_crs", F.when(~((F.col("to_crs") == MERCATOR) & polar), F.col("to_crs")))
    x0, y0, x1, y1 = [F.col(f"to_{c}") for c in ("x0", "y0", "x1", "y1")]
    moved = F.col("to_crs").isNotNull()
    w, h = x1 - x0, y0 - y1
    size = F.lit(cell) if cell else F.sqrt(w * w + h * h) / F.sqrt(F.col("width").cast("double") * F.col("width") + F.col("height").cast("double") * F.col("height"))
    out = out.withColumn("to_step", F.when(moved, size).otherwise(F.col("step")))
    lines = lambda extent, n: F.when(moved, F.ceil(extent / F.col("to_step"))).otherwise(F.col(n)).cast("int")
    out = out.withColumn("to_width", lines(w, "width")).withColumn("to_height", lines(h, "height"))
    out = out.withColumn("to_x0", F.when(moved, x0).otherwise(F.col("x0"))).withColumn("to_y0", F.when(moved, y0).otherwise(F.col("y0")))
    return out.withColumn("to_crs", F.coalesce("to_crs", "crs")).drop("to_x1", "to_y1", "to_y0_lat", "to_y1_lat")


def regrid_tiles(pixels: DataFrame, tiles: DataFrame, target: str = EQUAL_AREA, cell: float | None = None) -> DataFrame:
    """Nearest-neighbour values of the pixels of many tiles, each on the grid that ``target_grids`` gives it, with
    drow and dcol for prow and pcol, and to_crs and to_step.

    The grids are cylindrical, so a source row becomes the target rows whose centres lie between its two edges, and
    columns likewise: each pixel gives its own target cells, without a map of cells or a shuffle. Tiles are some
    hundreds to a globe; they are broadcast. Cells whose centre lies outside the tile have no row."""
    grid = target_grids(tiles, target, cell).select("tile_id", "crs", "x0", "y0", "step", "to_crs", "to_x0", "to_y0", "to_step")
    both = pixels.join(F.broadcast(grid.select("tile_id", *[F.col(c).alias(f"__{c}") for c in grid.columns[1:]])), "tile_id")
    g = {c: F.col(f"__{c}") for c in grid.columns[1:]}
    line = lambda n, more: (F.col(n) + more).cast("double") * g["step"]
    both = _move_lines(both, g["crs"], g["to_crs"], {f"__x_{i}": g["x0"] + line("pcol", i) for i in (0, 1)}, {f"__y_{i}": g["y0"] - line("prow", i) for i in (0, 1)})
    x0, x1, y0, y1 = map(F.col, ("__x_0", "__x_1", "__y_0", "__y_1"))
    first = lambda d: F.ceil(d / g["to_step"] - 0.5).cast("int")
    same = (g["to_crs"] == g["crs"]) | g["crs"].isNull()
    spread = lambda a, b, n: F.when(same, F.array(F.col(n).cast("int"))).when(first(b) > first(a), F.sequence(first(a), first(b) - 1)).otherwise(F.array().cast("array<int>"))
    rows = both.select("*", F.explode(spread(g["to_y0"] - y0, g["to_y0"] - y1, "prow")).alias("drow"))
    cells = rows.select("*", F.explode(spread(x0 - g["to_x0"], x1 - g["to_x0"], "pcol")).alias("dcol"))
    return cells.select(*[c for c in pixels.columns if c not in ("prow", "pcol")], "drow", "dcol", g["to_crs"].alias("to_crs"), g["to_step"].alias("to_step"))


def polygon_area(polygons: Column) -> Column:
    """Area of plane polygons in square units; holes run the other way round and count against it."""
    ring = lambda r: F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), F.lit(0.0), lambda s, i: s + r[i - 1]["x"] * r[i]["y"] - r[i]["x"] * r[i - 1]["y"])
    return F.aggregate(F.flatten(polygons), F.lit(0.0), lambda s, r: s + ring(r)) / 2


def polygon_outline(polygons: Column) -> Column:
    """Length of all rings of polygons whose edges follow the grid."""
    ring = lambda r: F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), F.lit(0.0), lambda s, i: s + F.abs(r[i - 1]["x"] - r[i]["x"]) + F.abs(r[i]["y"] - r[i - 1]["y"]))
    return F.aggregate(F.flatten(polygons), F.lit(0.0), lambda s, r: s + ring(r))
