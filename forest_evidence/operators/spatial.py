"""Polygons, boxes and grids. Spatial joins are equi-joins on tile rows or grid cells with a range left over."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder of the session and read back; a temporary one only where none is set.

    A written table, as a checkpoint keeps what the optimizer has inferred about its rows, which grows from
    round to round, and computes them twice.
    """
    spark = df.sparkSession
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
    path = f"{where}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: polygons: array (polygons) of array (rings) of array (vertices) of struct(x, y)
POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def boxes_to_zones(boxes: DataFrame, key: str, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))
    return boxes.select(F.col(key).alias("zone_id"), F.array(F.array(ring)).alias("polygons"))


def segments(zones: DataFrame, sided: bool = False) -> DataFrame:
    """zone_id, poly, ring, seq, x1, y1, x2, y2 of every edge; rings that aren't closed are. If ``sided``, also
    whether the zone lies on the left of it, whichever way round the ring goes."""
    rings = zones.select("zone_id", F.posexplode("polygons").alias("poly", "rings")).select("zone_id", "poly", F.posexplode("rings").alias("ring", "v"))
    n = F.size("v")
    edges = F.expr("transform(sequence(0, size(v) - 1), i -> struct(i AS seq, v[i].x AS x1, v[i].y AS y1, v[pmod(i + 1, size(v))].x AS x2, v[pmod(i + 1, size(v))].y AS y2))")
    kept = ["zone_id", "poly", "ring"]
    if sided:
        away = lambda i, c: F.col("v")[F.pmod(i, n)][c] - F.col("v")[0][c]
        area = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, i: s + away(i, "x") * away(i + 1, "y") - away(i + 1, "x") * away(i, "y"))
        rings, kept = rings.where(n > 0).withColumn("left", (area > 0) != (F.col("ring") > 0)), [*kept, "left"]
    return rings.where(n > 0).select(*kept, F.explode(edges).alias("e")).select(*kept, "e.*").where("x1 <> x2 or y1 <> y2")


def polygon_count(zones: DataFrame) -> DataFrame:
    return zones.select("zone_id", F.size("polygons").alias("n_polygons"))


def vertex_centroid(zones: DataFrame) -> DataFrame:
    """Mean of the outer rings' vertices without the closing one; (0, 0) if there is none."""
    got = segments(zones).where("ring = 0").groupBy("zone_id").agg(F.avg("x1").alias("lon"), F.avg("y1").alias("lat"))
    return zones.select("zone_id").join(got, "zone_id", "left").fillna(0.0, ["lon", "lat"])


def bounding_box(zones: DataFrame) -> DataFrame:
    return segments(zones).where("ring = 0").groupBy("zone_id").agg(F.min("x1").alias("min_x"), F.min("y1").alias("min_y"), F.max("x1").alias("max_x"), F.max("y1").alias("max_y"))


def approx_area_ha(zones: DataFrame) -> DataFrame:
    """Equirectangular shoelace of the outer rings; metres per degree 110574 and 111320 cos(mean latitude)."""
    rings = segments(zones).where("ring = 0").groupBy("zone_id", "poly")
    part = rings.agg(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("cross"), F.avg("y1").alias("lat"))
    area = F.abs(F.col("cross")) / 2 * 110574.0 * 111320.0 * F.cos(F.radians("lat")) / 10000
    return part.groupBy("zone_id").agg(F.sum(area).alias("area_ha"))


def geodesic_area_ha(zones: DataFrame) -> DataFrame:
    """Area on WGS84 by the excess of each edge on the authalic sphere; holes are subtracted."""
    q = lambda y: F.tan(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), C.authalic_q(F.sin(F.radians(y))) / C.Q_POLE))) / 2)
    t1, t2 = q(F.col("y1")), q(F.col("y2"))
    excess = 2 * F.atan2(F.tan(F.radians(F.col("x2") - F.col("x1")) / 2) * (t1 + t2), 1 + t1 * t2)
    ring = segments(zones).groupBy("zone_id", "poly", "ring").agg(F.abs(F.sum(excess)).alias("s"))
    r2 = C.WGS84_A**2 * C.Q_POLE / 2
    return ring.groupBy("zone_id").agg((F.sum(F.when(F.col("ring") == 0, F.col("s")).otherwise(-F.col("s"))) * r2 / 10000).alias("area_ha"))


def plots(zones: DataFrame) -> DataFrame:
    """Name, centroid, area and polygon count of each zone."""
    out = zones.select("zone_id").join(vertex_centroid(zones), "zone_id").join(geodesic_area_ha(zones), "zone_id", "left").join(polygon_count(zones), "zone_id")
    return out.select("zone_id", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"), F.round("area_ha", 6).alias("area_ha"), "n_polygons")


def zone_spans(zones: DataFrame) -> DataFrame:
    """Centre rule in pixel units (x is columns, y rows): zone_id, prow, c0, c1 of pixels whose centre is inside.

    Each edge gives its crossing with the rows' centre lines; sorted crossings pair into spans. Half-open:
    y1 <= y < y2 and x_in <= x < x_out; holes need no rule of their own.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.ceil(low - 0.5), F.ceil(high - 0.5) - 1
    rows = segments(zones).where(first <= last).withColumn("prow", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    x = F.col("x1") + (F.col("prow") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossed = rows.select("zone_id", "prow", x.alias("x")).groupBy("zone_id", "prow").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pair = F.expr("transform(sequence(0, cast(size(xs) / 2 AS int) - 1), i -> struct(cast(ceil(xs[i * 2] - 0.5) AS int) AS c0, cast(ceil(xs[i * 2 + 1] - 0.5) AS int) - 1 AS c1))")
    return crossed.where("size(xs) > 1").select("zone_id", "prow", F.explode(pair).alias("s")).select("zone_id", "prow", "s.c0", "s.c1").where("c0 <= c1")


def touched_spans(zones: DataFrame) -> DataFrame:
    """All-touched rule: the centre rule's spans and, for each edge and row, the columns it runs through."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first = F.floor(low).cast("int")
    last = F.greatest(F.ceil(high).cast("int") - 1, first)
    rows = segments(zones).withColumn("prow", F.explode(F.sequence(first, last)))
    slope = (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    at = lambda y: F.coalesce(F.col("x1") + (y - F.col("y1")) * slope, F.col("x1"))
    top, bottom = F.greatest(low, F.col("prow").cast("double")), F.least(high, F.col("prow") + 1.0)
    flat = F.col("y1") == F.col("y2")
    a, b = F.when(flat, F.col("x1")).otherwise(at(top)), F.when(flat, F.col("x2")).otherwise(at(bottom))
    c0 = F.floor(F.least(a, b)).cast("int")
    edge = rows.select("zone_id", "prow", c0.alias("c0"), F.greatest(F.ceil(F.greatest(a, b)).cast("int") - 1, c0).alias("c1"))
    # an edge on a grid line touches but doesn't enter the cells beyond it
    return zone_spans(zones).union(edge)


#: Spans of at most so many bytes are broadcast to the pixels.
BROADCAST_BYTES = 24 << 20


def tiles_reached(zones: DataFrame, tiles: DataFrame) -> DataFrame:
    """Each zone with each tile that its box reaches. Tiles are some hundreds to a globe, so their boxes are broadcast."""
    corners = "transform(flatten(flatten(transform(polygons, p -> slice(p, 1, 1)))), v -> v.{})"
    box = [f"array_{f}({corners.format(c)}) AS {f}_{c}" for c in "xy" for f in ("min", "max")]
    boxed = zones.where("size(polygons) > 0").selectExpr("*", *box)
    reach = (F.col("min_x") <= F.col("x0") + F.col("width") * F.col("step")) & (F.col("max_x") >= F.col("x0"))
    reach &= (F.col("min_y") <= F.col("y0")) & (F.col("max_y") >= F.col("y0") - F.col("height") * F.col("step"))
    return boxed.join(F.broadcast(tiles), reach)


def pixels_near(pixels: DataFrame, zones: DataFrame, tiles: DataFrame) -> DataFrame:
    """Pixels of the tiles that zones reach; where tiles are partitions, only theirs are read."""
    return pixels.join(F.broadcast(tiles_reached(zones, tiles).select("tile_id").distinct()), "tile_id", "left_semi")


def tile_spans(zones: DataFrame, tiles: DataFrame, rule: str = "center") -> DataFrame:
    """zone_id, tile_id, prow, c0, c1: the pixels of each zone in each tile that it reaches.

    ``zones`` are in the tiles' coordinates; a tile (tile_id, x0, y0, step, width, height) has its upper left
    corner at (x0, y0) and rows that run down.
    """
    met = tiles_reached(zones, tiles)
    moved = F.expr("transform(polygons, p -> transform(p, r -> transform(r, v -> struct((v.x - x0) / step AS x, (y0 - v.y) / step AS y))))")
    inner = met.select(F.struct("zone_id", "tile_id", "width", "height").alias("zone_id"), moved.alias("polygons"))
    spans = zone_spans(inner) if rule == "center" else touched_spans(inner)
    out = spans.where((F.col("prow") >= 0) & (F.col("prow") < F.col("zone_id.height")))
    out = out.select("zone_id.zone_id", "zone_id.tile_id", "prow", F.greatest("c0", F.lit(0)).alias("c0"), F.least("c1", F.col("zone_id.width") - 1).cast("int").alias("c1"))
    return out.where("c0 <= c1") if rule == "center" else merged_spans(out.where("c0 <= c1"))


def merged_spans(spans: DataFrame) -> DataFrame:
    """The union of the spans of each zone, tile and row as spans that neither overlap nor touch."""
    row = ["zone_id", "tile_id", "prow"]
    ahead = W.partitionBy(*row).orderBy("c0", "c1")
    reach = F.max("c1").over(ahead.rowsBetween(W.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(reach.isNull() | (F.col("c0") > reach + 1), 1).otherwise(0))
    numbered = marked.withColumn("k", F.sum("new").over(ahead.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return numbered.groupBy(*row, "k").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("k")


def zone_pixels(zones: DataFrame, pixels: DataFrame, tiles: DataFrame, rule: str = "center") -> DataFrame:
    """Pixels of each zone: equi-join on tile and row, range on the column; tiles and rows deal the work, not zones.

    Only the partitions of tiles that a zone reaches are read, and of these only rows between the first and the
    last reached one: the tile ids, bounded by the tiles, and two numbers come from the spans first. Spans of a
    checked size are broadcast, others meet the pixels in a shuffle. A zone's spans don't overlap, so no pixel
    comes twice.
    """
    spans = cut_lineage(tile_spans(zones, tiles, rule))
    found = spans.groupBy("tile_id").agg(F.min("prow").alias("low"), F.max("prow").alias("high"), F.count("*").alias("n")).collect()
    if not found:
        return pixels.where(F.lit(False)).withColumn("zone_id", F.lit(None).cast(zones.schema["zone_id"].dataType))
    needed = F.col("tile_id").isin([r["tile_id"] for r in found]) & F.col("prow").between(min(r["low"] for r in found), max(r["high"] for r in found))
    side = F.broadcast(spans) if sum(r["n"] for r in found) * 64 <= BROADCAST_BYTES else spans
    return pixels.where(needed).join(side, ["tile_id", "prow"]).where(F.col("pcol").between(F.col("c0"), F.col("c1"))).drop("c0", "c1")


def zone_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, ["tile_id", "prow", "pcol"], "left_semi")


def zone_union(a: DataFrame, b: DataFrame) -> DataFrame:
    keys = ["tile_id", "prow", "pcol"]
    return a.select(keys).union(b.select(keys)).distinct()


#: Sizes of grid cells are powers of this times the finest one asked for; boxes far smaller share the level LOWEST.
LEVEL_STEP, LOWEST = 4, -12


def _level(cell: float) -> Column:
    """The level whose cells are the smallest not smaller than the box x0, y0, x1, y1, which reaches four of them at most."""
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    level = F.ceil(F.log(size / cell) / math.log(LEVEL_STEP)).cast("int")
    # a logarithm may round down across a power
    level = level + F.when(F.lit(cell) * F.pow(F.lit(float(LEVEL_STEP)), level) < size, 1).otherwise(0)
    return F.when(size > 0, F.greatest(level, F.lit(LOWEST))).otherwise(LOWEST)


def boxes_that_meet(a: DataFrame, b: DataFrame, cell: float, on: list[str]) -> DataFrame:
    """Pairs of rows with equal ``on`` whose boxes (x0, y0, x1, y1) overlap or touch; other columns get a_ and b_.

    A box lies in at most four cells of the level of its own size; a smaller one meets it there. So each row is
    copied to its own cells and, for each larger level that the other side has, to at most four more; the number
    of levels is that of the sizes' orders, whatever the sizes are.
    """
    sides = [df.withColumn("level", _level(cell)) for df in (a, b)]
    found = sides[0].select(F.lit(0).alias("side"), "level").union(sides[1].select(F.lit(1).alias("side"), "level")).where("level is not null").distinct().collect()
    levels = [sorted(r["level"] for r in found if r["side"] == k) for k in (0, 1)]

    def dealt(side: int, wanted: Column, p: str) -> DataFrame:
        df = sides[side].withColumn("at", F.explode(wanted)).withColumn("size", F.lit(cell) * F.pow(F.lit(float(LEVEL_STEP)), F.col("at")))
        cells = lambda k: F.explode(F.sequence(F.floor(F.col(f"{k}0") / F.col("size")), F.floor(F.col(f"{k}1") / F.col("size"))))
        df = df.withColumn("gx", cells("x")).withColumn("gy", cells("y"))
        return df.select(*on, "at", "gx", "gy", *[F.col(c).alias(f"{p}_{c}") for c in [*sides[side].columns] if c not in (*on, "level")])

    own = F.array("level")
    above = lambda found, equal: F.filter(F.array(*map(F.lit, found)).cast("array<int>"), lambda x: x >= F.col("level") if equal else x > F.col("level"))
    met = dealt(0, own, "a").join(dealt(1, above(levels[0], True), "b"), [*on, "at", "gx", "gy"])
    met = met.unionByName(dealt(0, above(levels[1], False), "a").join(dealt(1, own, "b"), [*on, "at", "gx", "gy"]))
    meet = (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("a_y1"))
    size = F.lit(cell) * F.pow(F.lit(float(LEVEL_STEP)), F.col("at"))
    once = (F.col("gx") == F.floor(F.greatest("a_x0", "b_x0") / size)) & (F.col("gy") == F.floor(F.greatest("a_y0", "b_y0") / size))
    return met.where(meet & once).drop("at", "gx", "gy")


#: Pairs of ids that a task makes of pairs of distinct boxes or zones.
PAIRS_PER_TASK = 4_000_000
#: Ids in a list of one box or zone, about; pairs of ids, and boxes or zones that a list meets, in a piece of work, whose
#: pairs Spark's generated code holds together before it hands them on.
LIST, PIECE_PAIRS, PARTNERS = 200, 200_000, 20_000


def _lists(rows: DataFrame, on: list[str]) -> tuple[DataFrame, int]:
    """The ids of rows with equal ``on`` in lists of about LIST (on.., part, their column's name), and the bytes of all."""
    own = next(c for c in rows.columns if c not in on)
    known = rows.where(" and ".join(f"{c} is not null" for c in on))
    named = cut_lineage(known.select(*on, own, F.monotonically_increasing_id().alias("k")))
    size = named.agg(F.sum(F.coalesce(F.octet_length(F.col(own).cast("string")), F.lit(0)) + 24)).first()[0] or 0
    large = named.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > LIST)
    part = F.coalesce(F.pmod(F.xxhash64("k"), F.ceil(F.col("n") / LIST)), F.lit(0))
    dealt = named.join(large, on, "left").groupBy(*on, part.alias("part"))
    # structs, as collect_list leaves nulls out
    return dealt.agg(F.transform(F.collect_list(F.struct(own)), lambda x: x[own]).alias(own)), size


def _expanded(pairs: DataFrame, a: DataFrame, b: DataFrame, on: tuple[list[str], list[str]]) -> DataFrame:
    """Pairs of distinct things (on[0], on[1], a_n and b_n: how many rows are alike) with each row's id of ``a`` and ``b``.

    Ids travel in lists, once for each piece of work: a list of one side with what it meets on the other. So what is
    shuffled besides the tables and the distinct pairs is an id for about a thousand pairs of ids, which only come up in
    the last step. The other side, that of fewer bytes, is broadcast if it is small, else joined.
    """
    pairs = cut_lineage(pairs)
    (a, size_a), (b, size_b), n_a, n_b = _lists(a, on[0]), _lists(b, on[1]), F.col("a_n"), F.col("b_n")
    if size_a < size_b:
        a, b, on, size_b, n_a, n_b = b, a, (on[1], on[0]), size_a, n_b, n_a
    n = pairs.agg(F.sum(n_a * n_b).alias("n")).first()["n"] or 0
    parts = max(pairs.sparkSession.sparkContext.defaultParallelism, min(20000, n // PAIRS_PER_TASK))
    each = pairs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(n_b / LIST) - 1)))
    weight = F.greatest(F.least(n_a, F.lit(LIST)) * F.least(n_b, F.lit(LIST)), F.lit(PIECE_PAIRS // PARTNERS))
    before = F.sum(weight).over(W.partitionBy(*on[0]).orderBy(*on[1], "part").rowsBetween(W.unboundedPreceding, -1))
    work = each.withColumn("piece", F.coalesce(F.floor(before / PIECE_PAIRS), F.lit(0)))
    work = work.groupBy(*on[0], "piece").agg(F.collect_list(F.struct(*on[1], "part")).alias("partners"))
    work = a.drop("part").join(work, on[0]).drop("piece").repartition(parts)
    met = work.withColumn("p", F.explode("partners")).drop("partners").select("*", "p.*").drop("p")
    met = met.join(F.broadcast(b) if size_b <= BROADCAST_BYTES else b, [*on[1], "part"]).drop("part")
    for ids in (next(c for c in df.columns if c not in (*keys, "part")) for df, keys in ((a, on[0]), (b, on[1]))):
        met = met.withColumn(ids, F.explode(ids))
    return met


def bbox_join(a: DataFrame, b: DataFrame, cell: float, where: Column | None = None) -> DataFrame:
    """Pairs of boxes (a_id.., b_id..) that overlap or touch; columns id, x0, y0, x1, y1 on both sides.

    Boxes of any sizes meet in grid cells of their own size, ``cell`` and its powers; a pair that meets in several
    is taken in the first they share. Equal boxes meet others once, whatever their number, and take on their ids
    afterwards. ``where`` (a_x0.., b_x0..) is what pairs must fulfil besides.
    """
    box = ["x0", "y0", "x1", "y1"]
    met = boxes_that_meet(*[df.groupBy(*box).agg(F.count("*").alias("n")) for df in (a, b)], cell, [])
    sides = [df.select(*[F.col(c).alias(f"{p}_{c}") for c in ["id", *box]]) for p, df in (("a", a), ("b", b))]
    return _expanded(met if where is None else met.where(where), *sides, ([f"a_{c}" for c in box], [f"b_{c}" for c in box]))


#: Coordinates that differ by less than this share of their size are taken for equal.
NOISE = 1e-12
#: Shorter pieces of an edge (shares of it) are what rounding leaves between two contacts.
PIECE = 1e-10


def _boxed(edges: DataFrame) -> DataFrame:
    """Edges with their end points as ax, ay, bx, by and their boxes."""
    ends = {"ax": "x1", "ay": "y1", "bx": "x2", "by": "y2"}
    kept = [c for c in edges.columns if c not in ends.values()]
    box = [f("x1", "x2").alias(x) for f, x in ((F.least, "x0"), (F.greatest, "x9"))] + [f("y1", "y2").alias(y) for f, y in ((F.least, "y0"), (F.greatest, "y9"))]
    out = edges.select(*kept, *[F.col(v).alias(k) for k, v in ends.items()], *box)
    return out.withColumnsRenamed({"x9": "x1", "y9": "y1"})


def _contacts(met: DataFrame) -> DataFrame:
    """Of edges that may meet (a_.., b_..), those that do: t0, t1 on a and u0, u1 on b (shares of the edge; equal
    where they meet in a point), and whether they run along each other."""
    c = lambda n: F.col(n)
    dx, dy, ex, ey = c("a_bx") - c("a_ax"), c("a_by") - c("a_ay"), c("b_bx") - c("b_ax"), c("b_by") - c("b_ay")
    wx, wy = c("b_ax") - c("a_ax"), c("b_ay") - c("a_ay")
    scale = F.greatest(*[F.abs(c(f"{p}_{q}")) for p in "ab" for q in ("ax", "ay", "bx", "by")])
    long_a, long_b = F.hypot(dx, dy), F.hypot(ex, ey)
    off = lambda vx, vy, ux, uy, n: F.abs(vx * uy - vy * ux) / n <= scale * NOISE
    along = off(wx, wy, dx, dy, long_a) & off(c("b_bx") - c("a_ax"), c("b_by") - c("a_ay"), dx, dy, long_a)
    along = along | (off(-wx, -wy, ex, ey, long_b) & off(c("a_bx") - c("b_ax"), c("a_by") - c("b_ay"), ex, ey, long_b))
    on_a = lambda x, y: ((x - c("a_ax")) * dx + (y - c("a_ay")) * dy) / (long_a * long_a)
    on_b = lambda x, y: ((x - c("b_ax")) * ex + (y - c("b_ay")) * ey) / (long_b * long_b)
    clip = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    t = [clip(on_a(c(f"b_{e}x"), c(f"b_{e}y"))) for e in "ab"]
    u = [clip(on_b(c(f"a_{e}x"), c(f"a_{e}y"))) for e in "ab"]
    cross = F.nullif(dx * ey - dy * ex, F.lit(0.0))
    ti, ui = (wx * ey - wy * ex) / cross, (wx * dy - wy * dx) / cross
    slack_a, slack_b = scale * NOISE / long_a, scale * NOISE / long_b
    at = ti.between(-slack_a, 1 + slack_a) & ui.between(-slack_b, 1 + slack_b)
    lies = F.struct(F.least(*t).alias("t0"), F.greatest(*t).alias("t1"), F.least(*u).alias("u0"), F.greatest(*u).alias("u1"), F.lit(True).alias("along"))
    point = F.struct(clip(ti).alias("t0"), clip(ti).alias("t1"), clip(ui).alias("u0"), clip(ui).alias("u1"), F.lit(False).alias("along"))
    return met.withColumn("m", F.when(along, lies).when(at, point)).where("m is not null")


def _pieces(edges: DataFrame, by: list[str]) -> DataFrame:
    """Middle points (x, y) of the pieces of each contacted edge that don't run along an edge of the other side;
    ``edges`` has a row for each contact, with ends ax, ay, bx, by and t0, t1, along."""
    own = edges.groupBy(*by, "ax", "ay", "bx", "by").agg(F.collect_set("t0").alias("p"), F.collect_set("t1").alias("q"), F.collect_set(F.when(F.col("along"), F.struct("t0", "t1"))).alias("lies"))
    cuts = F.array_sort(F.array_union(F.array_union("p", "q"), F.array(F.lit(0.0), F.lit(1.0))))
    both = own.withColumn("c", cuts).withColumn("k", F.explode(F.expr("sequence(0, size(c) - 2)")))
    t0, t1 = F.col("c")[F.col("k")], F.col("c")[F.col("k") + 1]
    both = both.withColumn("t", (t0 + t1) / 2).where(t1 - t0 > PIECE)
    both = both.where(~F.exists("lies", lambda s: (F.col("t") >= s["t0"]) & (F.col("t") <= s["t1"])))
    return both.select(*by, (F.col("ax") + F.col("t") * (F.col("bx") - F.col("ax"))).alias("x"), (F.col("ay") + F.col("t") * (F.col("by") - F.col("ay"))).alias("y"))


def _inside(points: DataFrame, edges: DataFrame, on: list[str], cell: float) -> DataFrame:
    """``points`` (.., x, y, none on an edge) with ``inside``: by parity of the edges with the same ``on`` to their right,
    met by the level and band of the edges' heights."""
    named = cut_lineage(points.withColumn("point", F.monotonically_increasing_id()))
    line = named.select(*on, "point", F.lit(0.0).alias("x0"), F.lit(0.0).alias("x1"), F.col("y").alias("y0"), F.col("y").alias("y1"), "x")
    band = edges.where("ay <> by").select(*on, "ax", "ay", "bx", "by", F.lit(0.0).alias("x0"), F.lit(0.0).alias("x1"), "y0", "y1")
    met = boxes_that_meet(line, band, cell, on)
    hit = (F.col("b_ay") <= F.col("a_y0")) != (F.col("b_by") <= F.col("a_y0"))
    hit &= F.col("a_x") < F.col("b_ax") + (F.col("a_y0") - F.col("b_ay")) * (F.col("b_bx") - F.col("b_ax")) / (F.col("b_by") - F.col("b_ay"))
    odd = met.where(hit).groupBy("a_point").agg((F.count("*") % 2 == 1).alias("odd"))
    out = named.join(odd, named["point"] == odd["a_point"], "left")
    return out.select(*points.columns, F.coalesce("odd", F.lit(False)).alias("inside"))


def _shapes(zones: DataFrame, p: str) -> tuple[DataFrame, DataFrame]:
    """The distinct polygons of zones as zone_id (the smallest id that has them), polygons; and (shape, ``p``_id) of all."""
    one = zones.where("size(polygons) > 0").groupBy("zone_id").agg(F.flatten(F.array_sort(F.collect_set("polygons"))).alias("polygons"))
    one = cut_lineage(one)
    shapes = cut_lineage(one.groupBy("polygons").agg(F.min("zone_id").alias("zone_id"), F.count("*").alias("n")))
    ids = one.join(shapes.select("polygons", F.col("zone_id").alias(f"{p}_shape")), "polygons").select(f"{p}_shape", F.col("zone_id").alias(f"{p}_id"))
    return shapes, cut_lineage(ids)


def covered_by(inner: DataFrame, outer: DataFrame, cell: float) -> DataFrame:
    """(inner_id, outer_id) of zones in full inside one of ``outer``, boundary allowed: concave ones, holes, several parts.

    Zones of equal polygons are tested once, whatever their number, and take on their ids afterwards.
    """
    (a, a_ids), (b, b_ids) = _shapes(inner, "inner"), _shapes(outer, "outer")
    found = covered_shapes(a.select("zone_id", "polygons"), b.select("zone_id", "polygons"), cell).withColumnsRenamed({"inner_id": "inner_shape", "outer_id": "outer_shape"})
    counted = found.join(a.select(F.col("zone_id").alias("inner_shape"), F.col("n").alias("a_n")), "inner_shape").join(b.select(F.col("zone_id").alias("outer_shape"), F.col("n").alias("b_n")), "outer_shape")
    return _expanded(counted, a_ids, b_ids, (["inner_shape"], ["outer_shape"])).select("inner_id", "outer_id")


def covered_shapes(inner: DataFrame, outer: DataFrame, cell: float) -> DataFrame:
    """``covered_by`` zone by zone.

    Candidates come from boxes. Edges of both sides of a candidate meet in grid cells of their own size. Where
    an inner edge meets the outer boundary it is cut; pieces that don't run along it are inside or outside as
    their middle is, and so is what follows up to the next contact, so edges without contact need no test,
    but for one point of each ring. An outer zone covers an inner one if no inner piece is outside, no piece
    of the outer boundary, which is cut by the inner edges likewise, is within the inner zone (holes and gaps),
    and both zones lie on the same side where edges run along each other.
    Zones must be valid: rings that don't cross, parts that meet in points at most. Null or empty polygons
    are covered by nothing and cover nothing; ids that repeat are taken for one zone.
    """
    whole = lambda z: z.where("size(polygons) > 0")
    inner, outer = whole(inner), whole(outer)
    box = lambda z: bounding_box(z).select(F.col("zone_id").alias("id"), F.col("min_x").alias("x0"), F.col("min_y").alias("y0"), F.col("max_x").alias("x1"), F.col("max_y").alias("y1"))
    fits = (F.col("a_x0") >= F.col("b_x0")) & (F.col("a_x1") <= F.col("b_x1")) & (F.col("a_y0") >= F.col("b_y0")) & (F.col("a_y1") <= F.col("b_y1"))
    pairs = cut_lineage(bbox_join(box(inner), box(outer), cell, fits).select(F.col("a_id").alias("inner_id"), F.col("b_id").alias("outer_id")))
    both = ["inner_id", "outer_id"]
    ring = F.struct("poly", "ring").alias("ring")
    edges = lambda z, p: _boxed(segments(z, sided=True).select(F.col("zone_id").alias(p), ring, "left", "seq", "x1", "y1", "x2", "y2"))
    mine = cut_lineage(edges(inner, "inner_id").join(pairs, "inner_id"))
    theirs = cut_lineage(edges(outer, "outer_id").join(pairs, "outer_id", "left_semi"))
    met = cut_lineage(_contacts(boxes_that_meet(mine, theirs, cell, ["outer_id"])).select("outer_id", F.col("a_inner_id").alias("inner_id"), *[F.col(f"{p}_{c}") for p in "ab" for c in ("ring", "left", "ax", "ay", "bx", "by")], "m.*"))
    same_way = (F.col("a_bx") - F.col("a_ax")) * (F.col("b_bx") - F.col("b_ax")) + (F.col("a_by") - F.col("a_ay")) * (F.col("b_by") - F.col("b_ay")) > 0
    beyond = met.where(F.col("along") & (F.col("t1") - F.col("t0") > PIECE) & (same_way != (F.col("a_left") == F.col("b_left")))).select(both)
    ends = lambda p: [F.col(f"{p}_{c}").alias(c) for c in ("ring", "ax", "ay", "bx", "by")]
    cut_inner = _pieces(met.select(*both, *ends("a"), "t0", "t1", "along"), [*both, "ring"])
    cut_outer = _pieces(met.select(*both, *ends("b"), F.col("u0").alias("t0"), F.col("u1").alias("t1"), "along"), [*both, "ring"])
    lone = lambda rings, seen: rings.join(seen, [*both, "ring"], "left_anti")
    middle = [((F.col("ax") + F.col("bx")) / 2).alias("x"), ((F.col("ay") + F.col("by")) / 2).alias("y")]
    first = lambda e, keys: e.groupBy(*keys).agg(F.min(F.struct("seq", "ax", "ay", "bx", "by")).alias("e")).select(*keys, "e.*").select(*keys, *middle)
    free_inner = lone(first(mine, [*both, "ring"]), met.select(*both, F.col("a_ring").alias("ring")))
    seen = _inside(cut_inner.unionByName(free_inner), theirs, ["outer_id"], cell)
    outside = seen.where("not inside").select(both)
    # rings of the outer zone that don't touch the inner one: holes or parts within it, by their boxes
    rings = first(theirs, ["outer_id", "ring"]).select("outer_id", "ring", "x", "y", *[F.col(c).alias(d) for c, d in (("x", "x0"), ("y", "y0"), ("x", "x1"), ("y", "y1"))])
    own = bounding_box(inner).select(F.col("zone_id").alias("inner_id"), F.col("min_x").alias("x0"), F.col("min_y").alias("y0"), F.col("max_x").alias("x1"), F.col("max_y").alias("y1")).join(pairs, "inner_id")
    near = boxes_that_meet(own, rings, cell, ["outer_id"]).select(F.col("a_inner_id").alias("inner_id"), "outer_id", F.col("b_ring").alias("ring"), F.col("b_x").alias("x"), F.col("b_y").alias("y"))
    free_outer = lone(near, met.select(*both, F.col("b_ring").alias("ring")))
    held = _inside(cut_outer.unionByName(free_outer), mine.drop("outer_id").distinct(), ["inner_id"], cell).where("inside").select(both)
    return pairs.join(outside.union(held).union(beyond).distinct(), both, "left_anti")


def tiles_of_boxes(boxes: DataFrame, anchor: str = "upper_left", degrees: int = 10) -> DataFrame:
    """Box rows (id, x0, y0, x1, y1 in degrees) with the id of every tile they reach; upper ends are exclusive."""
    last = lambda lo, hi: F.greatest(F.floor(F.col(lo) / degrees), F.ceil(F.col(hi) / degrees) - 1)
    out = boxes.withColumn("tx", F.explode(F.sequence(F.floor(F.col("x0") / degrees), last("x0", "x1")))).withColumn("ty", F.explode(F.sequence(F.floor(F.col("y0") / degrees), last("y0", "y1"))))
    lat = (F.col("ty") + (1 if anchor == "upper_left" else 0)) * degrees
    return out.withColumn("tile_id", C.tile_id(lat, F.col("tx") * degrees)).drop("tx", "ty")


def prune_tiles(tiles: DataFrame, needed: DataFrame) -> DataFrame:
    """The needed tiles; all if no tile has an id or none is needed."""
    wanted = tiles.join(needed.select("tile_id").distinct(), "tile_id", "left_semi")
    return tiles if wanted.isEmpty() else wanted


def in_scope(boxes: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return boxes.where((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))


def equal_area_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Cylindrical equal-area coordinates with standard parallel 30 degrees."""
    s = math.sin(math.radians(30))
    k0 = math.cos(math.radians(30)) / math.sqrt(1 - C.WGS84_E2 * s * s)
    return C.WGS84_A * k0 * F.radians(lon), C.WGS84_A * C.authalic_q(F.sin(F.radians(lat))) / (2 * k0)


def pair_tiles(cover: DataFrame, loss: DataFrame) -> DataFrame:
    """Each cover tile with its loss tile: a sole pair whatever its names, else by file name where names are unique
    on both sides, else by parent directory; fails if a cover tile has no partner or a side is empty."""
    name, folder = F.substring_index("path", "/", -1), F.regexp_extract("path", r"([^/]+)/[^/]*$", 1)
    size = lambda df: df.agg(F.count("*").alias("n"), F.countDistinct(name).alias("names")).first()
    a, b = size(cover), size(loss)
    if not a["n"] or not b["n"]:
        raise ValueError("no cover or no loss tiles")
    key = F.lit(1) if a["n"] == b["n"] == 1 else name if a["n"] == a["names"] and b["n"] == b["names"] else folder
    left, right = cover.select(key.alias("k"), F.col("path").alias("cover_path")), loss.groupBy(key.alias("k")).agg(F.max("path").alias("loss_path"))
    lone = F.raise_error(F.concat(F.lit("no loss tile for "), F.col("cover_path"))).cast("boolean")
    both = left.join(right, "k", "left")
    return both.where(F.when(F.col("loss_path").isNull(), lone).otherwise(True)).select("cover_path", "loss_path")
