"""Statistics of pixel masks in zones. One pass each: conditional counts per zone and row, then areas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C


def pixel_xy(pixels: DataFrame, x0: float, y0: float, step: float) -> DataFrame:
    """Centres of pixels of a grid with its upper left corner at (x0, y0)."""
    return pixels.withColumn("x", x0 + (F.col("pcol") + 0.5) * step).withColumn("y", y0 - (F.col("prow") + 0.5) * step)


def row_area(y0: float, step: float) -> Column:
    """A pixel's area in square metres; it depends on the row alone."""
    top = y0 - F.col("prow") * step
    return C.cell_area_m2(top, top - step, F.lit(step))


def masked_counts(pixels: DataFrame, masks: dict[str, Column], by: list[str]) -> DataFrame:
    """Valid pixels of each mask per group and row: exact counts, combined before the shuffle."""
    ok = pixels.where(C.valid())
    return ok.groupBy(*by, "prow").agg(*[F.count_if(m).alias(k) for k, m in masks.items()])


def row_bits(pixels: DataFrame, masks: dict[str, Column]) -> DataFrame:
    """tile_id, prow, block and, for each mask, the valid pixels of 64 columns as the bits of a long, combined before
    the shuffle: a tile that is read row by row is shuffled as a sixty-fourth of its pixels."""
    bit = F.expr("shiftleft(1L, cast(pmod(pcol, 64) AS int))")
    of = [F.coalesce(F.bit_or(F.when(m, bit)), F.lit(0).cast("long")).alias(k) for k, m in masks.items()]
    return pixels.where(C.valid()).groupBy("tile_id", "prow", F.expr("cast(floor(pcol / 64) AS int)").alias("block")).agg(*of)


def span_counts(spans: DataFrame, pixels: DataFrame, masks: dict[str, Column]) -> DataFrame:
    """zone_id, tile_id, prow and each mask's valid pixels in the zone: the same as ``masked_counts`` of the zone's pixels.

    Counts run along each row; a span (zone_id, tile_id, prow, c0, c1) is the difference of two of them, whatever
    its length, so pixels are read once for any number of zones and no pixel is copied for a zone. Hand over
    ``spatial.pixels_near`` to read the tiles that zones reach alone.
    """
    names = list(masks)
    bits = row_bits(pixels, masks).select("tile_id", "prow", "block", F.lit(0).alias("k"), F.lit(None).cast(spans.schema["zone_id"].dataType).alias("zone_id"), F.lit(None).cast("int").alias("sign"), *names)
    end = F.explode(F.array(F.struct(F.col("c0").alias("c"), F.lit(-1).alias("sign")), F.struct((F.col("c1") + 1).alias("c"), F.lit(1).alias("sign"))))
    ends = spans.select("zone_id", "tile_id", "prow", end.alias("e"))
    ends = ends.select("tile_id", "prow", F.expr("cast(floor(e.c / 64) AS int)").alias("block"), F.expr("1 + cast(pmod(e.c, 64) AS int)").alias("k"), "zone_id", "e.sign", *[F.lit(None).cast("long").alias(n) for n in names])
    ahead = W.partitionBy("tile_id", "prow").orderBy("block", "k").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = lambda c: F.last(c, ignorenulls=True).over(ahead)
    run = bits.unionByName(ends).select(
        "zone_id", "tile_id", "prow", "sign", "k", (last(F.when(F.col("k") == 0, F.col("block"))) == F.col("block")).alias("own"),
        *[F.sum(F.bit_count(n)).over(ahead).alias(f"{n}_sum") for n in names], *[last(n).alias(n) for n in names],
    ).where("k > 0")
    beyond = lambda n: F.when(F.col("own"), F.expr(f"bit_count(shiftrightunsigned(`{n}`, k - 1))")).otherwise(0)
    before = {n: F.coalesce(F.col(f"{n}_sum") - beyond(n), F.lit(0)) for n in names}
    return run.groupBy("zone_id", "tile_id", "prow").agg(*[F.sum(v * F.col("sign")).alias(n) for n, v in before.items()])


def areas_of(counts: DataFrame, names: Iterable[str], by: list[str], area_m2: Column) -> DataFrame:
    """Hectares per group from counts per row times the row's area."""
    return counts.groupBy(*by).agg(*[(F.sum(F.col(k) * area_m2) / 10000).alias(f"{k}_ha") for k in names])


def zonal_area(pixels: DataFrame, masks: dict[str, Column], by: list[str], area_m2: Column, spans: DataFrame | None = None) -> DataFrame:
    """Hectares of each mask per group. With ``spans``, groups are zones given by spans and ``pixels`` are whole tiles;
    zones without a valid pixel have zeros."""
    counts = masked_counts(pixels, masks, by) if spans is None else span_counts(spans, pixels, masks)
    return areas_of(counts, masks, by, area_m2)


def forest_metrics(pixels: DataFrame, threshold: int, cutoff: int, end_year: int, area_m2: Column, by: str = "zone_id", spans: DataFrame | None = None) -> DataFrame:
    """Hectares of the six forest masks and loss in percent; zones are a column of ``pixels`` or given by ``spans``."""
    masks = {
        "reference": C.reference_forest(threshold), "loss_total": C.loss_total(threshold), "loss_after": C.loss_after(threshold, cutoff),
        "loss_window": C.loss_between(threshold, cutoff + 1, end_year), "remaining": C.forest_at(threshold, end_year), "never_lost": C.forest_never_lost(threshold),
    }
    out = zonal_area(pixels, masks, [by], area_m2, spans)
    share = F.when(F.col("reference_ha") > 0, F.col("loss_after_ha") / F.col("reference_ha") * 100).otherwise(0.0)
    return out.withColumn("loss_pct", share)


def cover_summary(metrics: DataFrame, by: str = "zone_id") -> DataFrame:
    six = lambda c: F.round(c, 6)
    return metrics.select(by, six("reference_ha").alias("initial_ha"), six("loss_total_ha").alias("lost_ha"), six("never_lost_ha").alias("current_ha"))


def pixel_diagnostics(pixels: DataFrame, threshold: int, area_m2: Column, by: str = "zone_id") -> DataFrame:
    ok = C.valid()
    return pixels.groupBy(by).agg(
        F.count_if(ok & C.reference_forest(threshold)).alias("n_reference"), F.count_if(ok & C.loss_total(threshold)).alias("n_loss"),
        F.count_if(ok & C.forest_never_lost(threshold)).alias("n_never_lost"), F.count_if(F.col("tree_valid") == 0).alias("n_tree_missing"),
        F.count_if(F.col("loss_valid") == 0).alias("n_loss_missing"), F.min(F.when(ok, area_m2)).alias("min_area"), F.max(F.when(ok, area_m2)).alias("max_area"), F.avg(F.when(ok, area_m2)).alias("avg_area"),
    )


def loss_consistency(pixels: DataFrame, loss_flag: Column) -> DataFrame:
    """Pixels with a loss year but no loss flag, and the reverse."""
    return pixels.agg(F.count_if((F.col("lossyear") > 0) & ~loss_flag).alias("year_without_loss"), F.count_if((F.col("lossyear") == 0) & loss_flag).alias("loss_without_year"))


def align_layers(cover: DataFrame, loss: DataFrame) -> DataFrame:
    """Both layers by (tile_id, prow, pcol); fails if one has a pixel that the other lacks."""
    keys = ["tile_id", "prow", "pcol"]
    both = cover.withColumn("__c", F.lit(1)).join(loss.withColumn("__l", F.lit(1)), keys, "full_outer")
    bad = F.raise_error(F.lit("layers differ in shape"))
    return both.where(F.when(F.col("__c").isNull() | F.col("__l").isNull(), bad.cast("boolean")).otherwise(True)).drop("__c", "__l")


def parcel_stats(pixels: DataFrame, parcels: DataFrame, threshold: int, cutoff: int, end_year: int, area_m2: Column, keys: list[str], spans: DataFrame | None = None) -> DataFrame:
    """Land, forest and loss per parcel, from zoned pixels or from whole tiles and the parcels' ``spans``; parcels
    without a pixel have zeros."""
    masks = {"land": F.lit(True), "forest": C.forest_at(threshold, end_year), "loss": C.loss_after(threshold, cutoff)}
    found = zonal_area(pixels, masks, keys, area_m2, spans)
    return parcels.join(found, keys, "left").fillna(0.0, [f"{k}_ha" for k in masks])
