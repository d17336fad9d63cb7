"""Column expressions: masks, parcel rules, text rules. All run inside code generation; none is a UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- masks over aligned pixels -------------------------------------------------------------------


def valid() -> Column:
    """Both layers have data."""
    return (F.col("tree_valid") == 1) & (F.col("loss_valid") == 1)


def reference_forest(threshold: int = 10) -> Column:
    return F.col("treecover") >= threshold


def loss_total(threshold: int = 10) -> Column:
    return reference_forest(threshold) & (F.col("lossyear") > 0)


def loss_between(threshold: int, first: int, last: int) -> Column:
    """Loss in calendar years first..last."""
    return reference_forest(threshold) & F.col("lossyear").between(max(first - 2000, 1), last - 2000)


def loss_after(threshold: int, cutoff: int) -> Column:
    return reference_forest(threshold) & (F.col("lossyear") > max(cutoff - 2000, 0))


def forest_at(threshold: int, year: int) -> Column:
    """Not lost by the end of the year."""
    return reference_forest(threshold) & ((F.col("lossyear") == 0) | (F.col("lossyear") > year - 2000))


def forest_never_lost(threshold: int = 10) -> Column:
    return reference_forest(threshold) & (F.col("lossyear") == 0)


def loss_year() -> Column:
    return F.when(F.col("lossyear") > 0, F.col("lossyear") + 2000).otherwise(0)


# --- areas ---------------------------------------------------------------------------------------

WGS84_A, WGS84_E2 = 6378137.0, 0.0066943799901413165
_E = math.sqrt(WGS84_E2)


def authalic_q(sin_lat: Column) -> Column:
    """The ellipsoid's area function of a latitude."""
    es = F.lit(_E) * sin_lat
    return (1 - WGS84_E2) * (sin_lat / (1 - es * es) - (1 / (2 * _E)) * F.log((1 - es) / (1 + es)))


Q_POLE = (1 - WGS84_E2) * (1 / (1 - WGS84_E2) - (1 / (2 * _E)) * math.log((1 - _E) / (1 + _E)))


def cell_area_m2(lat_top: Column, lat_bottom: Column, width_degrees: Column) -> Column:
    """Area between two parallels and two meridians on WGS84."""
    top, bottom = authalic_q(F.sin(F.radians(lat_top))), authalic_q(F.sin(F.radians(lat_bottom)))
    return WGS84_A**2 / 2 * F.radians(width_degrees) * F.abs(top - bottom)


# --- text and parcel rules -----------------------------------------------------------------------


def filled(c: Column) -> Column:
    """Null for blank text."""
    return F.nullif(F.trim(c), F.lit(""))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*map(filled, columns))


def na(c: Column) -> Column:
    return F.coalesce(filled(c), F.lit("N/A"))


def yes_no_na(c: Column) -> Column:
    v = F.lower(F.trim(c.cast("string")))
    return F.when(v.isin("yes", "y", "true", "1"), "Yes").when(v.isin("no", "n", "false", "0"), "No").otherwise("N/A")


def number(c: Column) -> Column:
    """Text as a double; anything but a plain decimal number is null."""
    return F.when(c.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), F.trim(c).cast("double"))


#: Field names that count as forest related whatever they hold.
FOREST_FIELDS = ["mets", "mets_ha", "pindala", "haritav", "rohumaa", "metsatyyp", "siht1"]


def is_forest_field(name: Column) -> Column:
    return F.lower(name).isin(FOREST_FIELDS) | F.lower(name).rlike("mets|forest")


def is_forest_ha_field(name: Column) -> Column:
    """A forest field in hectares: its name ends in ha or has ha as a part of its own."""
    return F.lower(name).rlike("mets|forest") & F.lower(name).rlike("ha$|(^|[_-])ha($|[_-])")


def land_area(pindala: Column, geodesic: Column) -> Column:
    """Reported square metres as hectares, else the geodesic area."""
    return F.coalesce(pindala / 10000, geodesic)


def normalised_area(value: Column, key: Column, land: Column) -> Column:
    """struct(area_ha, method): square metres by the field's name, or inferred where hectares exceed the land but
    square metres fit, else hectares."""
    converted = value / 10000
    named = F.lower(key).rlike("m2|_m$")
    inferred = F.coalesce((value > land) & (converted <= land), F.lit(False))
    method = F.when(named, "reported_m2").when(inferred, "reported_m2_inferred").otherwise("reported_ha")
    return F.struct(F.when(named | inferred, converted).otherwise(value).alias("area_ha"), method.alias("method"))


def safe_id(c: Column) -> Column:
    """Runs of other characters than letters, digits, dot, low line and hyphen as one low line; empty is null."""
    return F.nullif(F.regexp_replace(F.trim(c), "[^A-Za-z0-9._-]+", "_"), F.lit(""))


def metric_parts(raw: Column) -> dict[str, Column]:
    """variable=value:unit[:source[:notes]]; later colons belong to the notes."""
    pattern = r"^([^=]+)=([^:]*):([^:]+)(?::([^:]*))?(?::(.*))?$"
    part = lambda k: F.regexp_extract(raw, pattern, k)
    value = number(part(2))
    return {
        "variable": F.trim(part(1)), "value": value, "is_int": ~F.contains(part(2), F.lit(".")),
        "unit": part(3), "source": part(4), "notes": part(5), "ok": raw.rlike(pattern) & value.isNotNull(),
    }


def content_type(path: Column) -> Column:
    """By suffix; null if it is none of these."""
    out = F.lit(None).cast("string")
    kinds = {".json": "application/json", ".geojson": "application/geo+json", ".csv": "text/csv", ".html": "text/html", ".wkt": "text/plain"}
    for suffix, kind in kinds.items():
        out = F.when(F.lower(path).endswith(suffix), kind).otherwise(out)
    return out


def end_year(version: Column, path: Column) -> Column:
    """The year a data set's version starts with, else one in its path."""
    y = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit("")).cast("int")
    return F.coalesce(y(version, r"^(20\d\d)"), y(path, r"(20\d\d)"))


def latest_year(folder: Column) -> Column:
    """Aggregate: the largest year that a data set's folder name has, for where ``end_year`` finds none."""
    return F.max(F.nullif(F.regexp_extract(folder, r"(20\d\d)", 1), F.lit("")).cast("int"))


def tile_of_path(path: Column) -> Column:
    """A parent directory that is a tile id, else the first in the file's name; upper case."""
    up = F.upper(path)
    folder = F.regexp_extract(up, r"(?:^|/)([NS]\d\d_[EW]\d\d\d)/[^/]*$", 1)
    name = F.regexp_extract(up, r"([NS]\d\d_[EW]\d\d\d)[^/]*$", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(name, F.lit("")))


def tile_id(lat_edge: Column, lon_edge: Column) -> Column:
    """Name of a tile from its naming corner in whole degrees."""
    lat = F.concat(F.when(lat_edge >= 0, "N").otherwise("S"), F.lpad(F.abs(lat_edge).cast("string"), 2, "0"))
    return F.concat(lat, F.lit("_"), F.when(lon_edge >= 0, "E").otherwise("W"), F.lpad(F.abs(lon_edge).cast("string"), 3, "0"))


def link_family(dependency_id: Column) -> Column:
    return F.split_part(dependency_id, F.lit("/"), F.lit(1))


def link_score(status: Column, content_type: Column, expected: Column) -> Column:
    """1 if the status is 200 to 399, 0.5 more for the expected kind of content, 0.2 more for 200 to 299."""
    ok = F.coalesce(status.between(200, 399), F.lit(False))
    kind = F.coalesce(F.startswith(content_type, expected), F.lit(False))
    two = F.coalesce(status.between(200, 299), F.lit(False))
    return ok.cast("double") + 0.5 * kind.cast("double") + 0.2 * two.cast("double")


def _first_replaced(text: Column, old: Column, new: Column) -> Column:
    """The text with the first ``old`` replaced; null where it has none."""
    at = F.locate(old, text) if isinstance(old, str) else F.position(old, text)
    return F.when(at > 0, F.concat(F.substr(text, F.lit(1), at - 1), new, F.substr(text, at + F.length(old))))


def link_candidates(url: Column) -> Column:
    """array of struct(url, method): the first year one later, the first version's minor number (0 if it has none)
    one higher, where the url holds them so written; distinct."""
    year = F.nullif(F.regexp_extract(url, r"(20\d\d)", 1), F.lit(""))
    major = F.nullif(F.regexp_extract(url, r"v(\d+)(?:\.\d+)?", 1), F.lit("")).try_cast("bigint")
    minor = F.coalesce(F.nullif(F.regexp_extract(url, r"v\d+(?:\.(\d+))?", 1), F.lit("")).try_cast("bigint"), F.lit(0))
    version = lambda n: F.concat(F.lit("v"), major.cast("string"), F.lit("."), n.cast("string"))
    later = _first_replaced(url, year, (year.try_cast("int") + 1).cast("string"))
    higher = _first_replaced(url, version(minor), version(minor + 1))
    one = lambda u, method: F.when(u.isNotNull(), F.struct(u.alias("url"), F.lit(method).alias("method")))
    return F.array_compact(F.array(one(later, "year_bump_probe"), F.when(later.isNull() | (later != higher), one(higher, "version_probe"))))


def run_timestamp(name: Column, modified: Column | None = None, reported: Column | None = None) -> Column:
    """The time a run's name holds, by several patterns in order; else the time its folder was modified, what its
    report says, or the epoch. A pattern whose text is no time is passed over."""
    tries = [
        (r"(\d{8}T\d{6}Z)", "yyyyMMdd'T'HHmmss'Z'"), (r"(\d{8}_\d{6})", "yyyyMMdd_HHmmss"), (r"(\d{8}-\d{6})", "yyyyMMdd-HHmmss"),
        (r"(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ)", "yyyy-MM-dd'T'HH:mm:ss'Z'"), (r"(\d{4}-\d\d-\d\d)", "yyyy-MM-dd"), (r"(\d{8})", "yyyyMMdd"),
    ]
    found = [F.try_to_timestamp(F.nullif(F.regexp_extract(name, p, 1), F.lit("")), F.lit(f)) for p, f in tries]
    rest = [c for c in (modified, reported if reported is None else F.try_to_timestamp(reported)) if c is not None]
    return F.coalesce(*found, *rest, F.timestamp_seconds(F.lit(0)))
