"""Readers and writers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.evidence import ordered

FEATURE = "struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
LINK_COLUMNS = ["dependency_id", "url", "expected_content_type", "server_audit_path", "description", "family_or_tag", "used_by", "update_policy", "version_pattern", "last_verified_utc"]


def scratch(spark: SparkSession) -> str:
    """A new place in the folder that all executors share; a temporary one in a local session without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    return f"{root}/{uuid.uuid4().hex}"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """doc, pos (from 1), properties, geometry_type, coordinates (JSON) of FeatureCollections, Features and bare geometries."""
    schema = f"type string, features array<{FEATURE}>, properties map<string,string>, geometry struct<type:string,coordinates:string>, coordinates string"
    # the JSON source goes back to the file for the text of every feature's coordinates; documents as texts are read once
    texts = spark.read.text(path, wholetext=True).where(F.col("value").rlike(r"\S"))
    raw = texts.select(F.explode(F.array(F.from_json(F.regexp_replace("value", "^\ufeff", ""), schema))).alias("r"), F.input_file_name().alias("doc")).select("r.*", "doc")
    bare = F.struct(F.lit("Feature").alias("type"), F.create_map().cast("map<string,string>").alias("properties"), F.struct("type", "coordinates").alias("geometry"))
    one = F.struct("type", "properties", "geometry")
    all_ = F.when(F.col("type") == "FeatureCollection", F.col("features")).when(F.col("type") == "Feature", F.array(one)).otherwise(F.array(bare))
    each = raw.select("doc", F.posexplode(all_).alias("i", "f"))
    return each.select("doc", (F.col("i") + 1).alias("pos"), "f.properties", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def zones_of_features(features: DataFrame) -> DataFrame:
    """zone_id, properties, polygons and place in its document (pos) of Polygon and MultiPolygon features."""
    ring = "array<array<array<double>>>"
    polygons = F.when(F.col("geometry_type") == "Polygon", F.array(F.from_json("coordinates", ring))).otherwise(F.from_json("coordinates", f"array<{ring}>"))
    xy = F.transform(polygons, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))))
    return features.where(F.col("geometry_type").isin("Polygon", "MultiPolygon")).select(F.concat_ws("#", "doc", "pos").alias("zone_id"), "properties", xy.alias("polygons"), "pos")


def read_parcels(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """parcel_id, forest_area_ha, reference_source, reference_method; a blank area is null with source ``missing``."""
    names = ["parcel_id", "forest_area_ha", "reference_source", "reference_method"]
    reader = spark.read.schema(", ".join(f"{n} string" for n in names)) if fmt == "json" else spark.read.option("header", True)
    raw = reader.format(fmt).load(path)
    area = C.number(F.col("forest_area_ha"))
    source = F.when(area.isNull(), "missing").otherwise(F.col("reference_source"))
    return raw.select("parcel_id", area.alias("forest_area_ha"), source.alias("reference_source"), "reference_method")


def read_pixels(spark: SparkSession, path: str, tiles: list[str] | None = None, rows: tuple[int, int] | None = None) -> DataFrame:
    """Pixel rows; the tiles prune partitions and the rows prune row groups."""
    out = spark.read.parquet(path)
    out = out if tiles is None else out.where(F.col("tile_id").isin(tiles))
    return out if rows is None else out.where(F.col("prow").between(*rows))


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_link_registry(spark: SparkSession, path: str) -> DataFrame:
    """All registry columns as text; lines that begin with # are comments."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("comment", "#").csv(path)
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in LINK_COLUMNS))
    return empty.unionByName(raw, allowMissingColumns=True)


#: Files up to this size are hashed as one value; Spark's binary source can't hold more than 2 GB in one.
WHOLE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20


def _streamed_sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, sha256 of files read block by block."""
    import hashlib

    from pyarrow import fs

    for batch in batches:
        hashes = []
        for path in batch["path"].to_pylist():
            # Spark writes local paths as file:/a, with % for special characters left as they are in the name
            local = path.startswith("file:")
            where, name = (fs.LocalFileSystem(), f"/{path[5:].lstrip('/')}") if local else fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with where.open_input_stream(name) as f:
                while block := f.read(BLOCK_BYTES):
                    digest.update(block)
            hashes.append(digest.hexdigest())
        yield pa.RecordBatch.from_pydict({"path": batch["path"], "sha256": pa.array(hashes, pa.string())})


def file_inventory(spark: SparkSession, root: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """relpath, sha256, size_bytes, content_type of all files below a folder, of any size.

    Files up to ``whole_bytes`` are hashed by Spark as values. Larger ones are listed without their content, dealt to
    tasks by path and hashed block by block, so that a task holds one block. The list of paths is Spark's, on the driver,
    which bounds the number of files below one root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    small = files.where(F.col("length") <= whole_bytes).select("path", F.sha2("content", 256).alias("sha256"), "length")
    large = files.where(F.col("length") > whole_bytes).select("path", "length")
    dealt = large.select("path").repartition("path")
    hashed = large.join(dealt.mapInArrow(_streamed_sha256, "path string, sha256 string"), "path").select("path", "sha256", "length")
    bare = root.split(":", 1)[-1].strip("/")
    rel = F.substring_index("path", f"/{bare}/", -1).alias("relpath")
    found = small.union(hashed)
    # scans leave empty files out; Spark's own listing has them, as escaped addresses
    listed = spark.createDataFrame(pa.table({"path": pa.array([unquote(p) for p in files.inputFiles()], pa.string())}))
    empty = listed.select(rel).join(files.select(rel), "relpath", "left_anti")
    empty = empty.select("relpath", F.sha2(F.lit(b""), 256).alias("sha256"), F.lit(0).cast("bigint").alias("size_bytes"))
    rows = found.select(rel, "sha256", F.col("length").alias("size_bytes")).union(empty)
    return rows.withColumn("content_type", C.content_type(F.col("relpath")))


def read_evidence(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """Evidence rows of an inclusive range of dates, in order of date, bundle and path."""
    if end < start:
        raise ValueError("the range ends before it starts")
    rows = spark.read.parquet(root).where(F.col("bundle_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return ordered(rows, "bundles")


#: The fields of a report that its contract and integrity rules look at.
REPORT_SCHEMA = """
report_id string, report_version string, generated_at_utc string, bundle_id string, aoi_id string,
report_metadata struct<report_type:string,regulatory_context:string,assessment_capability:string>,
aoi_geometry_ref struct<kind:string,value:string,sha256:string>, inputs struct<sources:array<struct<source_id:string,sha256:string>>>,
metrics map<string,struct<value:double,unit:string,notes:string>>,
evidence_artifacts array<struct<relpath:string,sha256:string,size_bytes:bigint,content_type:string>>,
evidence_registry struct<evidence_classes:array<struct<class_id:string,mandatory:boolean,status:string>>>,
acceptance_criteria array<struct<criteria_id:string,description:string,evidence_classes:array<string>,decision_type:string>>,
results array<struct<result_id:string,criteria_ids:array<string>,outcome:string,assumption_refs:array<string>,evidence_classes:array<string>,non_testable_due_to_assumptions:boolean>>,
regulatory_traceability array<struct<regulation:string,evidence_class:string,acceptance_criteria:string,result_ref:string>>,
assumptions array<struct<assumption_id:string,testable:boolean,affects_results:array<string>>>,
policy_mapping_refs array<string>, parameters map<string,string>, datasets array<struct<dataset_id:string,retrieved_at_utc:string,license:string>>,
policy_mapping array<struct<article_ref:string,requirement:string,evidence_fields:array<string>,artifact_relpaths:array<string>,status:string>>,
results_summary struct<aoi_area:struct<area_ha:double,method:string>,deforestation_free_post_2020:struct<status:string>>,
computed struct<forest_loss_post_2020:map<string,string>>, methodology struct<forest_loss_post_2020:struct<is_placeholder:boolean>>,
computed_outputs struct<forest_loss_post_2020:struct<mask_geojson_ref:struct<relpath:string>,tiles_manifest_ref:struct<relpath:string>>>,
external_dependencies array<struct<dependency_id:string,tile_source:string,tiles_used:array<struct<tile_id:string,source_url:string>>,tiles_manifest:struct<relpath:string>>>,
validation struct<forest_area_crosscheck:struct<outcome:string,csv_ref:struct<relpath:string>,summary_ref:struct<relpath:string>>>
""".replace("\n", " ")


def read_reports(spark: SparkSession, path: str, schema: str = REPORT_SCHEMA, whole: bool = True) -> tuple[DataFrame, DataFrame]:
    """Reports with the contract's schema, and the documents that aren't JSON: whole files, or else one a line."""
    raw = spark.read.text(path, wholetext=whole)
    made = F.from_json("value", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    # exploded, as the optimizer would else parse once for the filter and once more for the fields
    parsed = raw.select("value", F.explode(F.array(made)).alias("r"))
    return parsed.where("r.__bad is null").select("r.*").drop("__bad"), parsed.where("r.__bad is not null").select("value")


#: Reports that a file holds; compressed text can't be split, so a file is read by one task.
REPORTS_PER_FILE = 100_000


def write_reports(reports: DataFrame, path: str) -> None:
    """Reports as JSON, one a line, compressed: every report spells the names of its fields."""
    lines = reports.select(F.to_json(F.struct("*")).alias("value"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", REPORTS_PER_FILE).text(path)


def write_parcels(df: DataFrame, path: str, keys: list[str]) -> None:
    """Feature rows (one JSON a line) and the same as CSV."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*keys).alias("properties"), F.col("geometry"))
    df.select(F.to_json(feature).alias("value")).write.text(f"{path}/features")
    df.select(*keys).write.option("header", True).csv(f"{path}/table")


def write_metrics(df: DataFrame, path: str) -> None:
    columns = ["variable", "value", "unit", "source", "notes"]
    df.select(*columns).orderBy("variable").write.option("header", True).csv(path)


def write_evidence(df: DataFrame, root: str) -> None:
    """Replaces just the bundles that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bundle_date", "bundle_id").parquet(root)


def export_catalogue(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)
