"""Views over the given tables, as SQL that Spark and DuckDB both accept."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

VIEWS = {
    "pixels": """
SELECT tile_id, prow, pcol, concat('A', cast((prow - prow % 50) / 50 AS int)) AS zone_id,
       max(treecover) AS treecover, max(lossyear) AS lossyear, min(tree_valid) AS tree_valid, min(loss_valid) AS loss_valid
FROM (SELECT concat('T', cast(l_suppkey % 8 AS int)) AS tile_id, cast(l_orderkey % 200 AS int) AS prow,
             cast((l_partkey * 7 + l_linenumber) % 200 AS int) AS pcol, cast(l_quantity * 2 AS int) AS treecover,
             CASE WHEN l_returnflag = 'R' THEN cast(year(l_shipdate) - 1980 + l_linenumber % 4 AS int) ELSE 0 END AS lossyear,
             CASE WHEN l_tax > 0.07 THEN 0 ELSE 1 END AS tree_valid, CASE WHEN l_discount > 0.095 THEN 0 ELSE 1 END AS loss_valid
      FROM lineitem) t
GROUP BY tile_id, prow, pcol""",
    "tiles": """
SELECT concat('T', cast(k AS int)) AS tile_id, cast(k % 4 * 50 AS double) AS x0, cast(100 + 100 * ((k - k % 4) / 4) AS double) AS y0,
       cast(1 AS double) AS step, 200 AS width, 200 AS height
FROM (SELECT DISTINCT s_suppkey % 8 AS k FROM supplier) t""",
    "boxes": """
SELECT concat('B', cast(s_suppkey AS int)) AS box_id, concat('A', cast(s_suppkey % 4 AS int)) AS aoi_id,
       cast(s_suppkey * 37 % 180 AS int) AS r0, cast(s_suppkey * 37 % 180 + 5 + s_suppkey % 15 AS int) AS r1,
       cast(s_suppkey * 53 % 180 AS int) AS c0, cast(s_suppkey * 53 % 180 + 5 + s_suppkey % 11 AS int) AS c1
FROM supplier""",
    "parcels": """
SELECT concat('P', cast(p_partkey AS int)) AS parcel_id, concat('A', cast(p_partkey % 4 AS int)) AS aoi_id, cast(p_partkey AS bigint) AS pos,
       CASE WHEN p_size % 7 = 0 THEN '  ' ELSE p_type END AS siht1, p_brand AS land_use,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE cast(p_partkey % 900 + 100 AS double) * 1000 END AS pindala,
       CASE WHEN p_size % 3 = 0 THEN cast(p_size AS double) * 4000 END AS mets,
       CASE WHEN p_size % 3 = 1 THEN cast(p_size AS double) / 2 END AS mets_ha,
       CASE WHEN p_size % 4 = 0 THEN cast(p_size AS double) * 1000 END AS forest_area_ha, cast(p_size AS double) * 2.5 AS geodesic_area_ha
FROM part""",
    "artifacts": """
SELECT d.source AS bundle_id, concat('reports/', d.lang, '/', cast(d.doc_id AS int),
         CASE cast(d.doc_id % 4 AS int) WHEN 0 THEN '.json' WHEN 1 THEN '.geojson' WHEN 2 THEN '.csv' ELSE '.bin' END) AS relpath,
       d.n_chars AS size_bytes, d.text AS content, CASE WHEN d.doc_id % 5 <> 0 THEN 1 ELSE 0 END AS published,
       CASE WHEN d.doc_id % 7 <> 0 THEN 1 ELSE 0 END AS local, CASE WHEN d.doc_id % 11 = 0 THEN 1 ELSE 0 END AS changed, d.doc_id AS artifact_no
FROM documents d""",
    "runs": """
SELECT concat('site', cast(o_custkey % 10 AS int)) AS site_id, concat('run_', cast(cast(o_orderdate AS date) AS string), '_', cast(o_orderkey AS int)) AS run_name,
       cast(o_orderdate AS date) AS bundle_date, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS has_report
FROM orders""",
    "metric_text": """
SELECT event_id, user_id, CASE WHEN event_id % 50 = 0 THEN concat(event_type, '=', cast(user_id AS string))
            ELSE concat(event_type, '=', cast(event_id % 1000 AS string), ':count:src', cast(user_id % 3 AS string), ':note a:b') END AS raw
FROM events""",
    "links": """
SELECT concat('fam', cast(page_id % 6 AS int), '/dep', cast(page_id AS int)) AS dependency_id,
       concat('https://example.org/GFC-', cast(2019 + page_id % 6 AS int), '-v1.', cast(page_id % 13 AS int), '/x.html') AS url,
       CASE cast(page_id % 4 AS int) WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 404 END AS http_status,
       CASE WHEN page_id % 3 = 0 THEN 'application/xml' ELSE 'text/html; charset=utf-8' END AS content_type,
       'text/html' AS expected_content_type, cast(page_id AS bigint) AS probe
FROM pages""",
    "catalogue": "SELECT cast(n_nationkey AS string) AS dataset_id, n_name AS name FROM nation",
    "families": "SELECT cast(r_regionkey * 3 AS string) AS dataset_id, r_name AS family FROM region",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view or a given table."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return sql(spark, sf_dir, VIEWS[name])


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Spark SQL over the given tables, without registering them."""
    used = [t for t in TABLES if re.search(rf"(?i)\b(?:from|join)\s+{t}\b", text)]
    for t in used:
        text = re.sub(rf"(?i)\b(from|join)(\s+){t}\b", rf"\1\2{{{t}}}", text)
    return spark.sql(text, **{t: view(spark, sf_dir, t) for t in used})


def with_views(text: str) -> str:
    """DuckDB SQL: the views that a query names, in front of it."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", text)]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in used)
    if not used:
        return text
    if text.lstrip().lower().startswith("with recursive "):
        return f"WITH RECURSIVE {ctes}, {text.lstrip()[15:]}"
    return f"WITH {ctes}, {text[5:]}" if text.lstrip().lower().startswith("with ") else f"WITH {ctes} {text}"
